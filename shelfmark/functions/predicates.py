"""Request conditions as Catalyst predicates."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from shelfmark.functions.columns import (
    TEXT,
    backtick,
    column,
    column_name,
    column_type,
    literal_as,
    sql_column,
)
from shelfmark.plans.request import Condition, PageRequest

_COMPARE = {
    "=": lambda c, v: c == v,
    ">": lambda c, v: c > v,
    "<": lambda c, v: c < v,
    ">=": lambda c, v: c >= v,
    "<=": lambda c, v: c <= v,
}


def like_pattern(value: str) -> str:
    """``%value%`` with ``%`` and ``_`` kept as wildcards.

    A backslash makes the next character literal. Spark accepts that before ``%``,
    ``_`` and a backslash only, so it is dropped before any other character.
    """
    pattern, escaped = [], False
    for char in f"%{value}%":
        if escaped:
            pattern.append(f"\\{char}" if char in "%_\\" else char)
            escaped = False
        elif char == "\\":
            escaped = True
        else:
            pattern.append(char)
    return "".join(pattern)


def compare(df: DataFrame, condition: Condition) -> Column:
    """One comparison. The literal takes the column's type, so the scan can use it."""
    target, kind = column(df, condition.column), column_type(df, condition.column)
    test = _COMPARE[condition.operator]
    if isinstance(condition.value, str):
        return test(target, literal_as(condition.value, kind))
    if isinstance(kind, TEXT):
        return test(target.try_cast("double"), F.lit(float(condition.value)))
    if isinstance(condition.value, Decimal) and not isinstance(kind, DecimalType):
        return test(target, F.lit(float(condition.value)))
    return test(target, F.lit(condition.value))


def search(df: DataFrame, condition: Condition) -> Column:
    name = column_name(df.schema, condition.column)
    target = F.col(backtick(name))
    if not isinstance(df.schema[name].dataType, TEXT):
        target = target.cast("string")
    return target.ilike(like_pattern(str(condition.value)))


def conjunction(df: DataFrame, conditions: tuple[Condition, ...]) -> Column | None:
    """All comparisons, and any one of the searches."""
    parts = [compare(df, c) for c in conditions if c.operator != "ILIKE"]
    searches = [search(df, c) for c in conditions if c.operator == "ILIKE"]
    if searches:
        parts.append(reduce(or_, searches))
    return reduce(and_, parts) if parts else None


def updated_since(df: DataFrame, reference: str, since: str) -> Column:
    """Changed at or after ``since``."""
    return column(df, reference) >= literal_as(since, column_type(df, reference))


def where(df: DataFrame, base_filter: str | None, *predicates: Column | None) -> DataFrame:
    """Rows that pass the base filter, taken as one parenthesised whole, and the rest."""
    if base_filter:
        df = df.where(sql_column(base_filter))
    for predicate in predicates:
        if predicate is not None:
            df = df.where(predicate)
    return df


def select_rows(df: DataFrame, spec, request: PageRequest) -> DataFrame:
    """The main-table rows a request asks for, before sorting and paging."""
    since = None
    if request.updated_since and spec.updated_at_column:
        since = updated_since(df, spec.updated_at_column, request.updated_since)
    return where(df, spec.base_filter, conjunction(df, request.conditions), since)
