"""Column references and the casts that make an item out of a row."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WITH_OFFSET = re.compile(r"[T ].*(Z|[+-]\d{1,2}(:?\d{2})?)$")
_QUOTED_NAME = re.compile(r"'[^']*'|\"([^\"]+)\"")

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATING = (T.FloatType, T.DoubleType)
TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)
TEXT = (T.StringType, T.CharType, T.VarcharType)


def backtick(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql_string(text: str) -> str:
    """Text as an SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_text(text: str) -> str:
    """User SQL with ``"Name"`` identifiers in the quotes Spark SQL uses for them."""
    return _QUOTED_NAME.sub(lambda m: backtick(m.group(1)) if m.group(1) else m.group(0), text)


def sql_column(text: str) -> Column:
    return F.expr(f"({sql_text(text)})")


def literal_text(expression: str) -> str | None:
    """The text of a ``'literal'`` expression, None for a column reference."""
    stripped = expression.strip()
    if len(stripped) >= 2 and stripped[0] == stripped[-1] == "'":
        return stripped[1:-1]
    return None


def column_name(schema: T.StructType, reference: str) -> str:
    """The column a reference means: ``"Exact"`` by its exact name, else by trimmed name."""
    stripped = reference.strip()
    exact = len(stripped) > 2 and stripped[0] == stripped[-1] == '"'
    wanted = stripped[1:-1] if exact else stripped
    names = schema.fieldNames()
    if wanted in names:
        return wanted
    if not exact:
        folded = [n for n in names if n.lower() == wanted.lower()]
        if len(folded) == 1:
            return folded[0]
    raise ValueError(f"no column {reference!r} among {names}")


def column(df: DataFrame, reference: str) -> Column:
    return F.col(backtick(column_name(df.schema, reference)))


def column_type(df: DataFrame, reference: str) -> T.DataType:
    return df.schema[column_name(df.schema, reference)].dataType


def iso_utc(value: Column, kind: T.DataType) -> Column:
    """A date or time as ``yyyy-MM-ddTHH:mm:ss.SSSZ``, whatever the session's zone."""
    if isinstance(kind, T.TimestampType):
        value = F.to_utc_timestamp(value, F.current_timezone())
    return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def as_text(value: Column, kind: T.DataType) -> Column:
    """Text of a value; whole floating numbers lose their ``.0``."""
    if isinstance(kind, FLOATING):
        whole = (value == F.floor(value)) & (F.abs(value) < 1e15)
        return F.when(whole, value.cast("decimal(38,0)").cast("string")).otherwise(
            value.cast("string")
        )
    if isinstance(kind, TIMES):
        return iso_utc(value, kind)
    return value.cast("string")


def text_field(df: DataFrame, expression: str | None, default: str) -> Column:
    """A literal or column as text, ``default`` where missing."""
    literal = literal_text(expression) if expression is not None else ""
    if literal is not None:
        return F.lit(literal or default)
    value = as_text(column(df, expression), column_type(df, expression))
    return F.coalesce(value, F.lit(default))


def price_field(df: DataFrame, expression: str | None) -> Column:
    """A number: 0 where missing, null where the text is not a number."""
    literal = literal_text(expression) if expression is not None else ""
    if literal is not None:
        value = F.lit(literal) if literal else F.lit(0.0)
        return value.try_cast("double")
    value = column(df, expression)
    return F.when(value.isNull(), F.lit(0.0)).otherwise(value.try_cast("double"))


def updated_at_field(df: DataFrame, reference: str | None) -> Column:
    if reference is None:
        return F.lit(None).cast("string")
    value, kind = column(df, reference), column_type(df, reference)
    if isinstance(kind, TIMES):
        return iso_utc(value, kind)
    return F.nullif(as_text(value, kind), F.lit("0" if isinstance(kind, INTEGRAL) else ""))


def try_cast_to(value: Column, kind: T.DataType) -> Column:
    """``value`` as ``kind``, null where it cannot be; times are read with their offset."""
    if isinstance(kind, TEXT):
        return value.cast("string")
    if isinstance(kind, T.TimestampNTZType):
        instant = F.to_utc_timestamp(value.try_cast("timestamp"), F.current_timezone())
        return instant.cast("timestamp_ntz")
    return value.try_cast(kind)


def literal_as(text: str, kind: T.DataType) -> Column:
    """A request's text as a literal of a column's type. Against a column without a zone,
    a time without an offset is taken as it stands."""
    if isinstance(kind, T.TimestampNTZType) and not _WITH_OFFSET.search(text):
        return F.lit(text).try_cast(kind)
    return try_cast_to(F.lit(text), kind)
