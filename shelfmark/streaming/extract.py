"""Incremental extract: what changed since the last pull."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.columns import backtick, column_name, literal_as
from shelfmark.functions.predicates import select_rows, updated_since
from shelfmark.plans.request import PageRequest
from shelfmark.plans.spec import ResourceSpec


@dataclass(frozen=True)
class Extract:
    """Changed rows and, as one row of ``high_water, n``, the next pull's start: the given mark
    where nothing has changed."""

    rows: DataFrame
    mark: DataFrame


def changed_since(
    main: DataFrame, spec: ResourceSpec, high_water: str, previous: DataFrame | None = None
) -> Extract:
    """Main rows changed at or after ``high_water``.

    The bound is inclusive, so rows at the mark itself come again; those that ``previous``
    (the rows pulled before) holds with the same id and time are left out. Only its rows at
    the mark take part, joined by id, however many share one time.
    """
    if not high_water:
        raise ValueError("an extract needs the mark to start from")
    if not spec.updated_at_column:
        raise ValueError(f"'{spec.table}' has no updated-at column to extract by")
    rows = select_rows(main, spec, PageRequest(updated_since=high_water))
    key = column_name(main.schema, spec.id_column)
    time = column_name(main.schema, spec.updated_at_column)
    if previous is not None:
        pulled = previous.where(updated_since(previous, time, high_water))
        pulled = pulled.select(backtick(key), backtick(time))
        rows = rows.join(pulled, [key, time], "left_anti")
    given = literal_as(high_water, main.schema[time].dataType)
    mark = rows.agg(
        F.coalesce(F.max(backtick(time)), given).alias("high_water"), F.count(F.lit(1)).alias("n")
    )
    return Extract(rows, mark)
