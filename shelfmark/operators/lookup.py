"""Items by id, for a whole DataFrame of ids."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.columns import backtick, column_name, try_cast_to
from shelfmark.functions.predicates import where
from shelfmark.operators.ranking import sortable
from shelfmark.operators.relations import ARRAY_ROWS, KEY, PARTS, is_small, join_groups
from shelfmark.session import store

if TYPE_CHECKING:
    from shelfmark.catalog import Catalog

FOUND, NOT_FOUND = 200, 404


def asked_ids(ids: DataFrame) -> DataFrame:
    """Distinct ids as text and how often each was asked for. Combining before the
    shuffle makes an id that most requests ask for one row per task."""
    asked = F.col(backtick(ids.columns[0])).cast("string").alias("id")
    counted = ids.select(asked).groupBy("id").agg(F.count(F.lit(1)).alias("requests"))
    return store(counted, "asked-ids")


def found_rows(catalog: Catalog, asked: DataFrame) -> DataFrame:
    """One main row for each asked id that passes the base filter: the least of them,
    where several have one id, by an aggregate that combines before its shuffle.

    Rows are cut to the asked ids before they are combined: few ids are broadcast, so that
    only their rows are shuffled; else the shuffle of that join also serves the combine.
    """
    spec, main = catalog.spec, catalog.main
    name = column_name(main.schema, spec.id_column)
    kind = main.schema[name].dataType
    typed = try_cast_to(F.col("id"), kind).alias(name)
    keys = asked.select(typed).where(F.col(backtick(name)).isNotNull())
    rows = where(main, spec.base_filter).select(*(backtick(c) for c in catalog.columns))
    rows = rows.join(F.broadcast(keys) if is_small(keys) else keys, name, "left_semi")
    others = [c for c in catalog.columns if c != name]
    if others:
        row = F.struct(*(backtick(c) for c in others))
        mapped = any("map<" in rows.schema[c].dataType.simpleString() for c in others)
        least = F.min_by(row, F.struct(*sortable(rows.select(*map(backtick, others))))) if mapped else F.min(row)
        return rows.groupBy(backtick(name)).agg(least.alias("_row")).select(backtick(name), "_row.*")
    return rows.distinct()


def _answered(catalog: Catalog, asked: DataFrame, keys: DataFrame, how: str = "left") -> DataFrame:
    """Asked ids joined to ``keys`` by ``_id``. Ids that can't be one stay out of the join, where
    all of them would be one null key, and are answered with nothing."""
    kind = catalog.main.schema[column_name(catalog.main.schema, catalog.spec.id_column)].dataType
    cast = try_cast_to(F.col("id"), kind)
    joined = asked.where(cast.isNotNull()).join(keys, cast == F.col("_id"), how)
    return joined.unionByName(asked.where(cast.isNull()), allowMissingColumns=True)


def lookup(catalog: Catalog, ids: DataFrame) -> DataFrame:
    """Every distinct asked id with ``requests``, ``status`` (200 or 404) and its item.

    Ids that read as the same key (``7`` and ``07``) get the same item.
    """
    asked = asked_ids(ids)
    found = found_rows(catalog, asked)
    name = column_name(found.schema, catalog.spec.id_column)
    if catalog.relations:
        found = store(found, "found")
    items = catalog.items_of(found, keep={"_id": name}, narrowed=True)
    answers = _answered(catalog, asked, items)
    status = F.when(F.col("_id").isNull(), NOT_FOUND).otherwise(FOUND)
    return answers.withColumn("status_code", status).drop("_id")


def misses(catalog: Catalog, ids: DataFrame) -> DataFrame:
    """The distinct asked ids that have no item."""
    asked = asked_ids(ids)
    found = found_rows(catalog, asked)
    name = column_name(found.schema, catalog.spec.id_column)
    keys = found.select(F.col(backtick(name)).alias("_id"))
    return _answered(catalog, asked, keys, "left_anti")


def lookup_entries(catalog: Catalog, requests: DataFrame, path: str) -> DataFrame:
    """One log entry per request: status and item count for the id it asked for.

    ``requests`` has the columns ``ts, id, apiKey, ms, ip``. The answers hold no items.
    They are broadcast while few; past that, those to the ids asked for most, found or
    not, still are, so that no shuffle by id gathers their requests.
    """
    keyed = requests.withColumn(KEY, F.coalesce(F.col("id").cast("string"), F.lit("")))
    asked = asked_ids(keyed.select(KEY))
    found = found_rows(catalog, asked)
    name = column_name(found.schema, catalog.spec.id_column)
    keys = found.select(F.col(backtick(name)).alias("_id"))
    answers = _answered(catalog, asked, keys).select(
        F.col("id").alias(KEY),
        F.ceil(F.col("requests") / ARRAY_ROWS).cast("int").alias(PARTS),
        F.col("_id").isNotNull().alias("_hit"),
    )
    joined = join_groups(keyed, store(answers, "answers"))
    return joined.select(
        F.col("ts"),
        F.lit("GET").alias("method"),
        F.concat(F.lit(path.rstrip("/") + "/"), F.col(KEY)).alias("path"),
        F.create_map().cast("map<string,string>").alias("query"),
        F.coalesce(F.col("apiKey"), F.lit("unknown")).alias("apiKey"),
        F.when(F.col("_hit"), FOUND).otherwise(NOT_FOUND).alias("status"),
        F.col("_hit").cast("int").alias("items"),
        F.col("ms").cast("bigint").alias("ms"),
        F.col("ip"),
    )
