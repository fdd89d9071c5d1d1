"""What a catalog holds: tables, columns, keys and row counts as DataFrames.

Two origins give the same three frames: the ``information_schema`` of a database over
JDBC, or the schemas of Spark tables, whose keys are then found from the data (see
``operators.profile``).
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.columns import backtick
from shelfmark.sources.readers import jdbc_options

COLUMNS_SCHEMA = (
    "table_name string, ordinal int, column_name string, data_type string, "
    "nullable boolean, is_primary_key boolean"
)

# The catalog queries a database is asked, per frame.
CATALOG_QUERIES = {
    "tables": """
        SELECT c.relname AS table_name, c.reltuples AS estimate
        FROM pg_class c JOIN pg_namespace n ON n.oid = c.relnamespace
        WHERE n.nspname = 'public' AND c.relkind IN ('r', 'p')""",
    "columns": """
        SELECT table_name, ordinal_position, column_name, data_type, is_nullable
        FROM information_schema.columns WHERE table_schema = 'public'""",
    "table_constraints": """
        SELECT constraint_name, table_schema, table_name, constraint_type
        FROM information_schema.table_constraints WHERE table_schema = 'public'""",
    "key_column_usage": """
        SELECT constraint_name, table_schema, table_name, column_name,
               ordinal_position, position_in_unique_constraint
        FROM information_schema.key_column_usage WHERE table_schema = 'public'""",
    "referential_constraints": """
        SELECT constraint_name, constraint_schema AS table_schema,
               unique_constraint_name, unique_constraint_schema
        FROM information_schema.referential_constraints WHERE constraint_schema = 'public'""",
}


@dataclass(frozen=True)
class Metadata:
    """``tables(table_name, row_count)``, ``columns`` (``COLUMNS_SCHEMA``) and
    ``foreign_keys(from_table, from_column, to_table, to_column)``."""

    tables: DataFrame
    columns: DataFrame
    foreign_keys: DataFrame


def read_catalog(spark: SparkSession, url: str, **options) -> dict[str, DataFrame]:
    """The raw catalog frames of a database; each is one small read-only query."""
    return {
        name: spark.read.format("jdbc").options(**jdbc_options(url, query=query, **options)).load()
        for name, query in CATALOG_QUERIES.items()
    }


def from_catalog(frames: Mapping[str, DataFrame]) -> Metadata:
    """Metadata out of a database's catalog frames."""
    tables = frames["tables"].select(
        "table_name", F.greatest(F.col("estimate").cast("bigint"), F.lit(0)).alias("row_count")
    )
    flags = primary_key_columns(frames["table_constraints"], frames["key_column_usage"])
    columns = (
        frames["columns"]
        .join(flags, ["table_name", "column_name"], "left")
        .select(
            "table_name",
            F.col("ordinal_position").cast("int").alias("ordinal"),
            "column_name",
            "data_type",
            (F.col("is_nullable") == "YES").alias("nullable"),
            F.coalesce("is_primary_key", F.lit(False)).alias("is_primary_key"),
        )
    )
    keys = foreign_key_columns(
        frames["table_constraints"], frames["key_column_usage"], frames["referential_constraints"]
    )
    return Metadata(tables, columns, keys)


def primary_key_columns(constraints: DataFrame, usage: DataFrame) -> DataFrame:
    """Declared primary-key columns: constraints joined to the columns they use."""
    primary = constraints.where(F.col("constraint_type") == "PRIMARY KEY")
    joined = primary.join(usage.drop("table_name"), ["constraint_name", "table_schema"])
    return joined.select("table_name", "column_name", F.lit(True).alias("is_primary_key"))


def foreign_key_columns(
    constraints: DataFrame, usage: DataFrame, references: DataFrame
) -> DataFrame:
    """Declared foreign keys, one row per column pair also where a key has several
    columns: each is paired with the unique column at the position it names."""
    foreign = constraints.where(F.col("constraint_type") == "FOREIGN KEY")
    from_side = (
        foreign.select("constraint_name", "table_schema")
        .join(usage, ["constraint_name", "table_schema"])
        .join(references, ["constraint_name", "table_schema"])
        .select(
            F.col("table_name").alias("from_table"),
            F.col("column_name").alias("from_column"),
            "unique_constraint_name",
            "unique_constraint_schema",
            F.col("position_in_unique_constraint").alias("position"),
        )
    )
    to_side = usage.select(
        F.col("constraint_name").alias("unique_constraint_name"),
        F.col("table_schema").alias("unique_constraint_schema"),
        F.col("ordinal_position").alias("position"),
        F.col("table_name").alias("to_table"),
        F.col("column_name").alias("to_column"),
    )
    on = ["unique_constraint_name", "unique_constraint_schema", "position"]
    return from_side.join(to_side, on).select("from_table", "from_column", "to_table", "to_column")


def catalog_tables(spark: SparkSession, database: str | None = None) -> dict[str, DataFrame]:
    """The tables of a Spark catalog, temporary views left out."""
    listed = spark.catalog.listTables(database) if database else spark.catalog.listTables()
    prefix = f"{backtick(database)}." if database else ""
    return {t.name: spark.table(prefix + backtick(t.name)) for t in listed if not t.isTemporary}


def table_columns(tables: Mapping[str, DataFrame], key_columns=frozenset()) -> DataFrame:
    """Column metadata of Spark tables. ``key_columns`` holds (table, column) pairs; the
    frame is as long as the schemas are wide, whatever the tables hold."""
    spark = next(iter(tables.values())).sparkSession
    rows = [
        (name, number, f.name, f.dataType.simpleString(), f.nullable, (name, f.name) in key_columns)
        for name, df in tables.items()
        for number, f in enumerate(df.schema, start=1)
    ]
    return spark.createDataFrame(rows, COLUMNS_SCHEMA)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The exact row count of every table; a Parquet count reads footers only."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def estimated_rows(spark: SparkSession, name: str, df: DataFrame | None = None) -> DataFrame:
    """A table's row count from the catalog's statistics, or counted where it has none."""
    quoted = ".".join(backtick(part) for part in name.split("."))
    df = df if df is not None else spark.table(quoted)
    statistics = (
        spark.sql(f"DESCRIBE TABLE EXTENDED {quoted}").where("col_name = 'Statistics'")
        if spark.catalog.tableExists(quoted)
        else None
    )
    known = statistics.first() if statistics is not None else None
    if known and "rows" in known["data_type"]:
        text = F.regexp_extract(F.lit(known["data_type"]), r"(\d+) rows", 1)
        return spark.range(1).select(
            F.lit(name).alias("table_name"), text.cast("bigint").alias("row_count")
        )
    return row_counts({name: df})


def sampled_rows(
    spark: SparkSession, name: str, folder: str, files: int = 64, errors: float = 4.0, format: str = "parquet"
) -> DataFrame:
    """A table's rows estimated from some of its files: ``row_count`` with ``low`` and ``high``, ``files`` and ``read``.

    Files are drawn by a hash of their names, ``files`` in expectation; a table with no more is counted whole. Their rows by byte, times
    the bytes of all files, is the estimate, and the interval is ``errors`` standard errors of it to each side, but never under
    the rows that were counted. The listing gives all sizes, and a Parquet count reads footers, so no
    table is read and what is looked at doesn't grow with it. Two files at least are drawn of a table that has several.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{format}").option("recursiveFileLookup", "true").load(folder)
    listed = listed.select("path", "length").where("length > 0")
    total, size = listed.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    drawn = listed.orderBy(F.xxhash64("path"), "path").limit(max(2, files)).collect()
    if not drawn:
        return spark.createDataFrame([(name, 0, 0, 0, 0, 0)], _SAMPLED)
    rows = spark.read.format(format).load([r["path"] for r in drawn])
    counted = dict(rows.groupBy(F.col("_metadata.file_path")).count().collect())
    pairs = [(counted.get(r["path"], 0), r["length"]) for r in drawn]
    seen = sum(n for n, _ in pairs)
    rate = seen / sum(bytes_ for _, bytes_ in pairs)
    spread = sum((n - rate * bytes_) ** 2 for n, bytes_ in pairs) / max(1, len(pairs) - 1)
    error = errors * total * math.sqrt((1 - len(pairs) / total) * spread / len(pairs))
    estimate = seen if len(pairs) == total else rate * size
    low, high = max(seen, math.floor(estimate - error)), math.ceil(estimate + error)
    return spark.createDataFrame([(name, round(estimate), low, max(low, high), total, len(pairs))], _SAMPLED)


_SAMPLED = "table_name string, row_count long, low long, high long, files long, read long"


def by_size(tables: DataFrame) -> DataFrame:
    """Largest table first."""
    return tables.orderBy(F.desc("row_count"), "table_name")


def in_order(metadata: Metadata) -> Metadata:
    """Tables by name, columns by position, keys by table."""
    return Metadata(
        metadata.tables.orderBy("table_name"),
        metadata.columns.orderBy("table_name", "ordinal"),
        metadata.foreign_keys.orderBy("from_table", "from_column", "to_table", "to_column"),
    )
