"""Tables to read from: files, catalog tables and databases. Sources are only read."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# What every database session runs before its first read.
READ_ONLY_STATEMENT = "SET default_transaction_read_only = ON"


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    partitions: int = 10,
    read_only_statement: str | None = READ_ONLY_STATEMENT,
    **extra: str,
) -> dict[str, str]:
    """Options of a read-only JDBC read of one table or one query.

    With a partition column and its bounds the read is split into ``partitions`` range
    queries, which also limits the connections in use; without, one task reads it all, so
    only metadata should be read that way.
    """
    if (table is None) == (query is None):
        raise ValueError("name either a table or a query")
    options = {"url": url, **extra}
    options |= {"dbtable": table} if table else {"query": query}
    if read_only_statement:
        options["sessionInitStatement"] = read_only_statement
    if partition_column:
        if bounds is None or table is None:
            raise ValueError("a partitioned read needs a table and bounds")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_table(spark: SparkSession, kind: str, name: str = "", **options) -> DataFrame:
    """A table by kind: ``parquet`` (a path), ``table`` (a catalog name) or ``jdbc``."""
    if kind == "parquet":
        return spark.read.options(**options).parquet(name)
    if kind == "table":
        return spark.read.options(**options).table(name)
    if kind == "jdbc":
        return spark.read.format("jdbc").options(**jdbc_options(table=name, **options)).load()
    raise ValueError(f"unknown kind of source '{kind}'")


def read_tables(
    spark: SparkSession, folder: str, names: list[str] | tuple[str, ...]
) -> Mapping[str, DataFrame]:
    """The named parquet tables of a folder."""
    return {name: read_table(spark, "parquet", f"{folder}/{name}.parquet") for name in names}
