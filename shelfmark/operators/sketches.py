"""Column statistics that are kept by file and merged: a table that grows is never read whole again.

Each file of a table has one row: what it holds, and for every column a distinct-count (HLL) and a
quantile (KLL) sketch of fixed size. A refresh reads the files that have no row yet; files that are gone
or were replaced don't count any more, as rows are matched by name, length and time of change.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from shelfmark.functions.columns import backtick, sql_string

#: Registers of a distinct-count sketch, as a power of two (a standard error of 0.8%), and the size of a quantile sketch (ranks
#: to some 0.7%).
HLL_BITS, KLL_SIZE = 14, 400

_FILE = ["file", "length", "modified"]
_COLUMNS = "array<struct<column_name: string, filled: bigint, hll: binary, kll: binary>>"
_STORED = f"file string, length bigint, modified timestamp, row_count bigint, columns {_COLUMNS}"


def _listed(spark: SparkSession, source: str, format: str) -> DataFrame:
    """The files of a table as they are now, by a listing that opens none of them."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{format}").option("recursiveFileLookup", "true")
    return reader.load(source).select(
        "path",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    """The rows kept so far; a file that two refreshes have read at once counts once."""
    try:
        return spark.read.schema(_STORED).parquet(folder).dropDuplicates(_FILE)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _STORED)


def _hashed(field: T.StructField) -> str:
    """64 bits that stand for a value; nulls for null and for values that have no hash."""
    value = backtick(field.name)
    if "map<" in field.dataType.simpleString() or "variant" in field.dataType.simpleString():
        return "CAST(null AS bigint)"
    return f"CASE WHEN {value} IS NOT NULL THEN xxhash64({value}) END"


def _sketched(field: T.StructField) -> str:
    value, number = backtick(field.name), isinstance(field.dataType, T.NumericType)
    quantiles = f"kll_sketch_agg_double(CAST({value} AS double), {KLL_SIZE})" if number else "CAST(null AS binary)"
    return (
        f"struct({sql_string(field.name)} AS column_name, count({value}) AS filled, "
        f"hll_sketch_agg({_hashed(field)}, {HLL_BITS}) AS hll, {quantiles} AS kll)"
    )


def refresh(spark: SparkSession, source: str, folder: str, format: str = "parquet") -> int:
    """Bring the sketches in ``folder`` up to the files of a table, and return how many of them were read.

    A row is written for a whole file or not at all, so a refresh that was cut off is
    made good by the next one. Empty files have a row without columns.
    """
    new = _listed(spark, source, format).join(_stored(spark, folder), _FILE, "left_anti")
    new = new.cache()
    try:
        paths = [r["path"] for r in new.select("path").collect()]
        if not paths:
            return 0
        rows = spark.read.format(format).load(paths)
        sketches = ", ".join(_sketched(f) for f in rows.schema)
        # The file's name is a column of its own here, whatever the table's are called.
        name = "_file"
        while name in rows.columns:
            name += "_"
        found = rows.withColumn(name, F.col("_metadata.file_path")).groupBy(name)
        found = found.agg(F.count(F.lit(1)).alias("row_count"), F.expr(f"array({sketches})").cast(_COLUMNS).alias("columns"))
        found = new.drop("path").join(found.withColumnRenamed(name, "file"), "file", "left")
        found = found.select(*_FILE, F.coalesce("row_count", F.lit(0).cast("bigint")).alias("row_count"), "columns")
        found.write.mode("append").parquet(folder)
        return len(paths)
    finally:
        new.unpersist()


def sketched_profile(
    spark: SparkSession, source: str, folder: str, ranks: Sequence[float] = (0.5,), format: str = "parquet"
) -> DataFrame:
    """``column_name``, ``row_count``, ``filled``, ``approx_distinct`` and ``quantiles`` at the given ranks of every column,
    from the sketches of the files that the table has now. No row of the table is read.

    Columns that are no numbers, or hold none, have null for quantiles; maps have 0 distinct values. A
    column that only some files have counts the rows of all. Files that no refresh has read raise an error.
    """
    listed = _listed(spark, source, format)
    kept = listed.join(_stored(spark, folder), _FILE, "left")
    totals = kept.agg(F.sum("row_count").alias("row_count"), F.count(F.when(F.col("row_count").isNull(), 1)).alias("unread"))
    rows, unread = totals.first()
    if unread:
        raise ValueError(f"{unread} files of {source} have no sketches yet; refresh them first")
    merged = (
        kept.select(F.inline("columns"))
        .groupBy("column_name")
        .agg(
            F.sum("filled").alias("filled"),
            F.hll_sketch_estimate(F.hll_union_agg("hll")).alias("approx_distinct"),
            F.expr("kll_merge_agg_double(kll)").alias("kll"),
        )
    )
    count = F.lit(rows or 0).cast("bigint").alias("row_count")
    return merged.select("column_name", count, "filled", "approx_distinct", _quantiles(ranks).alias("quantiles"))


def _quantiles(ranks: Sequence[float]) -> Column:
    given = F.array(*(F.expr(f"kll_sketch_get_quantile_double(kll, {float(r)}D)") for r in ranks))
    return F.when(F.expr("kll_sketch_get_n_double(kll)") > 0, given)
