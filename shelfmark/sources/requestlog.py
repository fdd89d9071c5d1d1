"""The request log: newline-delimited JSON in date-partitioned folders."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTRY_SCHEMA = T.StructType(
    [
        T.StructField("ts", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("query", T.MapType(T.StringType(), T.StringType())),
        T.StructField("apiKey", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("items", T.IntegerType()),
        T.StructField("ms", T.LongType()),
        T.StructField("ip", T.StringType()),
    ]
)
ENTRY_COLUMNS = ENTRY_SCHEMA.fieldNames()
DATE = "log_date"
CORRUPT = "_corrupt"
#: The text of a line as it stands in the log, and whether it is an entry.
LINE, IS_ENTRY = "_line", "_entry"
#: White space of JSON.
BLANK = " \t\r\n"
#: What a JSON text may not have, though the parser would take it.
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}

# Numbers are read as text and cast, so that a line with an odd number is still an entry.
RAW_SCHEMA = T.StructType(
    [
        T.StructField(f.name, f.dataType if f.name == "query" else T.StringType())
        for f in ENTRY_SCHEMA
    ]
    + [T.StructField(CORRUPT, T.StringType()), T.StructField(DATE, T.StringType())]
)


def log_date(ts: Column) -> Column:
    """The day of an ISO timestamp; the partition an entry is written to."""
    return F.substring(ts, 1, 10)


def parsed(lines: DataFrame) -> DataFrame:
    """Each line of the column ``value`` that is not blank, with its text, parsed where it is one JSON record.

    The parser stops after the first value of a text, so a line is read twice: as the value of an
    object and as an element of an array. What comes after the value may close one of the two
    early but not both, and a second value makes two elements.
    """
    fields = T.StructType([f for f in RAW_SCHEMA if f.name not in (DATE, CORRUPT)])
    whole = T.StructType([T.StructField("value", fields), T.StructField(CORRUPT, T.StringType())])
    value = F.col("value")
    in_object = F.from_json(F.concat(F.lit('{"value":'), value, F.lit("}")), whole, {**STRICT, "columnNameOfCorruptRecord": CORRUPT})
    in_array = F.from_json(F.concat(F.lit("["), value, F.lit("]")), "array<struct<ts:string>>", STRICT)
    date = F.col(DATE).cast("string") if DATE in lines.columns else F.lit(None).cast("string")
    read = lines.where(F.trim(value, F.lit(BLANK)) != "").select(
        value.alias(LINE), in_object.alias("read"), F.coalesce(F.size(in_array) == 1, F.lit(False)).alias("one"), date.alias(DATE)
    )
    good = F.col("one") & F.col(f"read.{CORRUPT}").isNull() & F.ltrim(F.col(LINE), F.lit(BLANK)).startswith("{")
    return read.select(LINE, "read.value.*", F.coalesce(good, F.lit(False)).alias(IS_ENTRY), DATE)


def read_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Every line of a log folder that is not blank, with its text, parsed where it is an entry.
    No folder is an empty log."""
    try:
        lines = spark.read.option("lineSep", "\n").text(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = spark.createDataFrame([], "value string")
    return parsed(lines)


def entries(raw: DataFrame) -> DataFrame:
    """The well-formed entries of raw lines, typed; ``quarantine`` has all other lines.

    ``log_date`` is the folder an entry was read from, null in a folder without dates.
    """
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in ENTRY_SCHEMA]
    return raw.where(IS_ENTRY).select(*typed, DATE)


def quarantine(raw: DataFrame) -> DataFrame:
    """The malformed lines, as they stand, and their ``log_date``: every line that is no entry."""
    return raw.where(~F.col(IS_ENTRY)).select(F.col(LINE).alias("line"), DATE)


def read_log(spark: SparkSession, folder: str) -> DataFrame:
    return entries(read_raw(spark, folder))


def append(log: DataFrame, folder: str, enabled: bool = True) -> None:
    """Append entries to the log; nothing is written when it is disabled.

    The rebalance hint gives each day few files of even size: a day with most of the
    entries is split over tasks, small days share one.
    """
    if not enabled:
        return
    dated = log.select(*ENTRY_COLUMNS, log_date(F.col("ts")).alias(DATE))
    dated.hint("rebalance", F.col(DATE)).write.mode("append").partitionBy(DATE).json(folder)
