"""The request log as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfmark.operators.logs import MAX_REQUESTS, WINDOW_SECONDS, entry_time
from shelfmark.session import new_path
from shelfmark.sources.requestlog import DATE, ENTRY_COLUMNS, entries, log_date, parsed, quarantine

WATERMARK = "10 minutes"
#: Folders of what one batch of one stream has written.
STREAM, BATCH = "stream_id", "batch_id"


def read_lines(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Lines of a log folder as their files arrive, parsed as ``requestlog.read_raw`` does.

    The day is taken from the path, so a folder may get its first dated files after the start.
    """
    reader = spark.readStream.schema("value string").option("lineSep", "\n").option("maxFilesPerTrigger", files_per_batch)
    lines = reader.option("recursiveFileLookup", "true").text(folder)
    day = F.regexp_extract("_metadata.file_path", f"/{DATE}=([^/]+)/", 1)
    return parsed(lines.select("value", F.when(~day.isin("", NO_DAY), day).alias(DATE)))


#: The folder of entries without a day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def read_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Entries of a log folder as their files arrive; ``ingest_lines`` keeps the other lines too."""
    return entries(read_lines(spark, folder, files_per_batch))


def ingest(stream: DataFrame, folder: str, checkpoint: str | None = None) -> StreamingQuery:
    """Append the stream to a dated log folder, up to what is there now.

    Run again with the same ``checkpoint`` it goes on from where it stopped.
    """
    dated = stream.select(*ENTRY_COLUMNS, log_date(F.col("ts")).alias(DATE))
    return _run(dated, folder, checkpoint, "json", DATE)


def write_batch(lines: DataFrame, batch: int, folder: str, rejects: str, stream_id: str) -> None:
    """Write the entries of a batch of lines to one dated log folder and all other lines to another.

    Both go to folders of their own for this batch of this stream, which are replaced as a whole: a
    batch that is run again after a failure, before, between or after the two writes, leaves each line once.
    An entry without a time has the day of the folder that its line came from.
    """
    own = f"{STREAM}={stream_id}/{BATCH}={batch}"
    lines.persist()
    try:
        day = F.coalesce(log_date(F.col("ts")), F.col(DATE))
        good = entries(lines).select(*ENTRY_COLUMNS, day.alias(DATE))
        good.hint("rebalance", F.col(DATE)).write.mode("overwrite").partitionBy(DATE).json(f"{folder}/{own}")
        other = quarantine(lines).select(F.col("line").alias("value"), DATE)
        other.hint("rebalance", F.col(DATE)).write.mode("overwrite").partitionBy(DATE).text(f"{rejects}/{own}")
    finally:
        lines.unpersist()


def ingest_lines(lines: DataFrame, folder: str, rejects: str, checkpoint: str | None = None) -> StreamingQuery:
    """Divide a stream of ``read_lines`` in one pass: entries go to a dated log folder, every other line, as it stands,
    to ``rejects``. ``requestlog.read_log`` reads the one, ``read_rejects`` the other.

    The name of the stream is that of its checkpoint, so streams with checkpoints of their own may share the folders.
    """
    spark = lines.sparkSession
    checkpoint = checkpoint or new_path(spark, "stream-checkpoint")

    def write(batch: DataFrame, number: int) -> None:
        named = batch.sparkSession.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id")).first()[0]
        write_batch(batch, number, folder, rejects, named)

    writer = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def read_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """The lines kept apart by ``ingest_lines``: ``line`` and the day of the folder that it came from."""
    rows = spark.read.option("lineSep", "\n").text(folder)
    return rows.select(F.col("value").alias("line"), F.col(DATE).cast("string").alias(DATE))


def breaches(
    stream: DataFrame,
    max_requests: int = MAX_REQUESTS,
    window_seconds: int = WINDOW_SECONDS,
    watermark: str = WATERMARK,
) -> DataFrame:
    """Breaches of the request limit, each given once its window is closed. Entries later
    than the watermark are dropped, so state holds only the open windows."""
    timed = stream.select(entry_time(stream).cast("timestamp").alias("ts"), "ip")
    counts = (
        timed.where("ts IS NOT NULL")
        .withWatermark("ts", watermark)
        .groupBy(F.window("ts", f"{window_seconds} seconds").alias("window"), "ip")
        .agg(F.count(F.lit(1)).alias("requests"))
    )
    over = counts.where(F.col("requests") > max_requests)
    return over.select(F.col("window.start").alias("window_start"), "ip", "requests")


def write_breaches(
    stream: DataFrame, folder: str, checkpoint: str | None = None
) -> StreamingQuery:
    return _run(stream, folder, checkpoint, "parquet", None)


def _run(
    stream: DataFrame, folder: str, checkpoint: str | None, format: str, by: str | None
) -> StreamingQuery:
    checkpoint = checkpoint or new_path(stream.sparkSession, "stream-checkpoint")
    writer = stream.writeStream.format(format).outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return (writer.partitionBy(by) if by else writer).start(folder)
