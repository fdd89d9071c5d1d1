"""The request log, in batch and as a stream. The events table is the log: its times, its
type as the path, its user as the client, its value as the duration."""

from __future__ import annotations

from pyspark.sql import functions as F

from querybook.registry import Book
from querybook.specs import SUPPLIER, catalog
from shelfmark import LogRequest, PageRequest
from shelfmark.functions.columns import iso_utc
from shelfmark.operators import limits, logs
from shelfmark.operators.lookup import lookup_entries
from shelfmark.session import new_path
from shelfmark.sources import requestlog
from shelfmark.streaming import logs as streams

BOOK = Book()

TS_SQL = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ')"


def _log(tables):
    """Events as log entries, one each."""
    events = tables.events
    return events.select(
        iso_utc(F.col("ts"), events.schema["ts"].dataType).alias("ts"),
        F.lit("GET").alias("method"),
        F.concat_ws("/", F.lit("/events"), "event_type", "event_id").alias("path"),
        F.from_json("props", "map<string,string>").alias("query"),
        F.lit("default").alias("apiKey"),
        F.lit(200).alias("status"),
        F.lit(1).alias("items"),
        F.floor("value").alias("ms"),
        F.col("user_id").cast("string").alias("ip"),
    )


def _written_log(tables) -> str:
    folder = new_path(tables.spark, "request-log")
    requestlog.append(_log(tables), folder)
    return folder


@BOOK.add("""
    SELECT event_id, ts, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'
    ORDER BY ts DESC NULLS LAST, event_id DESC LIMIT 50 OFFSET 50""")
def log_since_page(tables):
    request = LogRequest.parse({"since": "2024-01-10T00:00:00", "page": "2"})
    return logs.page(tables.events, request, ["event_id"]).select("event_id", "ts", "event_type")


@BOOK.add("""
    SELECT count(*) AS total, CAST(2 AS INTEGER) AS page, CAST(50 AS INTEGER) AS page_size,
           CAST(ceil(count(*) / 50.0) AS BIGINT) AS total_pages
    FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'""")
def log_summary(tables):
    return logs.summary(tables.events, LogRequest.parse({"since": "2024-01-10T00:00:00", "page": "2"}))


@BOOK.add("""
    SELECT event_id, ts FROM events
    WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY""")
def log_retention(tables):
    kept = logs.retained(tables.events, "2024-01-31T00:00:00", days=7)
    return kept.select("event_id", "ts")


@BOOK.add("""
    SELECT time_bucket(INTERVAL '60 seconds', ts) AS window_start, user_id, count(*) AS n
    FROM events GROUP BY 1, 2 HAVING count(*) > 1""")
def rate_breach(tables):
    log = tables.events.select("ts", F.col("user_id").alias("ip"))
    found = logs.rate_breaches(log, max_requests=1, window_seconds=60)
    return found.select("window_start", F.col("ip").alias("user_id"), F.col("requests").alias("n"))


LIMITER_SQL = """
    WITH RECURSIVE moments AS (SELECT DISTINCT user_id, ts FROM events WHERE ts IS NOT NULL),
    hops AS (
        SELECT a.user_id, a.ts, min(b.ts) AS next_ts
        FROM moments a JOIN moments b ON a.user_id = b.user_id AND b.ts >= a.ts + INTERVAL 1 DAY
        GROUP BY 1, 2),
    begins AS (
        SELECT user_id, min(ts) AS ts FROM moments GROUP BY user_id
        UNION ALL
        SELECT b.user_id, h.next_ts FROM begins b JOIN hops h ON h.user_id = b.user_id AND h.ts = b.ts),
    windows AS (
        SELECT b.ts AS window_start, b.user_id, count(*) AS requests, greatest(count(*) - 3, 0) AS refused
        FROM begins b JOIN events e ON e.user_id = b.user_id AND e.ts >= b.ts AND e.ts < b.ts + INTERVAL 1 DAY
        GROUP BY 1, 2)
    SELECT * FROM windows"""


def _clients(tables):
    return tables.events.select("ts", F.col("user_id").alias("ip"))


@BOOK.add(LIMITER_SQL)
def limiter_windows(tables):
    """Windows that begin with a client's first request after the one before, of a day each."""
    return limits.limiter_windows(_clients(tables), 3, 86_400).withColumnRenamed("ip", "user_id")


@BOOK.add(f"{LIMITER_SQL} WHERE refused > 0")
def limiter_breaches(tables):
    return limits.limiter_breaches(_clients(tables), 3, 86_400).withColumnRenamed("ip", "user_id")


ENTRY_SQL = f"""
    SELECT {TS_SQL} AS ts, '/events/' || event_type || '/' || event_id AS path,
           json_extract_string(props, '$.k') AS k, CAST(floor(value) AS BIGINT) AS ms,
           CAST(user_id AS VARCHAR) AS ip, CAST(200 AS INTEGER) AS status
    FROM events"""


def _entry_columns(log):
    return log.select("ts", "path", F.col("query")["k"].alias("k"), "ms", "ip", "status")


@BOOK.add(ENTRY_SQL)
def log_append(tables):
    """Entries written to the log and read back from it."""
    return _entry_columns(requestlog.read_log(tables.spark, _written_log(tables)))


@BOOK.add(f"{ENTRY_SQL} WHERE {TS_SQL} >= '2024-01-20T12:00:00.000Z'")
def log_since(tables):
    """A since filter over a dated log folder reads only the days it needs."""
    log = requestlog.read_log(tables.spark, _written_log(tables))
    return _entry_columns(logs.since(log, "2024-01-20T12:00:00.000Z"))


QUARANTINE_SQL = """
    SELECT CASE WHEN user_id % 7 = 0 THEN 'malformed' WHEN user_id % 7 IN (1, 2) THEN 'entry'
                WHEN user_id % 11 BETWEEN 0 AND 4 THEN 'malformed' WHEN user_id % 11 = 5 THEN 'entry'
                WHEN event_type = 'error' THEN 'malformed' ELSE 'entry' END AS kind,
           CAST(strftime(ts, '%Y-%m-%d') AS VARCHAR) AS day, count(*) AS n
    FROM events GROUP BY 1, 2"""


def _dirty_log(tables) -> str:
    """A dated log in which many lines are cut short, hold a query that is no object, two records, text after the record,
    single quotes, numbers that are none or an array; others are empty, of unknown fields or led by a tab."""
    line, user = F.to_json(F.struct("*")), F.col("ip").cast("long")
    odd = {
        0: F.concat("line", "line"), 1: F.concat("line", F.lit(" garbage")), 2: F.translate("line", '"', "'"),
        3: F.concat(F.lit("["), "line", F.lit("]")), 4: F.lit('{"ts": "2026-01-01T00:00:00.000Z", "ms": NaN}'),
        5: F.concat(F.lit("\t"), "line", F.lit(" \r")),
    }
    value = F.when(user % 7 == 0, F.lit('{"ts": "2026-01-01T00:00:00.000Z", "query": "text"}'))
    value = value.when(user % 7 == 1, F.lit("{}")).when(user % 7 == 2, F.lit('{"user": "x"}'))
    for rest, text in odd.items():
        value = value.when(user % 11 == rest, text)
    value = value.when(F.col("path").contains("/error/"), F.expr("substring(line, 1, length(line) - 9)"))
    lines = _log(tables).withColumn("line", line)
    lines = lines.select(F.coalesce(value, "line").alias("value"), requestlog.log_date(F.col("ts")).alias("log_date"))
    folder = new_path(tables.spark, "dirty-log")
    lines.hint("rebalance", F.col("log_date")).write.partitionBy("log_date").text(folder)
    return folder


def _kinds(broken, entries):
    found = broken.select(F.lit("malformed").alias("kind"), F.col("log_date").alias("day")).unionAll(
        entries.select(F.lit("entry").alias("kind"), F.col("log_date").alias("day"))
    )
    return found.groupBy("kind", "day").agg(F.count(F.lit(1)).alias("n"))


@BOOK.add(QUARANTINE_SQL)
def log_quarantine(tables):
    """Lines that are no single strict JSON record are kept apart from the entries, and none is lost."""
    raw = requestlog.read_raw(tables.spark, _dirty_log(tables))
    return _kinds(requestlog.quarantine(raw), requestlog.entries(raw))


@BOOK.add(QUARANTINE_SQL)
def log_quarantine_stream(tables):
    """The same lines divided by a stream of several batches, which is then started again."""
    spark, source = tables.spark, _dirty_log(tables)
    folder, rejects, checkpoint = (new_path(spark, x) for x in ("divided-log", "rejects", "stream-checkpoint"))
    for _ in range(2):
        lines = streams.read_lines(spark, source, files_per_batch=16)
        streams.ingest_lines(lines, folder, rejects, checkpoint).awaitTermination()
    return _kinds(streams.read_rejects(spark, rejects), requestlog.read_log(spark, folder))


@BOOK.add(f"""
    SELECT {TS_SQL} AS ts, '/suppliers/' || user_id AS path,
           CAST(CASE WHEN s_suppkey IS NULL THEN 404 ELSE 200 END AS INTEGER) AS status,
           CAST(CASE WHEN s_suppkey IS NULL THEN 0 ELSE 1 END AS INTEGER) AS items,
           CAST(floor(value) AS BIGINT) AS ms
    FROM events LEFT JOIN supplier ON s_suppkey = user_id""")
def log_of_lookups(tables):
    """One entry per lookup, with the status and item count it was answered with."""
    requests = _log(tables).select("ts", F.col("ip").alias("id"), "apiKey", "ms", "ip")
    entries = lookup_entries(catalog(SUPPLIER, tables), requests, "/suppliers")
    return entries.select("ts", "path", "status", "items", "ms")


@BOOK.add("""
    SELECT 'GET' AS method, '/suppliers' AS path, CAST(200 AS INTEGER) AS status,
           CAST(count(*) AS INTEGER) AS items, '2' AS page
    FROM (SELECT * FROM supplier ORDER BY s_suppkey DESC LIMIT 20 OFFSET 20)""")
def log_of_page(tables):
    params = {"page": "2"}
    page = catalog(SUPPLIER, tables).page(PageRequest.parse(SUPPLIER, params))
    entry = logs.page_entry(page, params, "2024-01-31T00:00:00.000Z", "/suppliers")
    return entry.select("method", "path", "status", "items", F.col("query")["page"].alias("page"))


@BOOK.add(ENTRY_SQL)
def log_ingest_stream(tables):
    """The log streamed into another dated folder."""
    spark = tables.spark
    stream = streams.read_stream(spark, _written_log(tables))
    folder = new_path(spark, "ingested-log")
    streams.ingest(stream, folder).awaitTermination()
    return _entry_columns(requestlog.read_log(spark, folder))


@BOOK.add("""
    WITH counts AS (
        SELECT time_bucket(INTERVAL '60 seconds', ts) AS window_start,
               CAST(user_id AS VARCHAR) AS ip, count(*) AS requests
        FROM events GROUP BY 1, 2)
    SELECT * FROM counts WHERE requests > 1 AND window_start + INTERVAL '60 seconds'
        <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL 10 MINUTE""")
def rate_breach_stream(tables):
    """Breaches in the windows that the stream has closed."""
    spark = tables.spark
    stream = streams.read_stream(spark, _written_log(tables))
    folder = new_path(spark, "breaches")
    streams.write_breaches(streams.breaches(stream, 1, 60), folder).awaitTermination()
    utc = F.to_utc_timestamp("window_start", F.current_timezone()).cast("timestamp_ntz")
    return spark.read.parquet(folder).withColumn("window_start", utc)
