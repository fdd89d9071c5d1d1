"""Queries over request-log entries."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.catalog import page_summary
from shelfmark.functions.columns import TEXT, literal_as
from shelfmark.operators.ranking import cut_page
from shelfmark.plans.request import LogRequest
from shelfmark.sources.requestlog import DATE

# Defaults of retention and of the request limit.
RETENTION_DAYS = 90
MAX_REQUESTS = 100
WINDOW_SECONDS = 60


def since(log: DataFrame, start: str | None) -> DataFrame:
    """Entries at or after ``start``. ISO text compares as text; an entry without a time
    stays. The same test on the day's prefix prunes the date partitions."""
    if not start:
        return log
    kind = log.schema["ts"].dataType
    first = literal_as(start, kind)
    kept = log.where(F.col("ts").isNull() | (F.col("ts") >= first))
    if DATE in log.columns:
        kept = kept.where(F.col(DATE).isNull() | (F.col(DATE) >= start[:10]))
    return kept


def page(log: DataFrame, request: LogRequest, ties: list[str]) -> DataFrame:
    """One page, newest first. ``ties`` orders entries of one time, latest first."""
    keys = [(c, False) for c in ["ts", *ties]]
    return cut_page(since(log, request.since), keys, request.offset, request.page_size)


def summary(log: DataFrame, request: LogRequest) -> DataFrame:
    return page_summary(since(log, request.since), request.page, request.page_size)


def _in_utc(now: str) -> str:
    """A time with an offset as the same moment's time without one."""
    try:
        time = datetime.fromisoformat(now)
    except ValueError:
        return now
    return time.astimezone(UTC).replace(tzinfo=None).isoformat() if time.tzinfo else now


def retained(log: DataFrame, now: str, days: int = RETENTION_DAYS) -> DataFrame:
    """Entries not older than ``days`` at ``now``; those without a time stay, as their
    age is unknown. Write the result to a new folder, never over the log being read."""
    kind = log.schema["ts"].dataType
    cutoff = F.lit(_in_utc(now)).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days))
    if not isinstance(kind, TEXT):
        return log.where(F.col("ts").isNull() | (F.col("ts") >= cutoff.cast(kind)))
    text = F.date_format(cutoff, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    kept = log.where(F.col("ts").isNull() | (F.col("ts") >= text))
    if DATE in log.columns:
        kept = kept.where(F.col(DATE).isNull() | (F.col(DATE) >= F.substring(text, 1, 10)))
    return kept


def entry_time(log: DataFrame) -> Column:
    """The entry's time as a timestamp; null where the text is none."""
    return F.col("ts").try_cast("timestamp") if _is_text(log) else F.col("ts")


def _is_text(log: DataFrame) -> bool:
    return isinstance(log.schema["ts"].dataType, TEXT)


def window_counts(log: DataFrame, window_seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Requests per client and clock-aligned window; counts combine before the shuffle,
    so a client with most of the requests is one row per task and window."""
    timed = log.select(entry_time(log).alias("ts"), "ip").where("ts IS NOT NULL")
    slot = F.window("ts", f"{window_seconds} seconds")
    return timed.groupBy(slot.alias("window"), "ip").agg(F.count(F.lit(1)).alias("requests"))


def rate_breaches(
    log: DataFrame, max_requests: int = MAX_REQUESTS, window_seconds: int = WINDOW_SECONDS
) -> DataFrame:
    """Windows in which a client made more than ``max_requests`` requests."""
    over = window_counts(log, window_seconds).where(F.col("requests") > max_requests)
    return over.select(F.col("window.start").alias("window_start"), "ip", "requests")


def page_entry(
    page: DataFrame, params: dict[str, str], ts: str, path: str, **who
) -> DataFrame:
    """The log entry of one page request: how many items it returned, and to whom."""
    counted = page.where("part = 0") if "part" in page.columns else page
    query = F.create_map(*(F.lit(x) for pair in params.items() for x in pair))
    return counted.agg(F.count(F.lit(1)).cast("int").alias("items")).select(
        F.lit(ts).alias("ts"),
        F.lit("GET").alias("method"),
        F.lit(path).alias("path"),
        query.cast("map<string,string>").alias("query"),
        F.lit(who.get("api_key", "unknown")).alias("apiKey"),
        F.lit(200).alias("status"),
        "items",
        F.lit(who.get("ms", 0)).cast("bigint").alias("ms"),
        F.lit(who.get("ip")).cast("string").alias("ip"),
    )
