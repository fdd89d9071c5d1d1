"""The request limit as a live limiter counts it: a client's window begins with a request, and the first one at or after its end begins the next.

Which requests begin a window hangs on all before them, yet no client's log is walked through. Time is cut into slots as long as a window,
so a slot has at most one begin. After an empty slot the first request surely begins one, and from each request the begin of the
next window, if this one were a begin, lies in the next slot or at the start of the one after. These hops are doubled until
every chain is followed to its end, in as many rounds as the logarithm of the longest run without an empty slot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from shelfmark.operators.logs import MAX_REQUESTS, WINDOW_SECONDS, entry_time
from shelfmark.session import store


def _micros(log: DataFrame) -> Column:
    """The microseconds of an entry's time; a time without a zone counts as it reads, whatever the session's zone."""
    time = entry_time(log)
    if not isinstance(log.schema["ts"].dataType, TimestampNTZType):
        return F.unix_micros(time.cast("timestamp"))
    seconds = F.unix_date(time.cast("date")) * F.lit(86_400) + F.hour(time) * F.lit(3600) + F.minute(time) * F.lit(60)
    return seconds.cast("long") * 1_000_000 + (F.extract(F.lit("SECOND"), time) * 1_000_000).cast("long")


def _same(a: DataFrame, b: DataFrame, *columns: str) -> Column:
    """Equality of columns, a null client being one client."""
    found = a["ip"].eqNullSafe(b["ip"])
    for c in columns:
        found = found & (a[c] == b[c])
    return found


def _hops(requests: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """Sure begins of windows (``ip, at``), and ``ip, at, to``: where the next window begins if one begins at ``at``.

    A slot's requests, the first of the slot after it and the ends of windows that may have begun in the slot before
    are sorted together; a hop leads from an end to the first request that isn't before it.
    """
    none = F.lit(None).cast("long")
    own = requests.select("ip", "slot", "at", F.lit(2).alias("kind"), none.alias("begin"))
    ends = requests.select("ip", F.col("slot") + 1, F.col("at") + width, F.lit(0), "at")
    firsts = requests.groupBy("ip", "slot").agg(F.min("at").alias("at"))
    firsts = firsts.select("ip", F.col("slot") - 1, "at", F.lit(1), none)
    slot = Window.partitionBy("ip", "slot")
    later = slot.orderBy(F.desc("at"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    asked = F.col("kind") == 0
    sorted_ = own.union(ends).union(firsts).select(
        "*",
        F.min(F.when(~asked, F.col("at"))).over(later).alias("to"),
        F.min(F.when(F.col("kind") == 2, F.col("at"))).over(slot).alias("first"),
        F.max(asked).over(slot).alias("follows"),
    )
    sorted_ = store(sorted_.where(asked | ~F.col("follows") & (F.col("kind") == 2) & (F.col("at") == F.col("first"))), "hops")
    sure = sorted_.where(~asked).select("ip", "at")
    # Where the next slot is empty, the request after it is a sure begin of its own.
    hops = sorted_.where(asked & F.col("first").isNotNull() & F.col("to").isNotNull()).select("ip", F.col("begin").alias("at"), "to")
    return sure, hops


def _begins(sure: DataFrame, hops: DataFrame) -> DataFrame:
    """All begins (``ip, at``) that hops reach from the sure ones. Each round doubles both the hops and what is reached."""
    reached = sure
    while True:
        found = store(reached.join(hops, _same(reached, hops, "at")).select(reached["ip"], F.col("to").alias("at")), "reached")
        if found.isEmpty():
            return reached
        reached = reached.union(found)
        then = hops.toDF("next_ip", "next_at", "next_to")
        met = hops["ip"].eqNullSafe(then["next_ip"]) & (hops["to"] == then["next_at"])
        hops = store(hops.join(then, met).select("ip", "at", F.col("next_to").alias("to")), "hops")


def limiter_windows(log: DataFrame, max_requests: int = MAX_REQUESTS, window_seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Every window of every client: ``window_start``, ``ip``, ``requests`` and how many of these were ``refused``.

    Each request with a time lies in exactly one window; entries without a time are in none. Requests of one
    client and moment are counted before anything is shuffled, so a task gets at most one row for each moment of two slots.
    """
    if window_seconds < 1:
        raise ValueError("a window lasts a second at least")
    width = window_seconds * 1_000_000
    timed = log.select("ip", entry_time(log).alias("ts"), _micros(log).alias("at")).where("at IS NOT NULL")
    counted = timed.groupBy("ip", "at").agg(F.first("ts").alias("ts"), F.count(F.lit(1)).alias("n"))
    slot = F.expr(f"(at - pmod(at, {width}L)) div {width}L")
    requests = store(counted.select("ip", slot.alias("slot"), "at", "ts", "n"), "requests")
    begins = _begins(*_hops(requests, width)).withColumn("slot", slot)
    reach = begins.select(F.col("ip"), F.explode(F.array(F.col("slot"), F.col("slot") + 1)).alias("slot"), F.col("at").alias("begin"))
    inside = (requests["at"] >= reach["begin"]) & (requests["at"] < reach["begin"] + width)
    placed = requests.join(reach, _same(requests, reach, "slot") & inside).select(requests["ip"], "begin", "ts", "n")
    windows = placed.groupBy("ip", "begin").agg(F.min("ts").alias("window_start"), F.sum("n").alias("requests"))
    refused = F.greatest(F.col("requests") - max_requests, F.lit(0).cast("long"))
    return windows.select("window_start", "ip", "requests", refused.alias("refused"))


def limiter_breaches(log: DataFrame, max_requests: int = MAX_REQUESTS, window_seconds: int = WINDOW_SECONDS) -> DataFrame:
    """The windows in which a client was refused a request."""
    return limiter_windows(log, max_requests, window_seconds).where("refused > 0")
