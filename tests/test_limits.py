"""The limiter's windows against a walk through every client's log."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from shelfmark.operators import limits

START = datetime(2026, 1, 1)


def walked(rows, most, seconds):
    """Windows by going through each client's times in order."""
    times, found = defaultdict(list), []
    for ts, ip in rows:
        if ts is not None:
            times[ip].append(ts)
    for ip, seen in times.items():
        for ts in sorted(seen):
            if found and found[-1][1] == ip and ts < found[-1][0] + timedelta(seconds=seconds):
                found[-1][2] += 1
            else:
                found.append([ts, ip, 1])
    return sorted((ts, str(ip), n, max(0, n - most)) for ts, ip, n in found)


def rows_of(df):
    return sorted((r.window_start, str(r.ip), r.requests, r.refused) for r in df.collect())


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_windows_equal_a_walk(spark, kind):
    random.seed(5)
    rows = []
    for ip, gap in (("steady", 0.7), ("tight", 0.05), ("sparse", 25.0), ("bursts", 3.0), (None, 1.3)):
        at = START
        for _ in range(400):
            at += timedelta(milliseconds=random.choice([0, 1, 10, int(gap * 1000), int(gap * 3000)]))
            rows.append((at, ip))
    # Requests exactly a window apart, at the edges of slots, before 1970, and without a time.
    rows += [(START + timedelta(seconds=10 * i), "edge") for i in range(40)]
    rows += [(START + timedelta(seconds=10 * i, microseconds=-1), "before edge") for i in range(40)]
    rows += [(datetime(1969, 12, 31, 23, 59, 30) + timedelta(seconds=i), "old") for i in range(60)]
    rows += [(None, "steady"), (None, "never")]
    log = spark.createDataFrame(rows, f"ts {kind}, ip string")
    assert rows_of(limits.limiter_windows(log, 3, 10)) == walked(rows, 3, 10)
    over = rows_of(limits.limiter_breaches(log, 3, 10))
    assert over == [r for r in walked(rows, 3, 10) if r[3]] and len(over) > 20


def test_text_times_and_empty_logs(spark):
    stamps = ["2026-01-01T00:00:00.000Z", "2026-01-01T00:00:59.999Z", "2026-01-01T00:01:00.000Z", "no time", None]
    log = spark.createDataFrame([(t, "a") for t in stamps], "ts string, ip string")
    found = limits.limiter_windows(log, 1).orderBy("window_start").collect()
    assert [(r.requests, r.refused) for r in found] == [(2, 1), (1, 0)]
    assert limits.limiter_windows(log.where("false")).count() == 0
    with pytest.raises(ValueError, match="second"):
        limits.limiter_windows(log, window_seconds=0)


def test_windows_do_not_hang_on_the_clock(spark):
    """Four requests within a minute are one window here, though the clock's minute changes between them."""
    times = [START + timedelta(seconds=s) for s in (50, 55, 65, 70)]
    log = spark.createDataFrame([(t, "a") for t in times], "ts timestamp_ntz, ip string")
    row = limits.limiter_breaches(log, 3, 60).first()
    assert (row.window_start, row.requests, row.refused) == (times[0], 4, 1)
