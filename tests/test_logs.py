import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shelfmark import LogRequest
from shelfmark.operators import logs
from shelfmark.sources import requestlog
from shelfmark.streaming import logs as streams


def entry(ts, path="/inventory", ip="127.0.0.1"):
    found = {
        "ts": ts, "method": "GET", "path": path, "query": {"page": "1"}, "apiKey": "test",
        "status": 200, "items": 5, "ms": 45, "ip": ip,
    }
    return {k: v for k, v in found.items() if v is not None}


def write_lines(folder, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{len(list(folder.iterdir()))}.log").write_text("\n".join(lines) + "\n")


@pytest.fixture
def month_log(spark, tmp_path):
    times = ["2026-01-01T00:00:00.000Z", "2026-02-01T00:00:00.000Z", "2026-03-01T00:00:00.000Z"]
    write_lines(tmp_path / "log", [json.dumps(entry(t)) for t in times])
    return requestlog.read_log(spark, str(tmp_path / "log"))


def test_append_and_read(spark, tmp_path):
    folder = str(tmp_path / "log")
    for path in ("/inventory", "/inventory/123"):
        log = spark.createDataFrame([entry("2026-01-15T10:00:00.000Z", path)], requestlog.ENTRY_SCHEMA)
        requestlog.append(log, folder)
    rows = requestlog.read_log(spark, folder).orderBy("path").collect()
    assert [r.path for r in rows] == ["/inventory", "/inventory/123"]
    assert rows[0].query == {"page": "1"} and rows[0].ms == 45 and rows[0].log_date == "2026-01-15"
    requestlog.append(log, str(tmp_path / "off"), enabled=False)
    assert not (tmp_path / "off").exists()


def test_missing_folder_is_an_empty_log(spark, tmp_path):
    log = requestlog.read_log(spark, str(tmp_path / "nowhere"))
    assert log.count() == 0
    assert logs.summary(log, LogRequest()).first().total == 0


def test_pages_newest_first(spark, tmp_path):
    write_lines(
        tmp_path / "log", [json.dumps(entry(f"2026-01-0{n}T00:00:00.000Z", f"/{n}")) for n in range(1, 6)]
    )
    log = requestlog.read_log(spark, str(tmp_path / "log"))
    request = LogRequest.parse({"pageSize": "2", "page": "2"})
    assert [r.path for r in logs.page(log, request, ["path"]).collect()] == ["/3", "/2"]
    summary = logs.summary(log, request).first()
    assert (summary.total, summary.page, summary.page_size, summary.total_pages) == (5, 2, 2, 3)


def test_since_is_inclusive(month_log):
    kept = logs.since(month_log, "2026-02-01T00:00:00.000Z")
    assert sorted(r.ts[:7] for r in kept.collect()) == ["2026-02", "2026-03"]
    assert logs.since(month_log, None).count() == 3
    assert logs.since(month_log, "2026").count() == 3


def test_dirty_lines(spark, tmp_path):
    odd = entry("2026-01-03T00:00:00.000Z") | {"ms": 4.5, "status": "ok", "extra": [1]}
    lines = [
        json.dumps(entry("2026-01-01T00:00:00.000Z")),
        "not json",
        "null",
        json.dumps(entry(None)),
        json.dumps(entry("2026-01-02T00:00:00.000Z") | {"query": {}}),
        "",
        '{"ts": "2026-01-',
        json.dumps(odd),
    ]
    write_lines(tmp_path / "log", lines)
    raw = requestlog.read_raw(spark, str(tmp_path / "log"))
    log = requestlog.entries(raw)
    assert log.count() == 4
    broken = {r.line for r in requestlog.quarantine(raw).collect()}
    assert broken == {"not json", "null", '{"ts": "2026-01-'}
    assert log.where("query IS NOT NULL AND cardinality(query) = 0").count() == 1
    assert log.where("ts LIKE '2026-01-03%' AND status IS NULL").count() == 1
    assert {r.ts for r in logs.since(log, "2026-01-02T00:00:00.000Z").collect()} == {
        None, "2026-01-02T00:00:00.000Z", "2026-01-03T00:00:00.000Z",
    }


def test_retention_keeps_the_limit_itself(spark, tmp_path):
    now = datetime(2026, 4, 1)
    edge = now - timedelta(days=90)
    times = [edge - timedelta(milliseconds=1), edge, edge + timedelta(milliseconds=1)]
    texts = [t.isoformat(timespec="milliseconds") + "Z" for t in times]
    write_lines(tmp_path / "log", [json.dumps(entry(t)) for t in [*texts, None]])
    log = requestlog.read_log(spark, str(tmp_path / "log"))
    kept = logs.retained(log, now.isoformat())
    assert {r.ts for r in kept.collect()} == {*texts[1:], None}
    typed = log.withColumn("ts", F.to_timestamp("ts"))
    assert logs.retained(typed, now.isoformat()).count() == 3


def test_date_partitions_are_pruned(spark, tmp_path, plan):
    folder = str(tmp_path / "log")
    times = [f"2026-01-{day:02d}T12:00:00.000Z" for day in range(1, 29)]
    log = spark.createDataFrame([entry(t) for t in times], requestlog.ENTRY_SCHEMA)
    requestlog.append(log, folder)
    read = requestlog.read_log(spark, folder)
    for kept, rows in (
        (logs.since(read, "2026-01-20T13:00:00.000Z"), 8),
        (logs.retained(read, "2026-01-29T12:00:00", 7), 7),
    ):
        pruned = plan(kept).split("PartitionFilters: ")[1].splitlines()[0]
        assert "log_date" in pruned and ">= 2026-01-2" in pruned
        assert kept.count() == rows


@pytest.fixture
def rate_log(spark, tmp_path):
    """100 requests of one client in a window, 101 of another, 60 on each side of an edge."""
    start = datetime(2026, 1, 1, 10)

    def at(seconds, ip):
        ts = (start + timedelta(seconds=seconds)).isoformat(timespec="milliseconds") + "Z"
        return json.dumps(entry(ts, ip=ip))

    lines = [at(n * 0.5, "a") for n in range(100)] + [at(n * 0.5, "b") for n in range(101)]
    lines += [at(60 + n * 0.5 - 30, "edge") for n in range(120)]
    write_lines(tmp_path / "rate", [*lines, "broken"])
    return str(tmp_path / "rate")


def test_rate_breaches(spark, rate_log):
    found = logs.rate_breaches(requestlog.read_log(spark, rate_log)).collect()
    assert [(r.ip, r.requests, r.window_start) for r in found] == [("b", 101, datetime(2026, 1, 1, 10))]


def test_breach_stream_gives_closed_windows_and_drops_late_rows(spark, rate_log, tmp_path):
    folder, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        stream = streams.breaches(streams.read_stream(spark, rate_log), 100, 60)
        streams.write_breaches(stream, folder, checkpoint).awaitTermination()
        return [(r.ip, r.requests) for r in spark.read.parquet(folder).collect()]

    assert run() == []
    later = [json.dumps(entry("2026-01-01T11:00:00.000Z", ip="c"))]
    write_lines(tmp_path / "rate", later)
    assert run() == [("b", 101)]
    late = [json.dumps(entry("2026-01-01T10:00:01.000Z", ip="late")) for _ in range(200)]
    write_lines(tmp_path / "rate", late)
    write_lines(tmp_path / "rate", [json.dumps(entry("2026-01-01T12:00:00.000Z", ip="c"))])
    assert run() == [("b", 101)]


def test_ingest_goes_on_from_its_checkpoint(spark, rate_log, tmp_path):
    folder, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for extra in ([], [json.dumps(entry("2026-01-02T00:00:00.000Z"))]):
        if extra:
            write_lines(tmp_path / "rate", extra)
        streams.ingest(streams.read_stream(spark, rate_log), folder, checkpoint).awaitTermination()
    log = requestlog.read_log(spark, folder)
    assert log.count() == 322
    assert {r.log_date for r in log.select("log_date").distinct().collect()} == {"2026-01-01", "2026-01-02"}
    batch = requestlog.read_log(spark, rate_log)
    assert log.select("ts", "ip").exceptAll(batch.select("ts", "ip")).count() == 0


STRICT_LINES = {
    '{"ts":"a"}': True, '{"ts":"a"}{"ts":"b"}': False, '{"ts":"a"},{"ts":"b"}': False, '{"ts":"a"} garbage': False,
    "{'ts':'single'}": False, '\t{"ts":"tab"} \r': True, '[{"ts":"a"}]': False, "{}": True, '{"user":"x"}': True, "null": False,
    "1": False, '"text"': False, '{"ts":"a"}] x': False, '{"ts":"a"}} x': False, '{"ts":"a"}, ': False, '{"ts":"a",}': False,
    '{"ms":NaN}': False, '{"u":{"v":[1,{"w":Infinity}]}}': False, '{"u":[1,}': False, '{"ms":01}': False, '{"ts":"\\x"}': False,
    '{"ts":"a"}//c': False, '{"ts":"a","ts":"b"}': True, '{"ts":{"a":1},"query":{"a":[1]}}': True, '{"ts": "2026-01-': False,
}


def divided(spark, folder, rejects):
    kept = requestlog.read_log(spark, folder)
    return kept, streams.read_rejects(spark, rejects)


def test_batch_and_stream_take_the_same_lines(spark, tmp_path):
    """A line is an entry if it is one strict JSON record, and each line ends up in one of both places."""
    write_lines(tmp_path / "log" / "log_date=2026-01-05", [*STRICT_LINES, "", "  "])
    write_lines(tmp_path / "log" / "log_date=2026-01-06", ["odd one out"])
    raw = requestlog.read_raw(spark, str(tmp_path / "log"))
    found = {r[requestlog.LINE]: r[requestlog.IS_ENTRY] for r in raw.collect()}
    assert found == STRICT_LINES | {"odd one out": False}

    paths = [str(tmp_path / x) for x in ("out", "rejects", "checkpoint")]
    streams.ingest_lines(streams.read_lines(spark, str(tmp_path / "log")), *paths).awaitTermination()
    kept, rejected = divided(spark, *paths[:2])
    assert kept.count() == sum(STRICT_LINES.values())
    want = [(line, "2026-01-05") for line, good in STRICT_LINES.items() if not good] + [("odd one out", "2026-01-06")]
    assert sorted(map(tuple, rejected.collect())) == sorted(want)
    batch = requestlog.entries(raw)
    assert kept.select("ts", "query").where("ts IS NOT NULL").count() == batch.where("ts IS NOT NULL").count()


def test_batches_replace_themselves(spark, tmp_path):
    """A batch that is written again, whole or after a failure between its two writes, leaves each line once."""
    write_lines(tmp_path / "log", ['{"ts":"2026-01-01T00:00:00Z"}', "broken"])
    out, rejects = str(tmp_path / "out"), str(tmp_path / "rejects")
    lines = requestlog.read_raw(spark, str(tmp_path / "log"))
    for batch, stream in ((0, "s"), (0, "s"), (1, "s"), (0, "other"), (1, "s")):
        streams.write_batch(lines, batch, out, rejects, stream)
    kept, rejected = divided(spark, out, rejects)
    assert kept.count() == rejected.count() == 3
    assert {r.log_date for r in kept.collect()} == {"2026-01-01"} and {r.log_date for r in rejected.collect()} == {None}


def test_stream_goes_on_and_others_share_its_folders(spark, tmp_path):
    source, paths = tmp_path / "log", [str(tmp_path / x) for x in ("out", "rejects", "checkpoint")]
    for day in ("2026-01-01", "2026-01-02"):
        write_lines(source, [json.dumps(entry(f"{day}T00:00:00.000Z")), "broken"])
        streams.ingest_lines(streams.read_lines(spark, str(source)), *paths).awaitTermination()
    kept, rejected = divided(spark, *paths[:2])
    assert (kept.count(), rejected.count()) == (2, 2)
    streams.ingest_lines(streams.read_lines(spark, str(source)), *paths[:2], str(tmp_path / "second")).awaitTermination()
    kept, rejected = divided(spark, *paths[:2])
    assert (kept.count(), rejected.count()) == (4, 4)


def test_log_requests_are_clamped():
    request = LogRequest(page=0, page_size=10**6)
    assert (request.page, request.page_size, request.offset) == (1, 100, 0)
