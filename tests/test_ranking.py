import json
from datetime import datetime, timedelta
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shelfmark import Catalog, PageRequest, ResourceSpec
from shelfmark.operators import ranking
from shelfmark.operators.rankindex import RankIndex

SPEC = ResourceSpec("t", "id", {"title": "k"}, updated_at_column="updated")


@pytest.fixture(scope="module")
def nulls_ties(spark):
    start = datetime(2026, 1, 1)
    rows = [
        (n, None if n % 7 == 0 else n % 5, None if n % 11 == 0 else start + timedelta(hours=n % 13))
        for n in range(997)
    ]
    return spark.createDataFrame(rows, "id int, k int, updated timestamp").repartition(5)


def in_order(frame, key, ascending):
    rows = frame.collect()
    filled = sorted((r for r in rows if r[key] is not None), key=lambda r: r.id)
    filled.sort(key=lambda r: r[key], reverse=not ascending)
    empty = sorted((r for r in rows if r[key] is None), key=lambda r: r.id)
    return [r.id for r in filled + empty]


@pytest.mark.parametrize("key", ["k", "updated"])
@pytest.mark.parametrize("direction", ["asc", "desc"])
@pytest.mark.parametrize("top_rows", [10, 100_000])
def test_pages_follow_the_order(nulls_ties, monkeypatch, key, direction, top_rows):
    monkeypatch.setattr(ranking, "TOP_ROWS", top_rows)
    truth = in_order(nulls_ties, key, direction == "asc")
    catalog = Catalog(SPEC, nulls_ties)
    params = {"sortBy": key, "sortDirection": direction, "pageSize": "100"}
    for page in (1, 5, 10, 11):
        request = PageRequest.parse(SPEC, params | {"page": str(page)})
        found = [int(r.externalId) for r in catalog.page(request).collect()]
        assert found == truth[(page - 1) * 100 : page * 100]


def test_all_pages_are_disjoint_and_whole(nulls_ties):
    catalog = Catalog(SPEC, nulls_ties)
    request = PageRequest.parse(SPEC, {"sortBy": "k", "pageSize": "30"})
    pages = catalog.all_pages(request)
    rows = pages.orderBy("rank").collect()
    assert [r.id for r in rows] == in_order(nulls_ties, "k", False)
    assert [r["rank"] for r in rows] == list(range(1, 998))
    assert [r.page for r in rows] == [n // 30 + 1 for n in range(997)]
    summary = catalog.summary(request).first()
    sizes = pages.groupBy("page").count().agg(F.sum("count"), F.count("*")).first()
    assert (summary.total, summary.total_pages) == (sizes[0], sizes[1]) == (997, 34)


def test_one_key_for_most_rows(spark):
    frame = spark.range(5000).select("id", F.when(F.col("id") < 4000, 1).otherwise(2).alias("k"))
    spec = ResourceSpec("t", "id", {"title": "k"})
    pages = Catalog(spec, frame).all_pages(PageRequest(sort_by="k", ascending=True)).cache()
    assert [r[0] for r in pages.orderBy("rank").select("id").collect()] == list(range(5000))
    pages.unpersist()


def test_no_rows(spark):
    frame = spark.createDataFrame([], "id int, k int, updated timestamp")
    assert Catalog(SPEC, frame).all_pages().count() == 0


@pytest.fixture(scope="module")
def wide_index(spark, tmp_path_factory):
    rows = spark.range(200_000).select("id", (F.col("id") * 7919 % 200_003).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    path = str(tmp_path_factory.mktemp("index") / "wide")
    RankIndex.build(rows, [("k", False), ("id", True)], path, {"of": "wide"}, group_bytes=1 << 16)
    return rows, path


def test_deep_page_of_an_index_reads_few_row_groups(spark, wide_index, plan):
    """Of the row groups of all ranges under five in a hundred hold any place of a page in the middle."""
    rows, path = wide_index
    index = RankIndex.open(spark, path)
    assert index.total == 200_000 and json.loads(index.about) == {"of": "wide"}
    page = index.cut(123_400, 100)
    want = [tuple(r) for r in rows.orderBy(F.col("k").desc(), "id").offset(123_400).limit(100).collect()]
    assert [tuple(r) for r in page.collect()] == want
    text = plan(page)
    assert "PartitionFilters: [" in text and "_range" in text.split("PartitionFilters: ")[1].splitlines()[0]
    assert "_place" in text.split("PushedFilters: ")[1].splitlines()[0]

    total = read = 0
    wanted = [(n, 123_400 - b, 123_499 - b) for n, b, size in index.starts if b <= 123_499 and b + size > 123_400]
    for file in Path(path, "rows").rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index("_place")
        for group in range(meta.num_row_groups):
            stats = meta.row_group(group).column(at).statistics
            total += 1
            read += any(file.parent.name == f"_range={n}" and stats.min <= last and stats.max >= first for n, first, last in wanted)
    assert total >= 60 and read <= 0.05 * total


def test_ranks_of_an_index(wide_index, spark):
    rows, path = wide_index
    ranked = RankIndex.open(spark, path).ranked()
    assert ranked.columns == [*rows.columns, "rank"]
    assert ranked.orderBy("rank").select("id").limit(50).collect() == rows.orderBy(F.col("k").desc(), "id").select("id").limit(50).collect()
    assert ranked.agg(F.count("rank"), F.min("rank"), F.max("rank"), F.count_distinct("rank")).first()[:] == (200_000, 1, 200_000, 200_000)


@pytest.mark.parametrize("direction", ["asc", "desc"])
def test_indexed_pages_equal_pages(spark, nulls_ties, tmp_path, direction):
    catalog = Catalog(SPEC, nulls_ties)
    params = {"sortBy": "k", "sortDirection": direction, "pageSize": "100"}
    index = catalog.index_pages(str(tmp_path / "i"), PageRequest.parse(SPEC, params))
    for page in ("1", "4", "10", "12"):
        request = PageRequest.parse(SPEC, params | {"page": page})
        assert catalog.indexed_page(index, request).collect() == catalog.page(request).collect()
        assert catalog.indexed_summary(index, request).collect() == catalog.summary(request).collect()
    with pytest.raises(ValueError):
        catalog.indexed_page(index, PageRequest.parse(SPEC, params | {"sortBy": "id"}))


def test_index_of_no_rows(spark, nulls_ties, tmp_path):
    index = RankIndex.build(nulls_ties.limit(0), [("id", True)], str(tmp_path / "none"))
    assert index.total == 0 and index.cut(0, 10).count() == 0 and index.ranked().count() == 0
