"""What the plans of the operators must look like."""

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from shelfmark import Catalog, FilterSpec, PageRequest, RelationSpec, ResourceSpec
from shelfmark.operators import ranking

LINES = RelationSpec("lines", "fk", {"v": "v"}, flatten="v")
SPEC = ResourceSpec(
    table="main",
    id_column="id",
    fields={"title": "name"},
    updated_at_column="updated",
    base_filter="kind <> 'x'",
    searchable_columns=("name",),
    filterable_columns={"size": FilterSpec("size", "number"), "kind": FilterSpec("kind", "string")},
    relations={"lines": LINES},
)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    main = spark.range(2000).select(
        "id",
        F.format_string("n%d", "id").alias("name"),
        (F.col("id") % 9).cast("int").alias("size"),
        F.lit("k").alias("kind"),
        F.expr("TIMESTAMP_NTZ '2026-01-01' + make_dt_interval(0, 0, 0, id % 500)").alias("updated"),
        F.lit("wide").alias("unused"),
    )
    main.write.parquet(f"{folder}/main")
    lines = spark.range(6000).select((F.col("id") % 2500).alias("fk"), F.lit("v").alias("v"), F.lit(1).alias("w"))
    lines.write.parquet(f"{folder}/lines")
    return spark.read.parquet(f"{folder}/main"), spark.read.parquet(f"{folder}/lines")


@pytest.fixture
def catalog(stored):
    main, lines = stored
    return Catalog(SPEC, main, {"lines": lines})


def test_filters_reach_the_scan_and_columns_are_pruned(catalog, plan):
    params = {"filter.size": "7", "filter.kind": "k", "updatedSince": "2026-01-01T00:01:00Z"}
    text = plan(catalog.rows(PageRequest.parse(SPEC, params)).select("id"))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "EqualTo(size,7)" in pushed and "EqualTo(kind,k)" in pushed
    assert "GreaterThanOrEqual(updated,2026-01-01T00:01)" in pushed
    assert "unused" not in text and "name" not in re.search(r"ReadSchema: (.*)", text).group(1)


def test_a_page_is_a_top_k(catalog, plan):
    text = plan(catalog.page_rows(PageRequest.parse(SPEC, {"page": "3"})))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text
    assert "unused" not in text


def test_a_page_reads_only_its_children(catalog, plan):
    text = plan(catalog.page(PageRequest.parse(SPEC, {"pageSize": "3"})))
    assert "In(fk, [" in text and "LocalTableScan" in text
    assert re.search(r"ReadSchema: struct<fk:bigint,v:string>", text)


def test_search_stays_on_the_jvm(catalog, plan):
    text = plan(catalog.rows(PageRequest.parse(SPEC, {"search": "N1"})))
    assert "Contains(lower(name" in text and "Python" not in text


def test_children_are_grouped_before_the_join(catalog, plan, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(catalog.items())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("hashpartitioning") == 2
    assert text.index("SortMergeJoin") < text.index("ObjectHashAggregate")


def test_bucketed_tables_join_without_a_shuffle(spark, stored, plan):
    for name, frame, key in (("b_main", stored[0], "id"), ("b_lines", stored[1], "fk")):
        frame.write.mode("overwrite").bucketBy(4, key).sortBy(key).saveAsTable(name)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        catalog = Catalog(SPEC, spark.table("b_main"), {"lines": spark.table("b_lines")})
        text = plan(catalog.items())  # the filter of the parents' keys is broadcast, nothing is shuffled
        assert text.count("Exchange") == text.count("BroadcastExchange") and "partitioning" not in text.replace("Partitioning: 4", "")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("b_main", "b_lines"):
            spark.sql(f"DROP TABLE {name}")


def test_base_filter_cuts_the_child_scan(spark, stored, plan):
    """The filter of the parents' keys stands between the child's scan and the shuffle that groups it, and a bucketed child
    is not shuffled for it."""
    spec = replace(SPEC, base_filter="id < 40")
    for name, frame, key in (("f_main", stored[0], "id"), ("f_lines", stored[1], "fk")):
        frame.write.mode("overwrite").bucketBy(4, key).sortBy(key).saveAsTable(name)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        items = Catalog(spec, stored[0], {"lines": stored[1]}).items()
        text = plan(items)
        assert text.index("BroadcastHashJoin") < text.index("Exchange\n") and "_word" in text
        bucketed = plan(Catalog(spec, spark.table("f_main"), {"lines": spark.table("f_lines")}).items())
        assert "hashpartitioning" not in bucketed and "_word" in bucketed
        whole = Catalog(replace(SPEC, base_filter=None), stored[0], {"lines": stored[1]}).items().where("cast(externalId as int) < 40")
        assert sorted(map(str, items.collect())) == sorted(map(str, whole.collect())) and items.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("f_main", "f_lines"):
            spark.sql(f"DROP TABLE {name}")


def test_ranking_has_no_one_partition_step(catalog, plan, monkeypatch):
    text = plan(catalog.all_pages())
    assert "SinglePartition" not in text and "Window" not in text and "parquet" in text
    monkeypatch.setattr(ranking, "TOP_ROWS", 5)
    text = plan(catalog.page_rows(PageRequest.parse(SPEC, {"page": "9"})))
    assert "Window" not in text


def test_deep_pages_move_no_rows(spark, plan, monkeypatch):
    monkeypatch.setattr(ranking, "TOP_ROWS", 100)
    stored = []
    monkeypatch.setattr(ranking, "store", lambda df, label: stored.append(label) or df)
    rows = spark.range(100_000).selectExpr("id", "if(id % 10 = 0, null, id % 50) AS k")
    page = ranking.cut_page(rows, [("k", False), ("id", True)], 60_000, 100)
    expected = [(x, x % 50) for x in sorted((x for x in range(100_000) if x % 10), key=lambda x: (-(x % 50), x))]
    assert [tuple(r) for r in page.collect()] == expected[60_000:60_100]
    text = plan(page)
    assert not stored and "rangepartitioning" not in text and "TakeOrderedAndProject" in text
    last = ranking.cut_page(rows, [("k", False), ("id", True)], 99_950, 100).collect()
    assert [r.id for r in last] == list(range(99_500, 100_000, 10))
    assert ranking.cut_page(rows, [("k", True), ("id", True)], 200_000, 10).collect() == []


def test_deep_page_of_equal_rows_is_ranked(spark, monkeypatch):
    monkeypatch.setattr(ranking, "TOP_ROWS", 100)
    rows = spark.range(5000).selectExpr("1 AS k")
    assert ranking.cut_page(rows, [("k", False)], 2000, 10).count() == 10
