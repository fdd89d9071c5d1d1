import pytest
from pyspark.sql import functions as F

from shelfmark import Catalog, RelationSpec, ResourceSpec
from shelfmark.operators import lookup, relations

SPEC = ResourceSpec(
    "t", "id", {"title": "name"}, base_filter="name <> 'hidden'",
    relations={"tags": RelationSpec("tag", "fk", {"v": "v"}, flatten="v")},
)


@pytest.fixture
def catalog(spark):
    main = spark.createDataFrame(
        [(1, "a", "x"), (2, "b", "y"), (2, "b", "x"), (3, "hidden", "x"), (4, "d", "x")],
        "id int, name string, unused string",
    )
    tags = spark.createDataFrame([(1, "p"), (1, "q"), (4, "r"), (9, "s")], "fk int, v string")
    return Catalog(SPEC, main, {"tag": tags})


@pytest.fixture
def ids(spark):
    asked = ["1"] * 500 + ["2", "3", "999", "zz", "04", None, None]
    return spark.createDataFrame([(i,) for i in asked], "id string")


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_answers(catalog, ids, monkeypatch, broadcast_rows):
    monkeypatch.setattr(relations, "BROADCAST_ROWS", broadcast_rows)
    answers = {r.id: r for r in catalog.lookup(ids).collect()}
    status = {i: r.status_code for i, r in answers.items()}
    assert status == {"1": 200, "2": 200, "3": 404, "999": 404, "zz": 404, "04": 200, None: 404}
    assert answers["1"].requests == 500 and answers[None].requests == 2
    assert answers["1"].attributes.tags == ["p", "q"] and answers["2"].attributes.tags == []
    assert answers["04"].externalId == "4" and answers["999"].externalId is None


def test_hits_and_misses_are_all_ids(catalog, ids):
    answers, missed = catalog.lookup(ids), lookup.misses(catalog, ids)
    hits = answers.where("status_code = 200").count()
    assert {r.id for r in missed.collect()} == {"3", "999", "zz", None}
    assert hits + missed.count() == ids.distinct().count()


@pytest.mark.parametrize("broadcast_rows", [0, 2, 1000])
def test_log_entries(catalog, ids, monkeypatch, broadcast_rows):
    """With room for two, only the answers to the ids asked for most are broadcast."""
    monkeypatch.setattr(relations, "BROADCAST_ROWS", broadcast_rows)
    monkeypatch.setattr(lookup, "ARRAY_ROWS", 40)
    ids = ids.unionAll(ids.sparkSession.createDataFrame([("gone",)] * 300, "id string"))
    requests = ids.select(
        F.lit("2026-01-01T00:00:00.000Z").alias("ts"), "id", F.lit(None).cast("string").alias("apiKey"),
        F.lit(5).alias("ms"), F.lit("::1").alias("ip"),
    )
    entries = lookup.lookup_entries(catalog, requests, "/items")
    assert entries.count() == 807
    found = entries.groupBy("path", "status", "items", "apiKey").count().collect()
    counted = {(r.path, r.status, r["items"]): r["count"] for r in found}
    assert counted == {
        ("/items/1", 200, 1): 500, ("/items/2", 200, 1): 1, ("/items/3", 404, 0): 1,
        ("/items/999", 404, 0): 1, ("/items/zz", 404, 0): 1, ("/items/04", 200, 1): 1, ("/items/gone", 404, 0): 300,
        ("/items/", 404, 0): 2,
    }
    assert {r.apiKey for r in found} == {"unknown"}


def test_main_rows_may_hold_maps(spark):
    from shelfmark import Catalog, ResourceSpec

    main = spark.createDataFrame([(1, {"a": 2}), (1, {"a": 1}), (2, None)], "id int, m map<string,int>")
    catalog = Catalog(ResourceSpec("t", "id", {"title": "id"}, attributes={"m": "m"}), main)
    ids = spark.createDataFrame([("1",), ("junk",), (None,), ("2",), ("9",)], "id string")
    found = {r.id: r for r in catalog.lookup(ids).collect()}
    assert found["1"].attributes.m == {"a": 1} and found["2"].attributes.m is None
    assert {k: r.status_code for k, r in found.items()} == {"1": 200, "2": 200, "junk": 404, None: 404, "9": 404}
