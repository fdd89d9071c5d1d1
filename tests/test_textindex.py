"""The text index against the search itself."""

import re

import pytest
from pyspark.sql import functions as F

from shelfmark import Catalog, FilterSpec, PageRequest, ResourceSpec
from shelfmark.operators import textindex
from shelfmark.operators.textindex import BLOCK, TextIndex, required, runs

SPEC = ResourceSpec(
    "t", "id", {"title": "name"}, base_filter="id <> 3", searchable_columns=("name", "code"),
    filterable_columns={"min": FilterSpec("id", "gte")},
)
ODD = ["100%", "a_b", "back\\slash", "ΟΔΟΣ", "Straße", "日本語テキスト", "🙂🙃🙂", "İstanbul", "", None, "  two  spaces ", "line\nbreak"]


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    """Four hundred rows in blocks of twenty, words that stand in few of them, odd texts in one."""
    rows = [(i, f"Item {'zebra' if i // 20 == 7 else 'horse'} number {i // 10}", i * 11) for i in range(400)]
    rows += [(1000 + i, t, None) for i, t in enumerate(ODD)]
    main = spark.createDataFrame(rows, "id long, name string, code int").coalesce(1)
    catalog, path = Catalog(SPEC, main), str(tmp_path_factory.mktemp("text") / "index")
    catalog.index_text(path, block_rows=20)
    return catalog, TextIndex.open(spark, path)


def test_runs_and_required_runs():
    assert runs("abcd") == {"abc", "bcd"} and runs("ab") == {"ab"} and runs("") == set()
    assert required("%zeb_a%hor%") == {"zeb", "a", "hor"}
    assert required("%10\\%%") == {"10%"} and required("%_%") == set() and required("%a\\_b\\\\%") == {"a_b", "_b\\"}


@pytest.mark.parametrize(
    "search",
    ["zebra", "ZEB", "z", "r_m", "_", "%", "horse%39", "100\\%", "a\\_b", "back\\\\slash", "οδος", "ΟΔΟΣ", "straße", "STRASSE", "本語",
     "🙃", "i̇stanbul", "İSTANBUL", "two  sp", "e\nb", "line_break", "no such text", "429", "1_1", "\\z\\e"],
)
def test_search_by_index_equals_search(indexed, search):
    catalog, index = indexed
    request = PageRequest.parse(SPEC, {"search": search, "filter.min": "2"})
    want = sorted(map(str, catalog.rows(request).collect()))
    found = catalog.indexed_rows(index, request)
    assert found.columns == catalog.main.columns
    assert sorted(map(str, found.collect())) == want


def test_blocks_without_a_run_are_not_read(indexed, plan):
    catalog, index = indexed
    assert index.blocks == 21
    assert index.candidates({"name": "zebra"}).count() == 1
    assert index.candidates({"name": "zebra", "code": "4389"}).count() == 2
    assert index.candidates({"name": "%_%"}) is None and index.candidates({"id": "5"}) is None
    request = PageRequest.parse(SPEC, {"search": "zebra"})
    text = plan(catalog.indexed_rows(index, request))
    assert BLOCK in re.search(r"PartitionFilters: \[(.*)\]", text)[1]
    assert index.cut({"name": "zebra", "code": "zebra"}).count() == 20
    lookup = plan(index.candidates({"name": "zebra"}))
    assert "In(run" in lookup or "run, [" in lookup  # the runs reach the scan of the postings


def test_more_blocks_than_are_listed(indexed, monkeypatch):
    catalog, index = indexed
    monkeypatch.setattr(textindex, "MOST_LISTED", 3)
    request = PageRequest.parse(SPEC, {"search": "horse"})
    assert catalog.indexed_rows(index, request).count() == catalog.rows(request).count() == 379


def test_index_of_no_rows_and_no_columns(spark, indexed, tmp_path):
    catalog, _ = indexed
    empty = Catalog(SPEC, catalog.main.limit(0)).index_text(str(tmp_path / "empty"))
    assert empty.blocks == 0 and empty.cut({"name": "x"}).count() == 0
    bare = TextIndex.build(catalog.main, [], str(tmp_path / "bare"))
    assert bare.candidates({"name": "zebra"}) is None and bare.cut({"name": "zebra"}).count() == catalog.main.count()
    assert bare.rows.where(F.col(BLOCK).isNull()).count() == 0
