"""Child arrays, also of groups too large for one array."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shelfmark import Catalog, PageRequest, RelationSpec, ResourceSpec
from shelfmark.operators import relations

FLAT = RelationSpec("child", "fk", {"v": "v"}, flatten="v")
NESTED = RelationSpec("child", "fk", {"v": "v", "twice": "n * 2"})
OTHER = RelationSpec("other", "fk", {"w": "w"}, flatten="w")


def spec(**found):
    return ResourceSpec("parent", "id", {"title": "id"}, relations=found)


@pytest.fixture(scope="module")
def parents(spark):
    return spark.range(6).select(F.col("id"))


@pytest.fixture(scope="module")
def children(spark):
    """A third of the rows are copies of one value under one key, a third are different
    values under another; the rest is spread, without a parent or without a key."""
    copies = spark.range(300).select(F.lit(1).alias("fk"), F.lit("same").alias("v"), F.lit(1).alias("n"))
    varied = spark.range(300).select(F.lit(2), F.format_string("v%03d", "id"), F.col("id").cast("int"))
    rest = spark.range(300).select((F.col("id") % 2 + 3).cast("int"), F.lit("r"), F.lit(0)).limit(20)
    orphans = spark.range(50).select(F.lit(77), F.lit("orphan"), F.lit(0))
    keyless = spark.range(50).select(F.lit(None).cast("int"), F.lit("none"), F.lit(0))
    return copies.unionAll(varied).unionAll(rest).unionAll(orphans).unionAll(keyless)


@pytest.fixture(scope="module")
def others(spark):
    return spark.createDataFrame([(1, "x"), (1, "y"), (3, "z")], "fk int, w string")


def gathered(items, name):
    """All children by parent, over its parts."""
    found, parts = defaultdict(Counter), defaultdict(list)
    for row in items.collect():
        values = row.attributes[name]
        found[row.externalId] += Counter(
            v if isinstance(v, str) else tuple(v.asDict().items()) for v in values
        )
        parts[row.externalId].append((row.part, row.parts, len(values)))
    return found, parts


def expected(children, value):
    found = defaultdict(Counter)
    for row in children.where("fk BETWEEN 0 AND 5").collect():
        found[str(row.fk)][value(row)] += 1
    return found


@pytest.mark.parametrize("array_rows", [40, 1_000_000])
def test_every_child_is_kept_once(parents, children, others, array_rows):
    catalog = Catalog(
        spec(flat=FLAT, nested=NESTED, other=OTHER),
        parents,
        {"child": children, "other": others},
        array_rows,
    )
    items = catalog.items().cache()
    flat, parts = gathered(items, "flat")
    assert +flat["0"] == Counter() and flat["0"].keys() == set()
    truth = expected(children, lambda r: r.v)
    assert {k: v for k, v in flat.items() if v} == truth
    nested, _ = gathered(items, "nested")
    assert {k: v for k, v in nested.items() if v} == expected(
        children, lambda r: (("v", r.v), ("twice", r.n * 2))
    )
    other, _ = gathered(items, "other")
    assert {k: v for k, v in other.items() if v} == {"1": Counter("xy"), "3": Counter("z")}
    for key, found in parts.items():
        assert sorted(p for p, _, _ in found) == list(range(found[0][1])), key
    assert parts.keys() == {str(n) for n in range(6)}
    if array_rows == 40:
        assert {k for k, v in parts.items() if len(v) > 1} == {"1", "2"}
        assert max(size for v in parts.values() for _, _, size in v) < 6 * array_rows
    else:
        assert all(len(v) == 1 for v in parts.values())
    items.unpersist()


def test_parts_on_a_page_and_in_a_lookup(parents, children):
    catalog = Catalog(spec(flat=FLAT), parents, {"child": children}, 40)
    page = catalog.page(PageRequest(page_size=100, sort_by="id"))
    ids = parents.select((F.col("id") % 3).alias("id"))
    for items in (page, catalog.lookup(ids), catalog.item("1")):
        flat, parts = gathered(items, "flat")
        assert flat["1"] == Counter({"same": 300}) and len(parts["1"]) == 8


def test_long_texts_are_split_by_their_bytes(spark, parents, monkeypatch):
    monkeypatch.setattr(relations, "ARRAY_BYTES", 4000)
    long = F.when(F.col("id") % 2 == 0, F.repeat(F.lit("x"), F.lit(300)))
    long = long.otherwise(F.format_string("%0300d", "id"))
    child = spark.range(200).select(F.lit(1).alias("fk"), long.alias("v"), F.lit(1).alias("n"))
    truth = Counter(r.v for r in child.collect())
    for relation in (FLAT, RelationSpec("child", "fk", {"v": "v", "n": "n"})):
        catalog = Catalog(spec(found=relation), parents, {"child": child})
        found, parts = gathered(catalog.items(), "found")
        plain = {k if isinstance(k, str) else dict(k)["v"]: n for k, n in found["1"].items()}
        assert plain == truth
        assert len(parts["1"]) == 15 and max(size for _, _, size in parts["1"]) < 60
        assert len(parts["0"]) == 1


def test_arrays_are_sorted(parents, children):
    catalog = Catalog(spec(nested=NESTED), parents, {"child": children})
    row = catalog.items().where("externalId = '2'").first()
    assert [c.v for c in row.attributes.nested] == [f"v{n:03d}" for n in range(300)]


def test_child_filter_is_one_whole(parents, children):
    relation = RelationSpec("child", "fk", {"v": "v"}, flatten="v", filter="v = 'r' OR v = 'same'")
    catalog = Catalog(spec(flat=relation), parents, {"child": children})
    flat, _ = gathered(catalog.items(), "flat")
    assert {k: sum(v.values()) for k, v in flat.items()} == {
        "0": 0, "1": 300, "2": 0, "3": 10, "4": 10, "5": 0,
    }


def test_keys_of_other_types_match(spark):
    parents = spark.createDataFrame([(1,), (2,)], "id bigint")
    child = spark.createDataFrame([("1", "a"), ("x", "b"), ("2", "c")], "fk string, v string")
    text_parents = parents.select(F.col("id").cast("string").alias("id"))
    number_child = spark.createDataFrame([(1, "a"), (2, "c")], "fk int, v string")
    for main, source in ((parents, child), (parents, number_child), (text_parents, number_child)):
        catalog = Catalog(spec(flat=FLAT), main, {"child": source})
        for items in (catalog.items(), catalog.page(), catalog.lookup(main)):
            flat, _ = gathered(items, "flat")
            assert flat == {"1": Counter("a"), "2": Counter("c")}


def test_reference_key_other_than_the_id(spark, others):
    main = spark.createDataFrame([(10, 1), (11, 1), (12, 3)], "id int, ref int")
    relation = RelationSpec("other", "fk", {"w": "w"}, reference_key="ref", flatten="w")
    catalog = Catalog(spec(tags=relation), main, {"other": others})
    for items in (catalog.items(), catalog.page()):
        flat, _ = gathered(items, "tags")
        assert flat == {"10": Counter("xy"), "11": Counter("xy"), "12": Counter("z")}


def test_relation_without_fields(spark, parents, others):
    catalog = Catalog(spec(r=RelationSpec("other", "fk", {})), parents, {"other": others})
    sizes = {
        r.externalId: r.n
        for r in catalog.items().select("externalId", F.size("attributes.r").alias("n")).collect()
    }
    assert sizes["1"] == 2 and sizes["0"] == 0


@pytest.mark.parametrize("broadcast_rows", [0, 1, 1000])
def test_more_large_groups_than_may_be_broadcast(spark, parents, children, monkeypatch, broadcast_rows):
    """With room for one key only the largest group is broadcast, with room for none no
    key is; the rows are the same."""
    bigger = spark.range(900).select(F.lit(4).alias("fk"), F.format_string("w%d", "id").alias("v"), F.lit(1).alias("n"))
    whole = children.unionByName(bigger)
    monkeypatch.setattr(relations, "BROADCAST_ROWS", broadcast_rows)
    catalog = Catalog(spec(flat=FLAT), parents, {"child": whole}, 40)
    flat, parts = gathered(catalog.items(), "flat")
    assert {k: v for k, v in flat.items() if v} == expected(whole, lambda r: r.v)
    assert {k for k, v in parts.items() if len(v) > 1} == {"1", "2", "4"}
    ids = spark.createDataFrame([("1",), ("2",), ("3",), ("8",)], "id string")
    flat, _ = gathered(catalog.lookup(ids).where("status_code = 200"), "flat")
    truth = expected(whole, lambda r: r.v)
    assert flat == {k: truth[k] for k in ("1", "2", "3")}


@pytest.mark.parametrize("array_rows", [7, 40, 1_000_000])
def test_parts_are_runs_of_the_sorted_array(parents, children, array_rows):
    catalog = Catalog(spec(flat=FLAT, nested=NESTED), parents, {"child": children}, array_rows)
    joined = defaultdict(lambda: ([], []))
    for row in sorted(catalog.items().collect(), key=lambda r: (r.externalId, r.part)):
        joined[row.externalId][0].extend(row.attributes.flat)
        joined[row.externalId][1].extend(tuple(x) for x in row.attributes.nested)
    assert joined["2"][0] == [f"v{n:03d}" for n in range(300)]
    for flat, nested in joined.values():
        assert flat == sorted(flat) and nested == sorted(nested)


def test_children_as_rows(parents, children):
    catalog = Catalog(spec(flat=FLAT, nested=NESTED), parents, {"child": children}, 40)
    found = defaultdict(Counter)
    for row in catalog.child_rows("flat").collect():
        found[row.externalId][row.child] += 1
    assert found == expected(children, lambda r: r.v)
    assert catalog.child_rows("nested").select("child.twice").count() == sum(map(Counter.total, found.values()))


@pytest.mark.parametrize("array_rows", [2, 1000])
def test_child_fields_may_be_maps(spark, parents, array_rows):
    rows = [(1, {"a": n % 3, "b": 1}) for n in range(9)] + [(2, None)]
    child = spark.createDataFrame(rows, "fk int, m map<string,int>")
    relation = RelationSpec("child", "fk", {"m": "m"})
    catalog = Catalog(spec(maps=relation), parents, {"child": child}, array_rows)
    values = defaultdict(list)
    for row in sorted(catalog.items().collect(), key=lambda r: (r.externalId, r.part)):
        values[row.externalId].extend(x.m for x in row.attributes.maps)
    assert values["1"] == [{"a": n, "b": 1} for n in range(3) for _ in range(3)]
    assert values["2"] == [None] and values["0"] == []


def test_sizes_are_counted_once(parents, children, monkeypatch):
    stored = []
    whole = relations.store
    monkeypatch.setattr(relations, "store", lambda df, label: stored.append(label) or whole(df, label))
    Catalog(spec(flat=FLAT), parents, {"child": children}, 1_000_000).items().collect()
    assert stored == ["large-groups"]


@pytest.mark.parametrize("words", [1, 4, 1 << 20])
def test_key_filter_drops_no_child(spark, monkeypatch, words):
    """Few words let more children through, which the join drops; no child of a parent is lost."""
    monkeypatch.setattr(relations, "FILTER_WORDS", words)
    rows = spark.range(2000).select((F.col("id") % 500).alias("_key"), F.col("id").alias("value"))
    keys = spark.range(0, 500, 50).select(F.col("id").alias("_key")).union(spark.sql("SELECT CAST(null AS long)"))
    found = relations.key_filter(keys)
    assert found.count() <= min(words, 10)
    kept = relations.may_match(rows, found)
    assert kept.columns == rows.columns
    assert kept.where("_key % 50 = 0").count() == 40
    assert kept.count() <= 60 if words > 4 else kept.count() <= 2000


@pytest.mark.parametrize("array_rows", [100, 100_000])
def test_base_filtered_items_have_all_their_children(parents, children, others, array_rows):
    relations_ = {"flat": FLAT, "nested": NESTED, "other": OTHER}
    shown = ResourceSpec("parent", "id", {"title": "id"}, base_filter="id IN (1, 3, 5)", relations=relations_)
    sources = {"child": children, "other": others}
    all_found = gathered(Catalog(spec(**relations_), parents, sources, array_rows).items(), "flat")[0]
    found = gathered(Catalog(shown, parents, sources, array_rows).items(), "flat")[0]
    assert found == {k: v for k, v in all_found.items() if k in "135"} and sum(found["1"].values()) == 300


def test_filter_of_text_keys(spark):
    main = spark.createDataFrame([("a", 1), ("b", 2), (None, 1)], "id string, n int")
    child = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z"), (None, "w")], "fk string, v string")
    shown = ResourceSpec("parent", "id", {"title": "id"}, base_filter="n = 1", relations={"flat": FLAT})
    items = Catalog(shown, main, {"child": child}).items().collect()
    assert sorted((r.externalId, r.attributes["flat"]) for r in items) == [("", []), ("a", ["x"])]
