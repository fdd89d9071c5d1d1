"""Keys of several columns and inclusions against brute force."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import dependencies, profile


def brute_keys(rows, names, width):
    """Minimal keys of two and more columns, by trying all sets."""
    found = []

    def is_key(places):
        values = [tuple(str(r[i]) for i in places) for r in rows]
        return all(r[i] is not None for r in rows for i in places) and len(set(values)) == len(rows)

    for size in range(1, width + 1):
        for places in combinations(range(len(names)), size):
            if not any(set(k) <= set(places) for k in found) and is_key(places):
                found.append(places)
    return {tuple(sorted(names[i] for i in k)) for k in found if len(k) > 1}


@pytest.mark.parametrize("residue", [1, 7, 1024])
def test_composite_keys(spark, monkeypatch, residue):
    """Sets of two and three columns, with nulls, repeats and a map; a residue of 1 looks at all rows, one of 1024 at hardly any."""
    monkeypatch.setattr(profile, "RESIDUE", residue)
    draw = random.Random(residue)
    names = ["a", "b", "c", "with space", "e", "f"]
    cells = [(x, y, z) for x in range(7) for y in range(7) for z in range(3)]
    rows = [(x, str(y), z, float(y * 3 + z), None if x == y == z == 0 else x * 100 + y * 10 + z, {"k": draw.randint(0, 3)}) for x, y, z in cells]
    pair = [(i % 20, i // 20, i % 3) for i in range(300)]
    tables = {
        "triple": spark.createDataFrame(rows, "a int, b string, c long, `with space` double, e int, f map<string,int>").repartition(3),
        "pair": spark.createDataFrame(pair, "a int, b int, c int"),
        "repeated": spark.createDataFrame(pair + pair[:1], "a int, b int, c int"),
        "single": spark.createDataFrame([(i, i % 5, i % 7) for i in range(35)], "a int, b int, c int"),
        "empty": spark.createDataFrame([], "a int, b int"),
    }
    found = {(r.table_name, tuple(r.columns)) for r in dependencies.composite_keys(tables, width=3).collect()}
    want = {("triple", k) for k in brute_keys(rows, names, 3)} | {("pair", k) for k in brute_keys(pair, "abc", 3)}
    want |= {("single", k) for k in brute_keys([(i, i % 5, i % 7) for i in range(35)], "abc", 3)}
    assert found == want and ("triple", ("a", "with space")) in found and ("single", ("b", "c")) in found
    assert any(len(k) == 3 for _, k in found)


def test_agreeing_rows_spare_larger_sets(spark, monkeypatch):
    """Two rows alike in all columns but one disprove every set without it, so no such set is grouped."""
    monkeypatch.setattr(profile, "RESIDUE", 1)
    rows = [(i, i % 50, i % 50, i % 50, i % 50) for i in range(100)]
    tables = {"t": spark.createDataFrame(rows, "a int, b int, c int, d int, e int")}
    grouped, exact = [], dependencies._exact
    monkeypatch.setattr(dependencies, "_exact", lambda t, level: grouped.extend(x for s in level.values() for x in s) or exact(t, level))
    assert dependencies.composite_keys(tables, width=4).count() == 0  # a alone is a key
    assert grouped == []


def brute_inclusions(tables):
    values = {}
    for name, df in tables.items():
        for f in df.schema:
            kind = dependencies._kind(f.dataType)
            if kind:
                found = {r[0] for r in df.select(F.col(f"`{f.name}`").cast(kind[1])).collect()} - {None}
                values[name, f.name] = kind[0], found
    return {
        (*a, *b) for a, (k, x) in values.items() for b, (l, y) in values.items() if a != b and k == l and x and x <= y
    }


def test_inclusions(spark):
    draw = random.Random(4)
    whole = [(i, draw.randint(0, 40), str(i % 30), draw.random() < 0.5) for i in range(500)]
    tables = {
        "big": spark.createDataFrame(whole, "id long, few int, txt string, flag boolean").repartition(3),
        "small": spark.createDataFrame([(3, "", 1.0, None, [1]), (5, "7", 2.0, None, [2]), (None, None, None, None, None)],
                                       "ref short, txt string, real float, none int, list array<int>"),
        "reals": spark.createDataFrame([(1.0, 7.5, "7"), (2.0, 1.0, "7"), (3.5, 2.0, "7")], "x double, y double, `a b` string"),
        "days": spark.sql("SELECT DATE '2026-01-01' AS d, TIMESTAMP '2026-01-01' AS t UNION ALL SELECT DATE '2026-01-02', null"),
        "more days": spark.sql("SELECT DATE '2026-01-02' AS d"),
        "void": spark.createDataFrame([], "id long"),
    }
    found = [tuple(r) for r in dependencies.inclusions(tables).collect()]
    assert set(found) == brute_inclusions(tables) and len(found) == len(set(found))
    assert ("small", "ref", "big", "id") in found and ("more days", "d", "days", "d") in found and ("small", "real", "reals", "y") in found
    assert dependencies.inclusions({"void": tables["void"]}).count() == 0


def test_sketches_leave_few_pairs_and_no_true_one_out(spark):
    """Of all pairs of large columns sketches leave the true one and none that misses a share of its values."""
    tables = {
        "all": spark.range(60_000).select("id", (F.col("id") * 2).alias("even")),
        "some": spark.range(20_000).select((F.col("id") + 5).alias("within"), (F.col("id") + 59_000).alias("beyond")),
    }
    pairs = {tuple(r) for r in dependencies.inclusion_candidates(tables).collect()}
    assert pairs == {(2, 0)}
    one_missing = {"a": spark.range(30_000), "b": spark.range(1, 30_000)}
    assert (1, 0) in {tuple(r) for r in dependencies.inclusion_candidates(one_missing).collect()}
    assert [tuple(r) for r in dependencies.inclusions(one_missing).collect()] == [("b", "id", "a", "id")]


@pytest.mark.parametrize("columns", [70, 130])
def test_inclusions_of_more_columns_than_a_word_has_bits(spark, columns):
    df = spark.range(3).select(*(F.when(F.lit(True), F.lit(i // 2)).alias(f"c{i}") for i in range(columns)))
    found = {(r.from_column, r.to_column) for r in dependencies.inclusions({"t": df}).collect()}
    assert found == {(f"c{i}", f"c{i ^ 1}") for i in range(columns)}
