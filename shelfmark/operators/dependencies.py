"""What the data says about sets of columns: keys of several columns, and columns whose values all occur in another."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.columns import INTEGRAL, TEXT, backtick, sql_string
from shelfmark.operators import profile
from shelfmark.session import store

#: Sets of columns looked for in one table at most; more would make a plan too long for one pass.
MOST_SETS = 2000

Set = frozenset[int]


def composite_keys(
    tables: Mapping[str, DataFrame], width: int = 2, singles: DataFrame | None = None
) -> DataFrame:
    """The minimal keys of 2 to ``width`` columns: ``table_name`` and ``columns``, sorted by name.

    A key has no nulls and no combination twice, and no part of it is a key. ``singles`` is what ``candidate_keys``
    has found, if it is known.

    Sets are tried level by level. Two passes that move next to nothing disprove most of a level: one finds the greatest hash of
    each set and counts it (a repeat of which disproves sets of few values), one groups the rows of a
    hash residue. Two rows that agree on a set there are compared in all columns, and every set
    within what they agree on is no key either, on this level and the later ones. What is left is grouped as it is.
    """
    spark = next(iter(tables.values())).sparkSession
    singles = profile.candidate_keys(tables) if singles is None else singles
    known = defaultdict(set)
    for row in singles.where("is_key").collect():
        known[row["table_name"]].add(row["ordinal"] - 1)
    columns = {name: [i for i in filled if i not in known[name]] for name, filled in _filled(tables).items()}
    agreed: dict[str, list[Set]] = defaultdict(list)
    keys: dict[str, list[Set]] = defaultdict(list)
    for size in range(2, width + 1):
        level = {
            name: _open(map(frozenset, combinations(found, size)), keys[name], agreed[name]) for name, found in columns.items()
        }
        for name, sets in level.items():
            if len(sets) > MOST_SETS:
                raise ValueError(f"{len(sets)} sets of {size} columns of {name}; at most {MOST_SETS}")
        few = _repeated_greatest(tables, level)
        for name in few:
            agreed[name] += few[name]
            level[name] = _open(level[name], keys[name], agreed[name])
        for name, alike in _agreements(tables, level):
            agreed[name].append(alike)
        level = {name: _open(sets, keys[name], agreed[name]) for name, sets in level.items()}
        for name, found in _exact(tables, level):
            keys[name].append(found)
    rows = [
        (name, sorted(tables[name].columns[i] for i in found)) for name, sets in keys.items() for found in sets
    ]
    return spark.createDataFrame(rows, "table_name string, columns array<string>")


def _open(sets: Iterable[Set], keys: list[Set], agreed: list[Set]) -> list[Set]:
    """Sets that may still be minimal keys: they hold no key and lie in nothing that two rows agree on."""
    return [x for x in sets if not any(k <= x for k in keys) and not any(x <= a for a in agreed)]


def _union(frames: list[DataFrame]) -> list:
    return reduce(DataFrame.unionAll, frames).collect() if frames else []


def _filled(tables: Mapping[str, DataFrame]) -> dict[str, list[int]]:
    """The columns of each table, by place, that have no nulls."""
    found = profile.column_profile(tables, distinct=False).where("filled = row_count").collect()
    places = defaultdict(list)
    for row in found:
        places[row["table_name"]].append(row["ordinal"] - 1)
    return {name: sorted(places[name]) for name in tables}


def _hashed(df: DataFrame, sets: list[Set]) -> DataFrame:
    """``h``, the hashes of the columns that the sets hold by place, and the hash of each set as ``s0``, ``s1``..."""
    used = sorted(frozenset().union(*sets))
    rows = df.select(*(F.xxhash64(profile._comparable(df.schema[i])).alias(f"h{i}") for i in used))
    each = [F.xxhash64(*(f"h{i}" for i in sorted(x))).alias(f"s{n}") for n, x in enumerate(sets)]
    return rows.select(F.array(*(f"h{i}" for i in used)).alias("h"), *each)


def _repeated_greatest(tables: Mapping[str, DataFrame], level: dict[str, list[Set]]) -> dict[str, list[Set]]:
    """Sets that hold the combination with the greatest hash more than once; aggregates without groups."""
    wanted = {name: sets for name, sets in level.items() if sets}

    def packed(name: str, values: list[Column], of: str) -> DataFrame:
        own = _hashed(tables[name], wanted[name]).agg(F.array(*values).alias(of))
        return own.select(F.lit(name).alias("table_name"), of)

    most = dict(map(tuple, _union([packed(n, [F.max(f"s{i}") for i in range(len(s))], "most") for n, s in wanted.items()])))
    counts = _union([
        packed(n, [F.count_if(F.col(f"s{i}") == F.lit(most[n][i])) for i in range(len(s))], "counts")
        for n, s in wanted.items() if most[n][0] is not None
    ])
    return {row["table_name"]: [x for x, n in zip(wanted[row["table_name"]], row["counts"]) if n > 1] for row in counts}


def _agreements(tables: Mapping[str, DataFrame], level: dict[str, list[Set]]) -> list[tuple[str, Set]]:
    """For each set that repeats in its hash residue the columns that two rows with one combination agree on.

    The columns' hashes, of 64 bits each, name the combination together.
    """
    looked = []
    for name, sets in level.items():
        if not sets:
            continue
        each = [
            F.when(F.pmod(f"s{n}", F.lit(profile.RESIDUE)) == 0, F.struct(F.lit(n).alias("n"), F.col(f"s{n}").alias("s")))
            for n in range(len(sets))
        ]
        rows = _hashed(tables[name], sets).select("h", F.explode(F.array_compact(F.array(*each))).alias("x"))
        pairs = rows.groupBy("x.n", "x.s").agg(F.min("h").alias("a"), F.max("h").alias("b"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
        same = F.zip_with("a", "b", lambda p, q: p == q)
        pairs = pairs.select("n", F.transform(same, lambda x: x.cast("int")).alias("same"))
        looked.append(pairs.groupBy("n").agg(F.max("same").alias("same")).select(F.lit(name).alias("table_name"), "n", "same"))
    found = []
    for row in _union(looked):
        sets = level[row["table_name"]]
        used = sorted(frozenset().union(*sets))
        alike = frozenset(i for i, x in zip(used, row["same"]) if x)
        if sets[row["n"]] <= alike:
            found.append((row["table_name"], alike))
    return found


def _exact(tables: Mapping[str, DataFrame], level: dict[str, list[Set]]) -> list[tuple[str, Set]]:
    """The sets that hold no combination twice; each is a shuffle of its own columns."""
    counted, places = [], []
    for name, sets in level.items():
        df = tables[name]
        for found in sets:
            values = [profile._comparable(df.schema[i]).alias(f"c{i}") for i in sorted(found)]
            most = df.select(*values).groupBy(*(f"c{i}" for i in sorted(found))).count().agg(F.coalesce(F.max("count"), F.lit(1)).alias("most"))
            counted.append(most.select(F.lit(len(places)).alias("place"), "most"))
            places.append((name, found))
    return [places[row["place"]] for row in _union(counted) if row["most"] == 1]


# Inclusions


def _kind(kind: T.DataType) -> tuple[str, T.DataType] | None:
    """The group of types whose values are compared with each other, and the type they are compared in."""
    if isinstance(kind, INTEGRAL):
        return "whole", T.LongType()
    if isinstance(kind, TEXT):
        return "text", T.StringType()
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return "real", T.DoubleType()
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType, T.NullType)):
        return None
    return kind.simpleString(), T.StringType()


def _places(tables: Mapping[str, DataFrame]) -> list[tuple[str, str, str, T.DataType]]:
    """Table, column, kind and type of every column that can be compared."""
    return [
        (name, f.name, *found) for name, df in tables.items() for f in df.schema if (found := _kind(f.dataType))
    ]


def _sketches(tables: Mapping[str, DataFrame]) -> DataFrame:
    """How many values each column has, and a theta sketch of them: the least hashes, a bounded number. One pass a table."""
    places, frames = _places(tables), []
    for name, df in tables.items():
        own = [(n, column, kind, of) for n, (table, column, kind, of) in enumerate(places) if table == name]
        if not own:
            continue
        aggregates, rows = [], []
        for n, column, kind, of in own:
            value = F.col(backtick(column))
            aggregates += [F.count(value).alias(f"f{n}"), F.theta_sketch_agg(value.cast(of)).alias(f"k{n}")]
            rows.append(f"{n}, {sql_string(kind)}, f{n}, k{n}")
        frames.append(df.agg(*aggregates).selectExpr(f"stack({len(rows)}, {', '.join(rows)}) AS (number, kind, filled, sketch)"))
    return store(reduce(DataFrame.unionAll, frames).where("filled > 0"), "sketches")


def inclusion_candidates(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Pairs of columns of one kind that sketches can't tell apart: ``a`` and ``b``, numbers among the comparable columns.

    A sketch holds all hashes under its bound. One of ``a`` under both bounds that ``b`` lacks proves
    that ``a`` isn't within ``b``, so no pair that is one is left out.
    """
    sketches = _sketches(tables)
    left, right = (sketches.select("kind", F.col("number").alias(x), F.col("sketch").alias(f"sketch_{x}")) for x in "ab")
    missing = F.theta_sketch_estimate(F.theta_difference("sketch_a", "sketch_b"))
    return left.join(right, "kind").where((F.col("a") != F.col("b")) & (missing == 0)).select("a", "b")


def inclusions(tables: Mapping[str, DataFrame], candidates: DataFrame | None = None) -> DataFrame:
    """Every pair of columns, in one table or two, of which the first has values and the second has all of them:
    ``from_table``, ``from_column``, ``to_table``, ``to_column``. No name decides.

    Pairs that sketches disprove are left out first. The values of all other columns meet in one
    shuffle, each with the set of columns it is in, and the sets over a column's values are
    intersected; sets are bits of whole numbers, so both steps combine ahead of their shuffle. Whole numbers are
    compared with whole numbers, texts with texts, other types with their own; a value is named by two hashes.
    """
    spark = next(iter(tables.values())).sparkSession
    candidates = inclusion_candidates(tables) if candidates is None else candidates
    pairs = [tuple(row) for row in candidates.collect()]
    places = _places(tables)
    if not pairs:
        return spark.createDataFrame([], "from_table string, from_column string, to_table string, to_column string")
    used = sorted({x for pair in pairs for x in pair})
    bit = {n: divmod(i, 64) for i, n in enumerate(used)}
    words = range(bit[used[-1]][0] + 1)

    frames = []
    for table, df in tables.items():
        each = []
        for n in used:
            name, column, kind, of = places[n]
            if name == table:
                value = F.col(backtick(column)).cast(of)
                named = F.struct(
                    F.lit(kind).alias("kind"), F.xxhash64(value).alias("h"), F.xxhash64(F.lit(1), value).alias("g"),
                    F.lit(bit[n][0]).alias("word"), F.lit(1).cast("long").alias("one"), F.lit(bit[n][1]).alias("place"),
                )
                each.append(F.when(value.isNotNull(), named))
        if each:
            frames.append(df.select(F.explode(F.array_compact(F.array(*each))).alias("x")))
    values = reduce(DataFrame.unionAll, frames).select("x.*").withColumn("set", F.expr("shiftleft(one, place)"))
    held = [F.coalesce(F.bit_or(F.when(F.col("word") == w, F.col("set"))), F.lit(0).cast("long")).alias(f"w{w}") for w in words]
    met = values.groupBy("kind", "h", "g").agg(*held)
    members = [
        F.when(F.expr(f"w{bit[n][0]} & shiftleft(1L, {bit[n][1]}) <> 0"), F.lit(n)) for n in used
    ]
    within = met.withColumn("a", F.explode(F.array_compact(F.array(*members))))
    within = within.groupBy("a").agg(*(F.bit_and(f"w{w}").alias(f"w{w}") for w in words))
    others = within.select("a", F.explode(F.array_compact(F.array(*members))).alias("b")).where("a <> b")
    return _described(spark, others, places)


def _described(spark: SparkSession, pairs: DataFrame, places) -> DataFrame:
    named = spark.createDataFrame([(n, table, column) for n, (table, column, _, _) in enumerate(places)], "n int, t string, c string")
    left, right = named.toDF("a", "from_table", "from_column"), named.toDF("b", "to_table", "to_column")
    found = pairs.join(F.broadcast(left), "a").join(F.broadcast(right), "b")
    return found.select("from_table", "from_column", "to_table", "to_column")
