"""Parents with arrays of their child rows.

Children are grouped by key *before* the join, so several relations never multiply each
other, and each joins the parents on a key they are both partitioned by.

A group of more than ``ARRAY_ROWS`` children or ``ARRAY_BYTES`` of text is never gathered by
one task. Its rows are spread over several *parts*, and the parent is emitted once for each:
part 0 to ``parts - 1``. The parts are consecutive runs of the sorted children, so that the arrays
joined in the order of ``part`` are the one sorted array. All other parents have one part, and
``(externalId, part)`` is the key of all items. ``children_of`` gives one row for each child instead.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.columns import (
    INTEGRAL,
    TEXT,
    backtick,
    column,
    column_type,
    sql_column,
    sql_text,
)
from shelfmark.operators.ranking import running_sum
from shelfmark.plans.spec import RelationSpec
from shelfmark.session import store

# Children in one array, and bytes of text in it. A parent with more is split into parts.
ARRAY_ROWS = 100_000
ARRAY_BYTES = 64 << 20
# Rows of a table of keys that is still sent to every executor, and bytes of their text.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20

# Words of 64 bits that a filter of keys has at most, which is what bounds its broadcast, and the bits a key sets
# in its word. Beyond some ten keys a word it lets most children through and the join alone decides.
FILTER_WORDS, FILTER_BITS = 1 << 20, 3

KEY, PART, PARTS = "_key", "_part", "_parts"
WORD, BITS = "_word", "_bits"


def child_rows(relation: RelationSpec, source: DataFrame) -> DataFrame:
    """The child's key and the value each row adds to its parent's array.

    Images keep non-empty text and flattened fields keep text; rows that add nothing are
    dropped here, ahead of any shuffle.
    """
    if relation.filter:
        source = source.where(sql_column(relation.filter))
    key = F.expr(sql_text(relation.foreign_key))
    fields = {
        alias: F.expr(sql_text(text)).alias(alias) for alias, text in relation.fields.items()
    }
    picked = relation.picked_field
    if picked is None:
        return source.select(key.alias(KEY), F.struct(*fields.values()).alias("value")).where(
            F.col(KEY).isNotNull()
        )
    if picked not in fields:
        return source.select(key.alias(KEY), F.lit("").alias("value")).where(F.lit(False))
    rows = source.select(key.alias(KEY), fields[picked].alias("value"))
    if not isinstance(rows.schema["value"].dataType, TEXT):
        rows = rows.select(KEY, F.col("value").cast("string").alias("value")).where(F.lit(False))
    keep = F.col(KEY).isNotNull() & F.col("value").isNotNull()
    if relation.image_url_field:
        keep &= F.col("value") != ""
    return rows.where(keep)


def _bytes(value: str, kind: T.DataType) -> Column | None:
    """The text held by a child's value; None if it holds none."""
    if isinstance(kind, T.StructType):
        held = [(F.col(f"{value}.{backtick(f.name)}"), f.dataType) for f in kind.fields]
    else:
        held = [(F.col(value), kind)]
    sizes = []
    for column_, type_ in held:
        if isinstance(type_, (T.ArrayType, T.MapType, T.StructType)):
            column_ = F.to_json(column_)
        elif not isinstance(type_, (*TEXT, T.BinaryType)):
            continue
        sizes.append(F.coalesce(F.octet_length(column_), F.lit(0)).cast("bigint"))
    return reduce(lambda a, b: a + b, sizes) if sizes else None


def large_groups(rows: DataFrame, array_rows: int) -> DataFrame | None:
    """Keys of groups too large for one array, and into how many parts they go.

    Reads the key and the texts alone and combines their sums before the shuffle.
    """
    parts = F.ceil(F.count(F.lit(1)) / array_rows)
    text = _bytes("value", rows.schema["value"].dataType)
    if text is not None:
        parts = F.greatest(parts, F.ceil(F.sum(text) / ARRAY_BYTES))
    sizes = rows.groupBy(KEY).agg(parts.cast("int").alias(PARTS))
    large = store(sizes.where(F.col(PARTS) > 1), "large-groups")
    return None if large.isEmpty() else large


def is_small(df: DataFrame) -> bool:
    """Whether a table of keys is counted to be small enough for every executor."""
    text = [
        F.sum(F.octet_length(backtick(f.name))) for f in df.schema if isinstance(f.dataType, TEXT)
    ]
    rows, *sizes = df.agg(F.count(F.lit(1)), *text).first()
    return rows <= BROADCAST_ROWS and sum(n or 0 for n in sizes) <= BROADCAST_BYTES


def maybe_broadcast(df: DataFrame) -> DataFrame:
    """``df`` to be broadcast if it is small; else the join is Spark's choice."""
    return F.broadcast(df) if is_small(df) else df


def _tiers(large: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Large groups as a small table of the largest and a table of all others.

    A shuffle by key brings a group to one task. That is never done to the first table's
    groups, and those in the second are bounded: they have few parts each.
    """
    if is_small(large):
        return F.broadcast(large), None
    parts = 2
    while not is_small(large.where(F.col(PARTS) > parts)):
        parts *= 2
    largest = F.broadcast(large.where(F.col(PARTS) > parts))
    return largest, large.where(F.col(PARTS) <= parts)


def _without(rows: DataFrame, large: DataFrame) -> DataFrame:
    """Rows of no large group."""
    largest, others = _tiers(large)
    rows = rows.join(largest, KEY, "left_anti")
    return rows if others is None else rows.join(others, KEY, "left_anti")


def join_groups(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows with their group's columns: ``_key``, ``_parts`` (by which the largest groups
    are told, and broadcast) and any other. Rows of no listed group are left out."""
    largest, others = _tiers(groups)
    found = rows.join(largest, KEY)
    if others is None:
        return found
    return found.unionByName(rows.join(largest, KEY, "left_anti").join(others, KEY))


def _unordered(kind: T.DataType) -> bool:
    return any(name in kind.simpleString() for name in ("map<", "variant"))


def _order(kind: T.DataType) -> Column:
    """What a child's value is sorted by: itself or, where it has no order, its JSON."""
    return F.to_json(F.struct("value")) if _unordered(kind) else F.col("value")


def _gathered(kind: T.DataType, *others: str) -> Column:
    """All values of a group, with other columns, in their order."""
    if not _unordered(kind):
        return F.sort_array(F.collect_list(F.struct("value", *others)))
    held = F.collect_list(F.struct(_order(kind).alias("order"), "value", *others))
    before = lambda x, y: F.when(x["order"] < y["order"], -1).when(x["order"] > y["order"], 1)
    return F.array_sort(held, lambda x, y: before(x, y).otherwise(0))


def _arrays(rows: DataFrame) -> DataFrame:
    kind = rows.schema["value"].dataType
    values = F.sort_array(F.collect_list("value"))
    if _unordered(kind):
        values = F.transform(_gathered(kind), lambda v: v["value"])
    return rows.groupBy(KEY).agg(values.alias("values"))


def _split_arrays(rows: DataFrame, large: DataFrame, array_rows: int) -> DataFrame:
    """Arrays of large groups, one row per part.

    Equal values are counted first, which combines before the shuffle however often one
    repeats. A running sum of sizes in the order of key and value then tells where in its group each
    value stands, and every part takes the copies that start in its share of the group. A
    size is the text's bytes, or a row's share of the bytes of a full part if that is more.
    """
    kind = rows.schema["value"].dataType
    text = _bytes("value", kind)
    size = F.lit(1) if text is None else F.greatest(text, F.lit(-(-ARRAY_BYTES // array_rows)))
    counted = join_groups(rows, large).groupBy(KEY, PARTS, "value").agg(F.count(F.lit(1)).alias("_n"))
    counted = counted.withColumn("_size", size.cast("bigint"))
    placed = running_sum(counted, [F.col(KEY), _order(kind)], F.col("_n") * F.col("_size"), "_end")
    begin = F.col("_end") - F.col("_n") * F.col("_size")
    groups = placed.groupBy(KEY, PARTS).agg(F.min(begin).alias("_first"), F.max("_end").alias("_last"))
    width = F.ceil((F.col("_last") - F.col("_first")) / F.col(PARTS)).cast("bigint")
    groups = store(groups.select(KEY, PARTS, "_first", width.alias("_width")), "large-groups")
    placed = join_groups(placed.drop(PARTS), groups).withColumn("_from", begin - F.col("_first"))
    last = "(_from + (_n - 1) * _size) div _width"
    pieces = placed.withColumn(PART, F.expr(f"explode(sequence(_from div _width, {last}))"))

    def copies(edge: str) -> Column:
        """How many copies start before an edge."""
        return F.expr(f"least(_n, (greatest({edge} * _width - _from, 0L) + _size - 1) div _size)")

    pieces = pieces.withColumn("n", (copies(f"({PART} + 1)") - copies(PART)).cast("int"))
    pieces = pieces.where("n > 0").withColumn(PART, F.col(PART).cast("int"))
    repeated = F.transform(_gathered(kind, "n"), lambda v: F.array_repeat(v["value"], v["n"]))
    return pieces.groupBy(KEY, PART).agg(F.flatten(repeated).alias("values"))


@dataclass(frozen=True)
class ChildArrays:
    """Child arrays by key. With ``large`` set, by key and part."""

    arrays: DataFrame
    large: DataFrame | None


def group_children(
    rows: DataFrame, array_rows: int = ARRAY_ROWS, parents: DataFrame | None = None
) -> ChildArrays:
    """Child rows (``_key, value``) as arrays; only of the keys in ``parents``, if given.

    Few parents are broadcast, and only their children are counted. Else all groups are
    counted, as counts combine before a shuffle, and the large ones set aside before the
    others meet the parents in the shuffle that groups them.
    """
    few = parents is not None and is_small(parents)
    if few:
        rows = rows.join(F.broadcast(parents), KEY, "left_semi")
    large = large_groups(rows, array_rows)
    small = rows if large is None else _without(rows, large)
    if parents is not None and not few:
        small = small.join(parents, KEY, "left_semi")
        large = large and store(large.join(parents, KEY, "left_semi"), "large-groups")
    if large is None:
        return ChildArrays(_arrays(small), None)
    arrays = _arrays(small).select(KEY, F.lit(0).alias(PART), "values")
    return ChildArrays(arrays.unionByName(_split_arrays(rows, large, array_rows)), large)


def _word_and_bits() -> tuple[Column, Column]:
    """The word of a key in a Bloom filter of words, and the bits it sets there."""
    hashed = F.xxhash64(KEY)
    bits = [F.expr(f"shiftleft(1L, cast(shiftright(xxhash64({KEY}), {26 + 6 * i}) & 63 AS int))") for i in range(FILTER_BITS)]
    return hashed.bitwiseAND(F.lit(FILTER_WORDS - 1)), reduce(lambda a, b: a.bitwiseOR(b), bits)


def key_filter(keys: DataFrame) -> DataFrame:
    """A Bloom filter of the column ``_key`` as a table of words: one aggregate of at most ``FILTER_WORDS`` rows.

    Stored, so that it is built once and is broadcast as it is into the scans that it cuts.
    """
    word, bits = _word_and_bits()
    words = keys.where(F.col(KEY).isNotNull()).select(word.alias(WORD), bits.alias(BITS))
    return store(words.groupBy(WORD).agg(F.bit_or(BITS).alias(BITS)), "key-filter")


def may_match(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows whose key the filter may hold: all that are in it and few others. Neither moves nor multiplies a row, so
    it stands ahead of the shuffle that groups them, and a table bucketed by the key still needs none."""
    word, bits = _word_and_bits()
    kept = rows.withColumn(WORD, word).join(F.broadcast(found), WORD)
    return kept.where(F.col(BITS).bitwiseAND(bits) == bits).select(*(backtick(c) for c in rows.columns))


def _as_type(key: Column, kind: T.DataType, other: T.DataType) -> Column:
    """A key in the type it is compared with where it is text and that is not, or where
    both are whole numbers; null where it has no value there."""
    text = isinstance(kind, TEXT) and not isinstance(other, TEXT)
    whole = isinstance(kind, INTEGRAL) and isinstance(other, INTEGRAL) and kind != other
    return key.try_cast(other) if text or whole else key


def _keyed(
    parents: DataFrame, relation: RelationSpec, source: DataFrame, id_column: str
) -> tuple[DataFrame, Column]:
    """The child rows of a relation and the parents' key, in one type."""
    rows = child_rows(relation, source)
    reference = relation.reference_key or id_column
    kind, other = column_type(parents, reference), rows.schema[KEY].dataType
    rows = rows.withColumn(KEY, _as_type(F.col(KEY), other, kind))
    rows = rows.where(F.col(KEY).isNotNull())
    return rows, _as_type(column(parents, reference), kind, rows.schema[KEY].dataType)


def children_of(
    parents: DataFrame, relation: RelationSpec, source: DataFrame, id_column: str, identity: Column
) -> DataFrame:
    """``externalId`` and ``child`` for each child of each parent: no group is gathered, and a key
    with very many children is a skewed join, which adaptive execution splits."""
    rows, parent_key = _keyed(parents, relation, source, id_column)
    keys = parents.select(parent_key.alias(KEY), identity.alias("externalId"))
    return rows.join(keys, KEY).select("externalId", F.col("value").alias("child"))


def with_children(
    parents: DataFrame,
    relations: Mapping[str, RelationSpec],
    sources: Mapping[str, DataFrame],
    id_column: str,
    array_rows: int = ARRAY_ROWS,
    narrowed: bool = False,
    filtered: bool = False,
) -> DataFrame:
    """``parents`` with one array column per relation (named by ``array_column``),
    ``[]`` where there are no children, and the part each row is.

    ``sources`` holds each relation's child table by the relation's name. ``narrowed``
    says that ``parents`` is a stored part of its table: children of others are dropped
    before they are grouped. ``filtered`` says that it is a part that is not stored: most of the
    children of others are dropped in the scan, by a filter of the parents' keys.
    """
    grouped = {}
    for name, relation in relations.items():
        rows, parent_key = _keyed(parents, relation, sources[name], id_column)
        keys = parents.select(parent_key.alias(KEY))
        if filtered and keys.schema[KEY].dataType == rows.schema[KEY].dataType:
            rows = may_match(rows, key_filter(keys))
        only = keys.distinct() if narrowed else None
        grouped[name] = (parent_key, group_children(rows, array_rows, only))

    result = _spread_parents(parents, list(grouped.values()))
    for name, (parent_key, children) in grouped.items():
        child_key, child_part = f"_key_{name}", f"_part_{name}"
        arrays = children.arrays.withColumnRenamed(KEY, child_key)
        arrays = arrays.withColumnRenamed("values", array_column(name))
        on = parent_key == F.col(backtick(child_key))
        if children.large is not None:
            arrays = arrays.withColumnRenamed(PART, child_part)
            on &= F.col(PART) == F.col(backtick(child_part))
        elif any(c.large is not None for _, c in grouped.values()):
            on &= F.col(PART) == 0
        result = result.join(arrays, on, "left").drop(child_key, child_part)
        empty = F.array().cast(arrays.schema[array_column(name)].dataType)
        result = result.withColumn(
            array_column(name), F.coalesce(F.col(backtick(array_column(name))), empty)
        )
    return result


def array_column(name: str) -> str:
    return f"_children_{name}"


def _spread_parents(parents: DataFrame, grouped: list[tuple[Column, ChildArrays]]) -> DataFrame:
    """Parents once per part: one, but for those with a large group of children."""
    needed = []
    for number, (parent_key, children) in enumerate(grouped):
        if children.large is None:
            continue
        key, parts = f"_large_{number}", f"_parts_{number}"
        large = children.large.select(F.col(KEY).alias(key), F.col(PARTS).alias(parts))
        parents = parents.join(maybe_broadcast(large), parent_key == F.col(key), "left").drop(key)
        needed.append(parts)
    if not needed:
        return parents.withColumns({PART: F.lit(0), PARTS: F.lit(1)})
    counts = [F.coalesce(F.col(p), F.lit(1)) for p in needed]
    most = reduce(lambda a, b: F.greatest(a, b), counts)
    parents = parents.withColumn(PARTS, most).drop(*needed)
    return parents.withColumn(PART, F.explode(F.sequence(F.lit(0), F.col(PARTS) - 1)))


def children_of_page(
    relation: RelationSpec, source: DataFrame, keys: list, id_type: T.DataType
) -> DataFrame:
    """Only the children of one page's parents. ``keys`` holds at most a page of values;
    as a literal IN list it reaches the child's scan, file or database."""
    foreign_key = F.expr(sql_text(relation.foreign_key))
    kind = source.select(foreign_key.alias(KEY)).schema[KEY].dataType
    if isinstance(kind, TEXT) and not isinstance(id_type, TEXT):
        foreign_key = foreign_key.try_cast(id_type)
    elif kind != id_type:
        keys = [F.lit(k).try_cast(kind) for k in keys]
    return source.where(foreign_key.isin(keys))
