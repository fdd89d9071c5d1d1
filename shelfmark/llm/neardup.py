"""Near duplicates by MinHash, bands and odd sketches.

Each text becomes the set of its word shingles. Texts with equal sets are one *class* from the
start, so exact copies are never compared. MinHash samples of a class are read twice: in bands,
whose equal values bring candidates together, and folded into an odd sketch, a bitmap of
parities. The bits that differ between two sketches tell how many samples differ, which
for high similarities is precise enough to drop nearly all false candidates without a text.
What is left is confirmed on the full sets.

A bucket of equal bands is searched in two rounds. First every member is compared with the
smallest one only. Groups of near copies, of any size, fall together there. Then members of
one bucket that are still in different components are compared with each other inside the join: by
their sketches, and by the parities of their whole sets, which tell a similarity of 0.8 from 0.77.
Only members outside of a bucket's largest component take part on one side, and ``TOGETHER`` of them at
most. The members of a bucket with more, such as texts of one mould that are all nearly similar enough, are met by their
rarest shingles: two sets at the limit share one among so many of the rarest that others seldom share any.
So nothing is missed, and no group is written out as pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm import text as T
from shelfmark.llm.components import components
from shelfmark.session import store

#: Words of a shingle and the least similarity, as hundredths, of operators that don't say otherwise.
WIDTH, PERCENT = 5, 80
#: At a similarity of 0.8 one pair in eight million shares no band of five samples.
BANDS, ROWS = 40, 5
SAMPLES = BANDS * ROWS
#: Bits of a sketch.
BITS = 1024
#: Bits of the parities of a whole set; over some ten thousand shingles they tell less and less apart.
SET_BITS = 4096
#: The most members outside of a bucket's largest component that all others of the bucket are compared with.
TOGETHER = 100
#: How far below the limit, in standard errors of the estimate, a sketch may lie.
MARGIN = 6.0

_DRAWN = np.random.Generator(np.random.PCG64(77)).integers(1, 1 << 63, (2, SAMPLES, 1), np.uint64)
_FACTORS, _SHIFTS = _DRAWN[0] * np.uint64(2) + np.uint64(1), _DRAWN[1]
_PLACES = np.arange(SAMPLES, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(batch: pa.RecordBatch, column: str, width: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Runs of rows and the sorted distinct shingles of each; a text with fewer than ``width``
    words is one shingle, one without words has none."""
    for rows, data, bounds in T.pieces(batch, column):
        data = T.lower_ascii(data)
        starts, ends, first = T.spans(T.PLAIN[data], bounds)
        words = T.Hashes(data).of(starts, ends)
        found, sets = T.grams(words, width), []
        for a, z in zip(first[:-1].tolist(), first[1:].tolist()):
            if a == z or z - a >= width:
                sets.append(np.unique(found[a : max(a, z - width + 1)]))
            else:
                sets.append(T.grams(words[a:z], z - a))
        yield rows, sets


def samples(shingles: np.ndarray) -> np.ndarray:
    """The least value of the set under each of ``SAMPLES`` orders."""
    least = np.full(SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 1024):
            part = shingles[None, at : at + 1024]
            np.minimum(least, (part * _FACTORS + _SHIFTS).min(axis=1), out=least)
    return least


def bands_of(least: np.ndarray) -> np.ndarray:
    """One value for each band of samples."""
    with np.errstate(over="ignore"):
        total, parts = np.arange(1, BANDS + 1, dtype=np.uint64), least.reshape(BANDS, ROWS)
        for i in range(ROWS):
            total = T.mixed(total * np.uint64(0x9FB21C651E98DF25) + parts[:, i])
    return total.view(np.int64)


def sketch_of(least: np.ndarray) -> np.ndarray:
    """The parities, packed into whole numbers."""
    with np.errstate(over="ignore"):
        bits = T.mixed(least + _PLACES) % np.uint64(BITS)
    odd = np.bincount(bits.astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def parities_of(shingles: np.ndarray) -> np.ndarray:
    """The odd sketch of the set itself."""
    bits = T.mixed(shingles ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(SET_BITS)
    odd = np.bincount(bits.astype(np.int64), minlength=SET_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _most_parities(shingles: Column, percent: int) -> Column:
    """The most parities in which two sets at the limit differ, of so many shingles together."""
    apart = shingles * (100 - percent) / (100 + percent)
    decay = F.exp(-2 * apart / SET_BITS)
    spread = F.sqrt(F.greatest(SET_BITS / 4 * (1 - decay * decay) - apart * decay * decay, F.lit(0.0)))
    return SET_BITS / 2 * (1 - decay) + MARGIN * spread + 1


def most_bits(percent: int) -> int:
    """The most bits in which the sketches of a pair at the limit differ, with the margin."""
    limit = percent / 100
    low = max(0.0, limit - MARGIN * math.sqrt(limit * (1 - limit) / SAMPLES))
    return int(BITS / 2 * (1 - math.exp(-4 * SAMPLES * (1 - low) / BITS)))


def fingerprint(shingles: np.ndarray) -> bytes | None:
    """128 bits that tell sets apart; None for the empty one."""
    if not len(shingles):
        return None
    with np.errstate(over="ignore"):
        sums = [T.mixed(shingles).sum(), T.mixed(shingles ^ np.uint64(0xA5A5A5A5DEADBEEF)).sum()]
    return np.array(sums, np.uint64).tobytes()


def _lists(parts: list[np.ndarray | None]) -> pa.Array:
    sizes = [0 if x is None else len(x) for x in parts]
    values = np.concatenate([x for x in parts if x is not None] or [np.zeros(0, np.int64)])
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(values))


def _signatures(width: int, batches):
    for batch in batches:
        for rows, sets in shingle_sets(batch, "text", width):
            least = [samples(x) if len(x) else None for x in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    rows["id"],
                    rows["key"],
                    pa.array([fingerprint(x) for x in sets], pa.binary()),
                    pa.array([len(x) for x in sets], pa.int64()),
                    _lists([x if x is None else sketch_of(x) for x in least]),
                    _lists([x if x is None else bands_of(x) for x in least]),
                    _lists([parities_of(x) if len(x) else None for x in sets]),
                ],
                ["id", "key", "node", "n_shingles", "sketch", "bands", "parities"],
            )


def _confirmed(width: int, percent: int, batches):
    """Pairs of nodes whose texts are theirs and whose sets are as similar as asked."""
    for batch in batches:
        for at in range(0, batch.num_rows, 128):
            part = batch.slice(at, 128)
            left, right = (
                [x for _, sets in shingle_sets(part, side, width) for x in sets]
                for side in ("text_a", "text_b")
            )
            keep = []
            for a, b, x, y in zip(part["a"].to_pylist(), part["b"].to_pylist(), left, right):
                both = len(np.intersect1d(x, y, assume_unique=True))
                same = 100 * both >= percent * (len(x) + len(y) - both)
                keep.append(same and fingerprint(x) == a and fingerprint(y) == b)
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _texts_of(nodes: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """One text of each of the nodes, stored."""
    wanted = classes.select("node", F.col("least.key").alias("key"), F.col("least.id").alias("first_id")).join(nodes, "node")
    held = wanted.join(texts, (wanted["key"] == texts["key"]) & wanted["first_id"].eqNullSafe(texts["id"]))
    return store(held.select("node", "text"), "texts")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))


def _links(pairs: DataFrame, held: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs of nodes ``a`` and ``b`` that the full sets of their texts confirm."""
    left = held.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = held.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return (
        pairs.join(right, "b")
        .join(left, "a")
        .select("a", "b", "text_a", "text_b")
        .mapInArrow(partial(_confirmed, width, percent), "a binary, b binary")
        .distinct()
    )


def _exploded(width: int, batches):
    """A row for each shingle of each node's text."""
    for batch in batches:
        for rows, sets in shingle_sets(batch, "text", width):
            sizes = np.array([len(x) for x in sets], np.int64)
            nodes = rows["node"].take(pa.array(np.repeat(np.arange(len(sets)), sizes)))
            shingles = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [nodes, pa.array(np.repeat(sizes, sizes)), pa.array(shingles)], ["node", "n", "shingle"]
            )


def _sharing(nodes: DataFrame, held: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs ``x`` and ``y`` of the nodes, in different components, that share a shingle among their rarest ones.

    With all shingles in one order, two sets at the limit share one among the first of each: of the larger set it is one of the
    first ``n - ceil(n * limit) + 1``, of the smaller one of the first ``n - ceil(n * 2 * limit / (1 + limit)) + 1``. The order is
    by how many of the nodes have a shingle, so what a mould's texts have in common comes last.
    """
    held = held.join(nodes.select("node"), "node", "left_semi")
    rows = store(held.mapInArrow(partial(_exploded, width), "node binary, n long, shingle long"), "shingles")
    shared = store(rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("held_by")).where("held_by > 1"), "shared")
    ranked = rows.join(shared, "shingle", "left").withColumn(
        "place", F.row_number().over(Window.partitionBy("node").orderBy(F.asc_nulls_first("held_by"), "shingle"))
    )
    larger = F.expr(f"n - (n * {percent} + 99) div 100 + 1")
    smaller = F.expr(f"n - (n * {2 * percent} + {99 + percent}) div {100 + percent} + 1")
    first = ranked.where(F.col("held_by").isNotNull() & (F.col("place") <= larger)).withColumn("few", F.col("place") <= smaller)
    first = store(first.select("node", "n", "shingle", "few").join(nodes, "node"), "rarest")
    x = first.where("few").select("shingle", *(F.col(c).alias(f"{c}_x") for c in ("node", "n", "component")))
    y = first.select("shingle", *(F.col(c).alias(f"{c}_y") for c in ("node", "n", "component")))
    order = (F.col("n_x") < F.col("n_y")) | ((F.col("n_x") == F.col("n_y")) & (F.col("node_x") < F.col("node_y")))
    met = order & (100 * F.col("n_x") >= percent * F.col("n_y")) & (F.col("component_x") != F.col("component_y"))
    return x.join(y, (x["shingle"] == y["shingle"]) & met).select(F.col("node_x").alias("x"), F.col("node_y").alias("y")).distinct()


def _differing(x: str, y: str):
    """How many bits of two sketches differ."""
    each = F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    return F.aggregate(each, F.lit(0), lambda total, n: total + n)


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """One row for each row of ``docs``: its id, ``n_shingles``, ``component_id`` and ``kept``.

    Two texts are linked if 100 times the shared shingles are at least ``percent`` times those of
    both. ``component_id`` is the smallest id that links reach, ``kept`` whether it is the row's own.

    * Texts are compared in lower case (A-Z) and by words between ASCII white space.
    * A null or empty text, or one of white space, has no shingle, is linked with nothing and kept.
    * Rows that repeat an id and a text share their fate; rows that share an id only are told
      apart by their texts. A null id is never the smallest; groups without any id have null.
    * Other columns of ``docs`` are not looked at. An empty table gives an empty result.
    """
    found = _judged(docs, id, text, width, percent)
    return found.select(F.col("id").alias(id), "n_shingles", "component_id", "kept")


def without_near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """One row of each group that ``near_duplicates`` finds, that of the least id and then of the least hash of
    its text, with its columns; null ids come last. Texts without words stay; of rows that repeat an id and a
    text one stays."""
    found = store(_judged(docs, id, text, width, percent).select("id", "key", F.col("first").alias("kept")), "verdicts")
    gone = found.where("not kept").select("id", "key")
    repeated = found.where("kept").groupBy("id", "key").agg(F.count("*").alias("n")).where("n > 1").select("id", "key")
    repeated = store(repeated, "repeated")
    own = F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))

    def met(side: DataFrame):
        return docs[id].eqNullSafe(side["id"]) & (own == side["key"])

    kept = gone.unionByName(repeated)
    kept = docs.join(kept, met(kept), "left_anti")
    if repeated.isEmpty():
        return kept
    return kept.unionByName(docs.join(repeated, met(repeated), "left_semi").dropDuplicates([id, text]))


def _judged(docs: DataFrame, id: str, text: str, width: int, percent: int) -> DataFrame:
    value = F.col(text).cast("string")
    texts = docs.select(F.col(id).alias("id"), F.md5(F.coalesce(value, F.lit(""))).alias("key"), value.alias("text"))
    kind = dict(texts.dtypes)["id"]
    signed = store(
        texts.mapInArrow(
            partial(_signatures, width),
            f"id {kind}, key string, node binary, n_shingles long, sketch array<long>, bands array<long>, parities array<long>",
        ),
        "signatures",
    )
    own = F.struct(F.col("id").isNull().alias("none"), "id", "key")  # a null id comes last
    classes = store(
        signed.where("node is not null")
        .groupBy("node")
        .agg(F.min(own).alias("least"), *(F.first(c).alias(c) for c in ("n_shingles", "sketch", "bands", "parities"))),
        "classes",
    )
    spread = classes.select("node", F.explode("bands").alias("bucket"))
    buckets = spread.groupBy("bucket").agg(F.min("node").alias("center"), F.count("*").alias("n"))
    members = store(spread.join(buckets.where("n > 1").drop("n"), "bucket"), "buckets")

    sketches = classes.select("node", "sketch")
    near = _differing("sketch_a", "sketch_b") <= most_bits(percent)
    pairs = members.where("node <> center").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
    pairs = store(
        pairs.join(sketches.toDF("b", "sketch_b"), "b").join(sketches.toDF("a", "sketch_a"), "a").where(near).select("a", "b"),
        "pairs",
    )
    held = _texts_of(_ends(pairs).distinct(), classes, texts)
    links = store(_links(pairs, held, width, percent), "links")

    # Second round: what shares a bucket and is still apart. The centre has met all of its bucket.
    found = components(links, "a", "b")
    placed = members.join(found, "node", "left").select(
        "bucket", "node", (F.col("node") == F.col("center")).alias("met"), F.coalesce("component", "node").alias("component")
    )
    placed = store(placed, "placed")
    sizes = placed.where("not met").groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy("bucket").agg(
        F.max_by("component", F.struct("n", "component")).alias("largest"), (F.sum("n") - F.max("n")).alias("others")
    )
    sizes = store(sizes.where("others > 0"), "sizes")
    apart = placed.where("not met").drop("met").join(sizes, "bucket")
    apart = store(apart.withColumn("other", F.col("component") != F.col("largest")).drop("largest"), "apart")

    def near_and_alike(a: str, b: str):
        both = F.col(f"n_shingles_{a}") + F.col(f"n_shingles_{b}")
        alike = _differing(f"parities_{a}", f"parities_{b}") <= _most_parities(both, percent)
        return (_differing(f"sketch_{a}", f"sketch_{b}") <= most_bits(percent)) & alike

    def side(df: DataFrame, end: str):
        return df.select("bucket", *(F.col(c).alias(f"{c}_{end}") for c in df.columns if c != "bucket"))

    small = store(apart.where(F.col("others") <= TOGETHER).drop("others").join(classes.drop("least"), "node"), "small-buckets")
    left, right = side(small.where("other"), "a"), side(small, "b")
    first = F.array_min(F.array_intersect("bands_a", "bands_b")) == left["bucket"]  # a pair meets once
    once = (F.col("component_a") != F.col("component_b")) & (~F.col("other_b") | (F.col("node_a") < F.col("node_b")))
    more = left.join(right, (left["bucket"] == right["bucket"]) & once & near_and_alike("a", "b") & first)
    more = more.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
    more = store(more.distinct(), "pairs")

    crowd = store(apart.where(F.col("others") > TOGETHER).select("node", "component").distinct(), "crowd")
    held = _texts_of(_ends(more).unionByName(crowd.select("node")).distinct(), classes, texts)
    if not crowd.isEmpty():
        sharing = store(_sharing(crowd, held, width, percent), "sharing")
        of = classes.select("node", "n_shingles", "sketch", "parities").join(crowd, "node", "left_semi")
        of = store(of, "crowd-sketches")
        sharing = sharing.join(of.toDF("x", "n_shingles_x", "sketch_x", "parities_x"), "x")
        sharing = sharing.join(of.toDF("y", "n_shingles_y", "sketch_y", "parities_y"), "y").where(near_and_alike("x", "y"))
        more = more.unionByName(sharing.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))).distinct()
        more = store(more, "pairs")
    links = links.unionByName(_links(more, held, width, percent))

    found = store(components(links, "a", "b"), "components")
    named = classes.select("node", F.col("least").alias("own")).join(found, "node", "left")
    least = named.where("component is not null").groupBy("component").agg(F.min("own").alias("least"))
    least = store(least, "least")  # as a table, so that the join with a component of very many nodes can be split
    named = named.join(least, "component", "left").select("node", F.coalesce("least", "own").alias("least"))
    joined = signed.select("id", "key", "node", "n_shingles").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("least.id"))
    first = F.col("node").isNull() | F.col("id").eqNullSafe(F.col("least.id")) & (F.col("key") == F.col("least.key"))
    return joined.select(
        "id", "key", "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"),
        first.alias("first"),
    )
