"""How filters interact: what each removes, in every order they may be applied in.

The texts are read once, by a transducer over their UTF-8 bytes that is two tables: what a byte
puts out in a state, and the state after it. As the state after a byte depends on that byte
alone, the states of a whole batch are one lookup moved by a place. The spans of words it puts
out go into a hash table with open addresses, where a word counts as met only if its bytes equal
those of the word in the slot. After that a document is one bit for each filter, and all orders
are sums over the sets of bits, so nothing is filtered again for an order.
"""

from __future__ import annotations

import json
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import text as T
from shelfmark.session import store

#: What the transducer puts out for a byte.
WORD, CAPITAL, POINT, SYMBOL = 1, 2, 4, 8
#: Counts of a text, in the order of ``counts``.
COUNTS = ("n_words", "n_distinct", "n_capitals", "n_points", "n_symbols")
#: Conditions under which a document fails, over ``COUNTS``; COPY fails texts that a smaller id has too.
FILTERS = {
    "A": "n_words < 50",
    "B": "100 * n_distinct < 65 * n_words",
    "C": "100 * n_capitals > 5 * n_points",
    "D": "n_symbols > 0",
    "E": "copy",
}
COPY = "copy"
#: All orders of so many filters are told apart.
MOST_FILTERS = 7


def tables(symbols: str = "#$%&*|") -> tuple[np.ndarray, np.ndarray]:
    """What each byte puts out, by the state it is met in (0 between words, 1 in one), and the state after it."""
    after = T.PLAIN.astype(np.uint8)
    out = np.zeros((2, 256), np.uint8)
    out[0, T.PLAIN] |= WORD
    out[:, ord("A") : ord("Z") + 1] |= CAPITAL
    out[:, [x for x in range(256) if x & 0xC0 != 0x80]] |= POINT
    out[:, [ord(x) for x in symbols]] |= SYMBOL
    return out, after


OUT, AFTER = tables()


def transduced(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each byte puts out and the state after it; every row begins between words."""
    after = AFTER[data]
    state = np.zeros_like(after)
    state[1:] = after[:-1]
    state[bounds[:-1][bounds[:-1] < len(data)]] = 0
    return OUT.reshape(-1)[(state.astype(np.int32) << 8) + data], after


class Words:
    """Spans of one batch, compared by their bytes eight at a time."""

    _KEEP = np.array([(1 << 8 * i) - 1 for i in range(8)] + [(1 << 64) - 1], np.uint64)

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, owners: np.ndarray):
        self.data, self.starts, self.ends, self.owners = data, starts, ends, owners
        self.sizes = ends - starts
        held = np.concatenate([data, np.zeros(8, np.uint8)])
        self._at = np.ndarray((len(data) + 1,), "<u8", held, 0, (1,))
        short = np.minimum(self.sizes, 8)
        self.first = self._at[starts] & self._KEEP[short]
        self.last = self._at[ends - short] & self._KEEP[short]

    def hashes(self) -> np.ndarray:
        """Equal for equal words of one owner; long words are looked at in five places only."""
        with np.errstate(over="ignore"):
            found = T.mixed(self.first + self.sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            found = T.mixed(found ^ self.last) + self.owners.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            long = np.flatnonzero(self.sizes > 16)
            for part in (1, 2, 3):
                found[long] = T.mixed(found[long] ^ self._at[self.starts[long] + self.sizes[long] * part // 4 - 4])
        return T.mixed(found)

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the spans numbered ``a`` and ``b``, pair by pair, are the same word of the same owner."""
        same = (self.sizes[a] == self.sizes[b]) & (self.owners[a] == self.owners[b])
        same &= (self.first[a] == self.first[b]) & (self.last[a] == self.last[b])
        left, at = np.flatnonzero(same & (self.sizes[a] > 16)), 8
        while len(left) and at < 4096:
            x, y = a[left], b[left]
            unlike = self._at[self.starts[x] + at] != self._at[self.starts[y] + at]
            same[left[unlike]] = False
            at += 8
            left = left[~unlike & (self.sizes[x] > at + 8)]
        for i in left:
            (s, e), (t, u) = ((self.starts[x[i]], self.ends[x[i]]) for x in (a, b))
            same[i] = np.array_equal(self.data[s + at : e], self.data[t + at : u])
        return same


def distinct(words: Words) -> np.ndarray:
    """Whether each span is the one that its word has in the hash table: true once for each word of an owner."""
    n = len(words.starts)
    size = 1 << max(4, (2 * n).bit_length())
    slots = np.full(size, -1, np.int64)
    at = (words.hashes() & np.uint64(size - 1)).astype(np.int64)
    held, left = np.full(n, -1, np.int64), np.arange(n)
    while len(left):
        free = left[slots[at[left]] < 0][::-1]
        slots[at[free]] = free
        there = slots[at[left]]
        met = there == left
        other = np.flatnonzero(~met)
        met[other] = words.equal(there[other], left[other])
        held[left[met]] = there[met]
        left = left[~met]
        at[left] = (at[left] + 1) & (size - 1)
    return held == np.arange(n)


def counts(data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """``COUNTS`` of each row of a batch."""
    out, after = transduced(data, bounds)

    def per_row(places):
        return np.diff(np.searchsorted(places, bounds))

    starts = np.flatnonzero(out & WORD)
    # A word ends before the next byte between words, or where its row does.
    stops = np.union1d(np.flatnonzero(after == 0), bounds[1:])
    ends = stops[np.searchsorted(stops, starts, "right")] if len(starts) else starts
    owners = np.searchsorted(bounds, starts, "right") - 1
    own = starts[distinct(Words(data, starts, ends, owners))]
    return [per_row(x) for x in (starts, own, *(np.flatnonzero(out & bit) for bit in (CAPITAL, POINT, SYMBOL)))]


def _counted(batches):
    for batch, data, bounds in T.texts(batches, "text"):
        found = [pa.array(x.astype(np.int64)) for x in counts(data, bounds)]
        kept = batch.drop_columns(["text"])
        yield pa.RecordBatch.from_arrays([*kept.columns, *found], [*kept.schema.names, *COUNTS])


def text_counts(docs: DataFrame, id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``id``, ``part`` (null as the empty string), ``same`` (a digest that equal texts share) and ``COUNTS``.

    Texts are taken whole; a null is an empty one. Other columns are not looked at.
    """
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(value, 256)).alias("same"), value.alias("text"),
    )
    kind = dict(rows.dtypes)["id"]
    longs = ", ".join(f"{c} long" for c in COUNTS)
    return rows.mapInArrow(_counted, f"id {kind}, part string, same binary, {longs}")


def _labelled(labels: DataFrame, id: str) -> DataFrame:
    return labels.where(F.col(id).isNotNull()).groupBy(F.col(id).alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )


def _steps(names: list[str]) -> Column:
    """Every step of every order: its filter, and the sets of filters applied before and after it."""
    found = []
    for order in permutations(range(len(names))):
        before = 0
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            found.append({"o": "".join(names[k] for k in order), "s": step, "f": i, "b": before, "a": after})
            before = after
    return F.from_json(F.lit(json.dumps(found)), "array<struct<o:string,s:int,f:int,b:int,a:int>>")


def audit(
    docs: DataFrame, labels: DataFrame, filters: dict[str, str] | None = None, id: str = "doc_id",
    text: str = "text", part: str = "source",
) -> DataFrame:
    """One row for each part, each order of the filters and each step of it.

    ``filters`` names conditions over ``COUNTS`` under which a document fails; the condition
    ``copy`` is that a smaller id of the whole table has the same text. The rows hold ``part``,
    ``filter_order``, ``step``, the counts of documents ``kept`` after the step and ``removed`` by
    it, ``redundant`` (they fail its filter and were removed before), ``unique_fails`` (they fail no
    other filter), ``good_lost`` and ``toxic_lost`` (removed by it, and labelled so), and
    ``shapley``: what its filter removes, summed over all orders.

    * A null text is an empty one; a null part and an empty one are the same part.
    * A null id is smaller and larger than none, and has no label. Rows that repeat an id and a text
      are documents each; none of them is a copy of the other. Labels that repeat an id are read together.
    * An empty table has no part and gives no row. Other columns are not looked at.
    """
    filters = FILTERS if filters is None else filters
    names = list(filters)
    if not 0 < len(names) <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters, not {len(names)}")
    whole = (1 << len(names)) - 1

    rows = store(text_counts(docs, id, text, part), "counts")
    low = rows.groupBy("same").agg(F.min("id").alias("low"), F.count("*").alias("n")).where("n > 1").drop("n")
    rows = rows.join(store(low, "copies"), "same", "left")
    rows = rows.withColumn(COPY, F.coalesce(F.col("id") > F.col("low"), F.lit(False)))
    bits = [F.when(F.expr(f"({condition})"), F.lit(1 << i)).otherwise(F.lit(0)) for i, condition in enumerate(filters.values())]
    rows = rows.select("id", "part", sum(bits[1:], bits[0]).alias("fails"))

    marked = store(_labelled(labels, id), "labels")
    named = rows.where("id is not null").join(marked, "id", "left").drop("id")
    lone = rows.where("id is null").select("part", "fails", *(F.lit(None).cast("boolean").alias(c) for c in ("good", "toxic")))
    of = {"n": F.lit(1), "good": F.col("good").cast("int"), "toxic": F.col("toxic").cast("int")}
    sums = named.unionByName(lone).groupBy("part", "fails").agg(
        *(F.sum(F.coalesce(value, F.lit(0))).alias(c) for c, value in of.items())
    )

    # How many fail none of each set of filters; and a document that fails k filters is removed by each in one of k orders.
    left = {c: ", ".join(f"sum(if(fails & {applied} = 0, {c}, 0))" for applied in range(whole + 1)) for c in of}
    shares = ", ".join(
        f"cast(sum(if(fails & {1 << i} <> 0, n * {factorial(len(names))} / bit_count(fails), 0)) as long)" for i in range(len(names))
    )
    parts = sums.groupBy("part").agg(
        *(F.expr(f"array({found})").alias(c) for c, found in left.items()), F.expr(f"array({shares})").alias("shares")
    )
    steps = parts.select("*", F.explode(_steps(names)).alias("x"))

    def at(column: str, applied) -> Column:
        return F.element_at(column, (applied + 1).cast("int"))

    own = F.expr("shiftleft(1, x.f)")
    removed = at("n", F.col("x.b")) - at("n", F.col("x.a"))
    return steps.select(
        "part", F.col("x.o").alias("filter_order"), F.col("x.s").alias("step"), at("n", F.col("x.a")).alias("kept"),
        removed.alias("removed"), (at("n", F.lit(0)) - at("n", own) - removed).alias("redundant"),
        (at("n", F.lit(whole) - own) - at("n", F.lit(whole))).alias("unique_fails"),
        (at("good", F.col("x.b")) - at("good", F.col("x.a"))).alias("good_lost"),
        (at("toxic", F.col("x.b")) - at("toxic", F.col("x.a"))).alias("toxic_lost"),
        at("shares", F.col("x.f")).alias("shapley"),
    )
