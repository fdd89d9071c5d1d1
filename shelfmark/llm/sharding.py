"""Shards of equal size by best-fit-decreasing bin packing of indivisible groups.

Groups of equal texts are never split. They are packed in two steps, each of the same kind: groups
sorted by size enter the bin with the least room that still holds them, found in a balanced
tree. First, groups are spread over a fixed number of lots and packed there into small bins; then
all small bins, whose number has a fixed bound, and the groups larger than one are packed into
the shards. If the number of shards is given, the least capacity that suffices is
searched for, so the shards come out near equal.
"""

from __future__ import annotations

from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.session import store

#: Lots that groups are spread over, and small bins for each shard. Together with the groups that
#: are larger than a small bin, LOTS + 2 * shards * FINE bins at most reach the driver.
LOTS, FINE = 4096, 1024
#: Slices of a shard that its rows are numbered in, for all shards together.
SLICES = 32768


class BalancedTree:
    """A set of pairs of whole numbers, kept balanced by height (AVL)."""

    def __init__(self):
        self.root = None

    def insert(self, key: tuple[int, int]) -> None:
        self.root = self._insert(self.root, key)

    def remove(self, key: tuple[int, int]) -> None:
        self.root = self._remove(self.root, key)

    def at_least(self, key: tuple[int, int]) -> tuple[int, int] | None:
        """The smallest member that isn't under ``key``."""
        node, found = self.root, None
        while node:
            if node[0] >= key:
                node, found = node[1], node[0]
            else:
                node = node[2]
        return found

    # A node is a list: key, left, right, height.
    @staticmethod
    def _height(node) -> int:
        return node[3] if node else 0

    def _lift(self, node, side: int):
        """Rotate the child at ``side`` up."""
        child = node[side]
        node[side], child[3 - side] = child[3 - side], node
        self._measure(node)
        return self._measure(child)

    def _measure(self, node):
        node[3] = 1 + max(self._height(node[1]), self._height(node[2]))
        return node

    def _even(self, node):
        self._measure(node)
        lean = self._height(node[1]) - self._height(node[2])
        if abs(lean) < 2:
            return node
        side = 1 if lean > 0 else 2
        child = node[side]
        if self._height(child[side]) < self._height(child[3 - side]):
            node[side] = self._lift(child, 3 - side)
        return self._lift(node, side)

    def _insert(self, node, key):
        if node is None:
            return [key, None, None, 1]
        side = 1 if key < node[0] else 2
        node[side] = self._insert(node[side], key)
        return self._even(node)

    def _remove(self, node, key):
        if key != node[0]:
            side = 1 if key < node[0] else 2
            node[side] = self._remove(node[side], key)
            return self._even(node)
        if node[1] is None or node[2] is None:
            return node[1] or node[2]
        next_ = node[2]
        while next_[1]:
            next_ = next_[1]
        node[0] = next_[0]
        node[2] = self._remove(node[2], next_[0])
        return self._even(node)


class Bins:
    """Open bins of one capacity; what is larger gets a bin of its own."""

    def __init__(self, capacity: int):
        self.capacity, self.count, self.rooms = capacity, 0, BalancedTree()

    def put(self, size: int) -> int:
        """The number of the bin with the least room that ``size`` fits in."""
        found = self.rooms.at_least((size, -1))
        if found is None:
            room, number = self.capacity - size, self.count
            self.count += 1
        else:
            self.rooms.remove(found)
            room, number = found[0] - size, found[1]
        if room > 0:
            self.rooms.insert((room, number))
        return number


def best_fit(sizes: list[int], capacity: int) -> tuple[list[int], int]:
    """The bin of each size, which come in falling order, and the number of bins."""
    bins = Bins(capacity)
    return [bins.put(size) for size in sizes], bins.count


def least_capacity(sizes: list[int], shards: int) -> int:
    """A capacity, least but for a ten thousandth, at which best fit needs no more shards than given."""
    low = max(sum(sizes) // shards, sizes[0] if sizes else 1, 1)
    high = max(low, 2 * (sum(sizes) // shards + 1) + (sizes[0] if sizes else 0))
    while high - low > low // 10_000:
        middle = (low + high) // 2
        low, high = (low, middle) if best_fit(sizes, middle)[1] <= shards else (middle + 1, high)
    return high


def _packed(capacity: int, batches):
    """Groups come by lot, the largest first; each lot has bins of its own."""
    lot, bins = None, None
    for batch in batches:
        found = []
        for at, size in zip(batch["lot"].to_pylist(), batch["bytes"].to_pylist()):
            if at != lot:
                lot, bins = at, Bins(capacity)
            found.append((at << 40) + bins.put(size))
        yield pa.RecordBatch.from_arrays(
            [batch["key"], batch["bytes"], pa.array(found, pa.int64())], ["key", "bytes", "bin"]
        )


def shards(
    docs: DataFrame,
    count: int | None = 8,
    capacity: int | None = None,
    id: str = "doc_id",
    text: str = "text",
    keep: list[str] | None = None,
    name: str = "sharding",
) -> DataFrame:
    """The rows of ``docs`` (the columns in ``keep``, or all) with one further column, a struct of
    ``size``, ``shard`` and ``slot``: the place in the shard, from 0 and without gaps.

    Give ``count`` for that many shards of near equal bytes, or ``capacity`` for as few shards as best fit
    finds of at most that many bytes; a larger group is then a shard of its own.

    * The size of a row is its text's UTF-8 bytes and 1; of a null text 1.
    * Equal texts are one group, and so are all null texts; a group with a large part of all bytes
      makes its shard that large, as groups are never split.
    * Slots follow slices of the id's and text's hash, then ids; rows equal in both are in any order.
    * An empty table gives an empty result. Columns of any name pass unchanged; one called ``name``
      is replaced.
    """
    kept = [c for c in (keep or docs.columns) if c != name]
    value = F.col(text).cast("string")
    rows = docs.select(
        *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)),
        F.coalesce(F.unhex(F.sha2(value, 256)), F.lit(b"\x00")).alias("key"),
        (F.coalesce(F.octet_length(value), F.lit(0)) + 1).cast("long").alias("size"), F.col(id).alias("id"),
    )
    if text not in kept:
        rows = store(rows, "sizes")  # the text is read once
    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"))
    groups = store(groups.withColumn("lot", F.pmod(F.xxhash64("key"), F.lit(LOTS))), "groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    parts = count if capacity is None else -(-total // capacity)
    small = max(1, total // (max(1, parts) * FINE)) if capacity is None else max(1, min(capacity, total // (max(1, parts) * FINE)))
    lots = groups.repartition("lot").sortWithinPartitions("lot", F.desc("bytes"), "key")
    packed = store(lots.mapInArrow(partial(_packed, small), "key binary, bytes long, bin long"), "bins")
    bins = packed.groupBy("bin").agg(F.sum("bytes").alias("bytes")).collect()
    bins = sorted(((b.bytes, b.bin) for b in bins), key=lambda x: (-x[0], x[1]))
    sizes = [size for size, _ in bins]
    found, _ = best_fit(sizes, least_capacity(sizes, count) if capacity is None else capacity)
    numbers = docs.sparkSession.createDataFrame([(b, s) for (_, b), s in zip(bins, found)], "bin long, shard int")

    placed = rows.join(packed.join(F.broadcast(numbers), "bin").select("key", "shard"), "key")
    slices = max(1, SLICES // max(1, len(set(found))))
    placed = placed.withColumn("slice", F.pmod(F.xxhash64("id", "key"), F.lit(slices)))
    begins = placed.groupBy("shard", "slice").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("slice")) - F.col("n")
    begins = begins.select("shard", "slice", before.alias("before"))
    number = F.row_number().over(Window.partitionBy("shard", "slice").orderBy("id", "key")) - 1
    numbered = placed.join(begins, ["shard", "slice"]).withColumn("slot", (F.col("before") + number).cast("long"))
    return numbered.select(
        *(F.col(f"c{i}").alias(c) for i, c in enumerate(kept)), F.struct("size", "shard", "slot").alias(name)
    )
