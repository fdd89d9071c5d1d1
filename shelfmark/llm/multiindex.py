"""Hard negatives by an inverted multi-index, exact for whole-number vectors.

Each vector is cut in two halves, each half is named by the nearest of a codebook, and the two
names make its cell. Codebooks are fitted on a bounded sample; the radii around their centres
are greatest distances over all rows, so the inner product of an anchor with anything in a
cell is at most the sum of two half-scores, each at a centre plus the anchor's length times the
radius. Cells are laid out in blocks of bounded size, one task's work with a bounded number of anchors. In a
block a heap walks the two sorted half-score lists (multi-sequence) and so meets its cells from
the highest bound down; it stops when the next bound is below all that is still asked for. An anchor looks at
its best block first. What it finds there is what a block must be able to beat for a second look.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.covertree import matrix
from shelfmark.session import store

#: Rows the codebooks are fitted on, in expectation, and rounds of the fit.
FITTED, ROUNDS = 20_000, 8
#: Rows meant for a cell, and the most centres of a half.
CELL, MOST_CENTERS = 256, 256
#: Rows of a block and anchors that meet it in one task, in expectation.
BLOCK, ANCHORS = 16_384, 4_096
#: Whole numbers up to here are exact in double precision.
EXACT = 2.0**53
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def fitted(rows: np.ndarray, count: int) -> np.ndarray:
    """Centres of the rows by Lloyd's rounds from evenly drawn rows."""
    rows = np.unique(rows, axis=0)
    centers = rows[np.random.Generator(np.random.PCG64(13)).permutation(len(rows))[:count]]
    for _ in range(ROUNDS):
        own = nearest(rows, centers)
        sizes = np.bincount(own, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, own, rows)
        centers = np.where(sizes[:, None] > 0, sums / np.maximum(1, sizes)[:, None], centers)
    return centers


def nearest(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return ((centers * centers).sum(axis=1)[None, :] - 2 * rows @ centers.T).argmin(axis=1)


@dataclass
class Index:
    """Codebooks and radii of both halves, and the first block and number of blocks of each cell."""

    centers: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    first: np.ndarray
    blocks: np.ndarray

    def halves(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.centers[0].shape[1]
        return rows[:, :at], rows[:, at:]

    def codes(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(nearest(h, c) for h, c in zip(self.halves(rows), self.centers))

    def bounds(self, anchors: np.ndarray) -> list[np.ndarray]:
        """For each anchor and centre of a half the most that the half can score, rounding included."""
        found = []
        for half, centers, radii in zip(self.halves(anchors), self.centers, self.radii):
            length = np.sqrt((half * half).sum(axis=1))[:, None]
            most = half @ centers.T + length * radii[None, :]
            found.append(most + 1e-9 * (length * (np.sqrt((centers * centers).sum(axis=1)) + radii)[None, :] + 1))
        return found

    def of_blocks(self, bounds: list[np.ndarray]) -> np.ndarray:
        """The most that an anchor can score in each block; minus infinity in one without cells."""
        cells = np.flatnonzero(self.blocks)
        i, j = np.divmod(cells, len(self.centers[1]))
        found = np.full((len(bounds[0]), int((self.first + self.blocks).max(initial=0))), -np.inf)
        # Cells that share a block are neighbours, and a cell with several has them alone.
        shared = self.blocks[cells] == 1
        each = bounds[0][:, i[shared]] + bounds[1][:, j[shared]]
        starts = np.flatnonzero(np.diff(self.first[cells[shared]], prepend=-1))
        if len(starts):
            found[:, self.first[cells[shared]][starts]] = np.maximum.reduceat(each, starts, axis=1)
        for cell, x, y in zip(cells[~shared], i[~shared], j[~shared]):
            found[:, self.first[cell] : self.first[cell] + self.blocks[cell]] = (bounds[0][:, x] + bounds[1][:, y])[:, None]
        return found


def padded(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of ``width`` doubles; a shorter one has zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def scores(rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where no sum can be rounded, else in Python's whole numbers."""
    if not len(rows) or np.abs(rows).max() * np.abs(anchor).sum() < EXACT:
        return (rows @ anchor).astype(np.int64)
    ours = [int(x) for x in anchor]
    exact = (sum(int(x) * y for x, y in zip(row, ours)) for row in rows)
    return np.array([min(max(x, _LOW), _HIGH) for x in exact], np.int64)


class Best:
    """The first ``count`` of the rows met whose scores lie in a window: highest first, ties by the least name."""

    def __init__(self, low: int, high: int, count: int, floor: int | None):
        self.low, self.high, self.count, self.rows = low, high, count, []
        self.floor = low if floor is None else max(low, floor)

    def add(self, values: np.ndarray, names: np.ndarray, allowed: np.ndarray) -> None:
        fit = np.flatnonzero(allowed & (values >= self.floor) & (values <= self.high))
        if len(fit) > self.count:
            edge = np.partition(values[fit], len(fit) - self.count)[len(fit) - self.count]
            fit = fit[values[fit] >= edge]
        self.rows = sorted(self.rows + [(-int(values[i]), int(names[i])) for i in fit])[: self.count]
        if len(self.rows) == self.count:
            self.floor = max(self.floor, -self.rows[-1][0])


def cells_by_bound(left: np.ndarray, right: np.ndarray):
    """Places in two lists, from the greatest sum down, by a heap over both in descending order."""
    first, second = np.argsort(-left, kind="stable"), np.argsort(-right, kind="stable")
    heap, met = [(-(left[first[0]] + right[second[0]]), 0, 0)], {(0, 0)}
    while heap:
        bound, a, b = heapq.heappop(heap)
        yield -bound, int(first[a]), int(second[b])
        for x, y in ((a + 1, b), (a, b + 1)):
            if x < len(first) and y < len(second) and (x, y) not in met:
                met.add((x, y))
                heapq.heappush(heap, (-(left[first[x]] + right[second[y]]), x, y))


def _searched(index: Index, width: int, same: bool, count: int, held: pa.Table, asking: pa.Table) -> pa.Table:
    """What each anchor finds in one block for each of its windows."""
    out = {"ask": [], "window": [], "id": [], "score": []}
    if held.num_rows and asking.num_rows:
        rows = padded(held["vector"], width)
        i, j = index.codes(rows)
        lefts, i = np.unique(i, return_inverse=True)
        rights, j = np.unique(j, return_inverse=True)
        order = np.argsort(i * len(rights) + j, kind="stable")
        rows, cell = rows[order], (i * len(rights) + j)[order]
        at = np.searchsorted(cell, np.arange(len(lefts) * len(rights) + 1))
        ids, row_keys = held["id"].to_numpy()[order], held["key"].to_numpy()[order]
        both = pa.concat_arrays([x["label"].combine_chunks() for x in (held, asking)]).dictionary_encode().indices.to_numpy()
        labels, wanted = both[: len(rows)][order], both[len(rows) :]
        anchors = padded(asking["vector"], width)
        bounds = index.bounds(anchors)
        keys = asking["ask"].to_pylist()
        windows = asking["windows"].to_pylist()
        for k, anchor in enumerate(anchors):
            bests = [Best(w["low"], w["high"], count, w["floor"]) for w in windows[k]]
            for bound, a, b in cells_by_bound(bounds[0][k][lefts], bounds[1][k][rights]):
                if bound < min(x.floor for x in bests):
                    break
                c = a * len(rights) + b
                low, high = at[c], at[c + 1]
                if low == high:
                    continue
                values = scores(rows[low:high], anchor)
                allowed = ((labels[low:high] == wanted[k]) == same) & (row_keys[low:high] != keys[k])
                for best in bests:
                    best.add(values, ids[low:high], allowed)
            for w, best in zip(windows[k], bests):
                for score, name in best.rows:
                    for c, value in zip(out, (keys[k], w["window"], name, -score)):
                        out[c].append(value)
    kinds = {"ask": pa.int64(), "window": pa.int32(), "id": pa.int64(), "score": pa.int64()}
    return pa.table({c: pa.array(out[c], kind) for c, kind in kinds.items()})


def _in_blocks(index: Index, width: int, batches):
    """Rows with the block of their cell; a large cell's are spread over its blocks by their keys."""
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            i, j = index.codes(padded(part["vector"], width))
            cell = i * len(index.centers[1]) + j
            own = part["key"].to_numpy() % np.maximum(1, index.blocks[cell])
            yield pa.RecordBatch.from_arrays(
                [pa.array(index.first[cell] + own, pa.int64()), *part.columns], ["block", *part.schema.names]
            )


def _visits(index: Index, width: int, again: bool, batches):
    """Anchors with the block of the highest bound or, ``again``, with all others that may still matter."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            most = index.of_blocks(index.bounds(padded(part["vector"], width)))
            best = most.argmax(axis=1)
            visit = np.zeros(most.shape, bool)
            visit[np.arange(len(most)), best] = True
            if again:
                floors = [min(max(w["low"], w["low"] if w["floor"] is None else w["floor"]) for w in x) for x in part["windows"].to_pylist()]
                visit = ~visit & (most >= np.array(floors, np.float64)[:, None] * (1 - 1e-12) - 1) & (most > -np.inf)
            rows, blocks = np.nonzero(visit)
            for to in range(0, len(rows), 2048):
                some = part.take(pa.array(rows[to : to + 2048]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blocks[to : to + 2048], pa.int64()), *some.columns], ["block", *some.schema.names]
                )


def _merged(found: DataFrame, count: int) -> DataFrame:
    """The first ``count`` of each ask and window."""
    order = F.struct((-F.col("score")).alias("down"), "id")
    best = found.groupBy("ask", "window").agg(F.array_sort(F.collect_list(order)).alias("best"))
    return best.select("ask", "window", F.posexplode(F.slice("best", 1, count)).alias("at", "x")).select(
        "ask", "window", (F.col("at") + 1).alias("rank"), F.col("x.id").alias("id"), (-F.col("x.down")).alias("score")
    )


_WINDOWS = "windows array<struct<window:int,low:long,high:long,floor:long>>"


def _search(rows: DataFrame, asks: DataFrame, index: Index, width: int, same: bool, count: int, parts: int) -> DataFrame:
    """For each ask and window the first ``count`` rows of the ask's label (or of any other): ``ask, window, rank, id, score``."""
    kinds = dict(rows.dtypes)
    held = rows.mapInArrow(partial(_in_blocks, index, width), f"block long, key long, id long, label {kinds['label']}, vector {kinds['vector']}")
    held = held.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    schema = f"block long, ask long, label {kinds['label']}, vector {kinds['vector']}, {_WINDOWS}"

    def look(asks: DataFrame, again: bool) -> DataFrame:
        asking = asks.mapInArrow(partial(_visits, index, width, again), schema)
        asking = asking.withColumn("share", F.pmod("ask", F.lit(parts)).cast("int"))
        met = held.groupBy("block", "share").cogroup(asking.groupBy("block", "share"))
        return met.applyInArrow(
            lambda held, asking: _searched(index, width, same, count, held, asking), "ask long, window int, id long, score long"
        )

    found = store(look(asks, False), "first-look")
    # The last of a full list is what any other row must reach.
    full = _merged(found, count).where(F.col("rank") == count)
    floors = full.groupBy("ask").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("floors"))
    raised = F.transform(
        "windows",
        lambda w: F.struct(
            w["window"].alias("window"), w["low"].alias("low"), w["high"].alias("high"),
            F.col("floors")[w["window"]].alias("floor"),
        ),
    )
    asks = asks.join(floors, "ask", "left").select("ask", "label", "vector", raised.alias("windows"))
    more = look(store(asks, "asks"), True)
    return _merged(found.unionByName(more), count)


def fit(rows: DataFrame, width: int, total: int) -> Index:
    """Codebooks from a bounded sample; radii and the sizes of cells over all rows."""
    split = max(1, width // 2)
    share = min(1.0, FITTED / max(1, total))
    drawn = rows.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) <= int(share * (1 << 30))).select("vector").orderBy("key")
    sample = np.zeros((0, width))
    if total:
        sample = padded(pa.array([r[0] for r in drawn.toLocalIterator()], pa.list_(pa.int64())), width)
    count = int(min(MOST_CENTERS, max(1, round((total / CELL) ** 0.5))))
    if len(sample):
        centers = fitted(sample[:, :split], count), fitted(sample[:, split:], count)
    else:
        centers = np.zeros((1, split)), np.zeros((1, width - split))
    n = len(centers[0]) * len(centers[1])
    index = Index(centers, tuple(np.zeros(len(c)) for c in centers), np.zeros(n, np.int64), np.zeros(n, np.int64))
    measured = rows.mapInArrow(partial(_measured, index, width), "cell long, n long, left double, right double")
    for cell, size, left, right in measured.groupBy("cell").agg(F.sum("n"), F.max("left"), F.max("right")).collect():
        i, j = divmod(cell, len(centers[1]))
        index.radii[0][i], index.radii[1][j] = max(index.radii[0][i], left), max(index.radii[1][j], right)
        index.blocks[cell] = size
    _lay_out(index)
    return index


def _measured(index: Index, width: int, batches):
    """Sizes of cells, and the greatest distances from their centres, of a task's rows."""
    for batch in batches:
        rows = padded(batch["vector"], width)
        i, j = index.codes(rows)
        gaps = [np.sqrt(((h - c[k]) ** 2).sum(axis=1)) * (1 + 1e-12) for h, c, k in zip(index.halves(rows), index.centers, (i, j))]
        cells, own = np.unique(i * len(index.centers[1]) + j, return_inverse=True)
        most = [np.zeros(len(cells)) for _ in gaps]
        for m, gap in zip(most, gaps):
            np.maximum.at(m, own, gap)
        sizes = np.bincount(own, minlength=len(cells))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells, pa.int64()), pa.array(sizes, pa.int64()), *map(pa.array, most)], ["cell", "n", "left", "right"]
        )


def _lay_out(index: Index) -> None:
    """Neighbouring cells share a block while they fit; a cell over the size of one has as many as it needs."""
    block, free = -1, 0
    for cell in np.flatnonzero(index.blocks):
        size = int(index.blocks[cell])
        parts = -(-size // BLOCK)
        if parts > 1:
            index.first[cell], index.blocks[cell] = block + 1, parts
            block, free = block + parts, 0
            continue
        if size > free:
            block, free = block + 1, BLOCK
        index.first[cell], index.blocks[cell] = block, 1
        free -= size


def hard_negatives(
    rows: DataFrame, id: str = "vec_id", label: str = "label", vector: str = "vector", anchor: str = "anchor",
    positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95,
) -> DataFrame:
    """For each anchor and each of its ``positives`` best rows of its label, the first ``negatives`` rows of other labels
    that score from ``least`` to ``most`` hundredths of what the positive scores.

    A score is the inner product of two vectors of whole numbers, exact (and held within a long); higher ones come
    first, ties by the smaller id. Returns ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``
    and ``negative_score``.

    * Rows with a null id, label or vector, or with a null component, take no part; a null ``anchor`` is none.
    * Rows alike in id, label and vector are one row. Rows that share only an id are rows each, anchors too.
    * Vectors of unlike lengths score over the components they share; an empty one scores 0.
    * Of a negative positive score nothing lies in the window. An empty table gives an empty result; other
      columns are not looked at.
    """
    if min(positives, negatives) < 1 or not 0 < least <= most:
        raise ValueError("at least one positive and negative, and a window")
    ready = F.col(vector).isNotNull() & ~F.exists(vector, lambda x: x.isNull()) & F.col(label).isNotNull() & F.col(id).isNotNull()
    held = rows.where(ready).select(
        F.col(id).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<long>").alias("vector"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    )
    held = held.groupBy(F.xxhash64("id", "label", "vector").alias("key"), "id", "label").agg(
        F.first("vector").alias("vector"), F.max("anchor").alias("anchor")
    )
    held = store(held, "vectors")
    total, asking, width = held.agg(F.count("*"), F.count_if("anchor"), F.max(F.size("vector"))).first()
    width = max(1, width or 0)
    index = fit(held.select("key", "vector"), width, total)
    parts = max(1, -(-asking // ANCHORS))
    rows = held.select("key", "id", "label", "vector")
    everything = F.array(F.struct(F.lit(0).alias("window"), F.lit(_LOW).alias("low"), F.lit(_HIGH).alias("high"), F.lit(None).cast("long").alias("floor")))
    asks = held.where("anchor").select(F.col("key").alias("ask"), "label", "vector", everything.alias("windows"))
    best = store(_search(rows, asks, index, width, True, positives, parts), "positives")

    # In whole numbers: least * p <= 100 * n <= most * p.
    low, high = F.ceil(F.lit(least) * F.col("score").cast("decimal(38,0)") / 100), F.floor(F.lit(most) * F.col("score").cast("decimal(38,0)") / 100)
    fit_in = best.select("ask", "rank", low.cast("long").alias("low"), high.cast("long").alias("high")).where("low <= high")
    window = F.struct(F.col("rank").alias("window"), "low", "high", F.lit(None).cast("long").alias("floor"))
    windows = fit_in.groupBy("ask").agg(F.collect_list(window).alias("windows"))
    asks = asks.select("ask", "label", "vector").join(windows, "ask")
    found = _search(rows, store(asks, "asks"), index, width, False, negatives, parts)

    own = held.where("anchor").select(F.col("key").alias("ask"), F.col("id").alias("anchor_id"))
    positive = best.select("ask", F.col("rank").alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(positive, ["ask", "window"]).join(own, "ask").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
