"""Near duplicates among vectors of one label: an exact join by cosine, with cover trees.

On the unit sphere a cosine is a distance, and links are distances up to a bound. Vectors that are equal
are one *class* from the start. Classes are dealt to cells, each around a pivot out of a bounded sample;
a class also visits the cells of later pivots whose side of the bisecting plane lies within the bound, so
the ends of each link meet in one cell. Large cells are dealt to blocks, and each pair of blocks is
one task's work, whatever a cell holds. In it each block is a cover tree: nested levels whose
radii halve. Both trees are walked together, from the roots. A pair of nodes further apart than
their covering radii and the bound allow is dropped; one that lies within the bound whole is
counted without being opened; what is left at the leaves is decided in double precision. A task
returns its counts and a forest of its links, so a group of near copies is never written out as pairs.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.components import components
from shelfmark.session import store

#: Classes meant for a cell, and the most bytes of all pivots together; beyond these cells grow.
CELL, PIVOT_BYTES = 2048, 16 << 20
#: Most classes of a block, in expectation.
BLOCK = 4096
#: Nodes of so many members are compared as they are.
LEAF = 24
#: How far rounding may move a distance, which is a root of a small difference, and a cosine.
SLACK = 1e-7
_TIE = 1e-12


def finite(vector: str) -> Column:
    """Whether a vector is there and has finite components only."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.col(vector).isNotNull() & ~F.exists(vector, odd)


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length, a row for each."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1).astype(np.float64)


def scaled(rows: np.ndarray) -> np.ndarray:
    """Each vector times a power of two, so that no product overflows or vanishes."""
    _, power = np.frexp(np.abs(rows).max(axis=1, keepdims=True))
    return np.ldexp(rows, -power)


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def apart(dots: np.ndarray) -> np.ndarray:
    """Distances of unit vectors from their inner products."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * dots))


def cosine_of(x: np.ndarray, y: np.ndarray) -> float:
    """The cosine with sums that are rounded once, whatever the order of the components."""
    dot, left, right = (math.fsum(p * q) for p, q in ((x, y), (x, x), (y, y)))
    return dot / math.sqrt(left * right)


class Tree:
    """A cover tree over unit vectors. ``order`` lists the rows so that each node's members are neighbours."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.center: list[int] = []
        self.radius: list[float] = []
        self.span: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        self.order = np.arange(len(points))
        self._open: list[tuple[int, float]] = []
        if len(points):
            self._node(0, len(points), 2.0)
        while self._open:
            self._split(*self._open.pop())

    def _node(self, low: int, high: int, level: float) -> int:
        """A node over members that lie within ``level`` of the first of them."""
        own = self.order[low:high]
        radius = float(apart(self.points[own] @ self.points[own[0]]).max()) if high > low + 1 else 0.0
        self.center.append(int(own[0]))
        self.radius.append(radius)
        self.span.append((low, high))
        self.children.append([])
        if high - low > LEAF and radius > 10 * SLACK:
            self._open.append((len(self.center) - 1, level))
        return len(self.center) - 1

    def _split(self, node: int, level: float) -> None:
        """Centres at half the radius, each further than that from those before it, with what they cover."""
        low, high = self.span[node]
        own = self.order[low:high].copy()
        level /= 2
        while level >= self.radius[node]:
            level /= 2
        centers = np.zeros(0, np.int64)
        owner = np.empty(len(own), np.int64)
        for at in range(0, len(own), 256):
            part = self.points[own[at : at + 256]]
            gap = apart(part @ self.points[own[centers]].T) if len(centers) else np.full((len(part), 1), 4.0)
            nearest, least = gap.argmin(axis=1), gap.min(axis=1)
            owner[at : at + len(part)] = nearest
            free = np.flatnonzero(least > level)
            new, among = [], apart(part[free] @ part[free].T)
            while len(free):
                far = among[0] > level
                new.append(at + free[0])
                owner[at + free[~far]] = len(centers) + len(new) - 1
                if far[1:].all():
                    free, among = free[1:], among[1:, 1:]
                else:
                    free, among = free[far], among[np.ix_(far, far)]
            centers = np.concatenate([centers, np.array(new, np.int64)])
        first = np.zeros(len(own), bool)
        first[centers] = True
        place = np.lexsort((~first, owner))
        self.order[low:high] = own[place]
        bounds = low + np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(centers)))])
        self.children[node] = [self._node(int(a), int(b), level) for a, b in zip(bounds, bounds[1:])]

    def parts(self, node: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
        """Centres, radii, spans and numbers of what a node is made of; the members of a leaf have no number."""
        if below := self.children[node]:
            return np.array([self.center[i] for i in below]), np.array([self.radius[i] for i in below]), np.array([self.span[i] for i in below]), below
        low, high = self.span[node]
        places = np.arange(low, high)
        return self.order[low:high], np.zeros(high - low), np.column_stack([places, places + 1]), [-1] * (high - low)


class Links:
    """What a walk over two trees finds: how much each row is linked with, and which rows hang together."""

    def __init__(self, raw: np.ndarray, points: np.ndarray, weights: np.ndarray, cosine: float):
        self.raw, self.points, self.weights, self.cosine = raw, points, weights, cosine
        self.bound = math.sqrt(2 - 2 * cosine)
        self.linked = np.zeros(len(points), np.int64)
        self.root = np.arange(len(points))

    def _join(self, rows: np.ndarray) -> None:
        roots = np.unique(self.root[rows])
        if len(roots) > 1:
            self.root[np.isin(self.root, roots)] = roots[0]

    def walk(self, left: Tree, right: Tree, rows_left: np.ndarray, rows_right: np.ndarray) -> None:
        """All links between the trees, whose points are ``rows_left`` and ``rows_right``; of one tree if it is given twice."""
        one = left is right
        todo = [(0, 0)] if left.center and right.center else []
        while todo:
            a, b = todo.pop()
            x, y = left.parts(a), right.parts(b)
            for at in range(0, len(x[0]), 512):
                self._met(left, right, rows_left, rows_right, one and a == b, at, x, y, todo)

    def _met(self, left, right, rows_left, rows_right, same, at, x, y, todo):
        (centers_x, radii_x, spans_x, nodes_x), (centers_y, radii_y, spans_y, nodes_y) = x, y
        n = min(512, len(centers_x) - at)
        dots = left.points[centers_x[at : at + n]] @ right.points[centers_y].T
        gap, reach = apart(dots), radii_x[at : at + n, None] + radii_y[None, :]
        near = gap - reach <= self.bound + SLACK
        if same:  # each pair once, and each part with itself
            near &= np.arange(at, at + n)[:, None] <= np.arange(len(centers_y))[None, :]
        # Pairs of single members are decided by the cosine itself.
        single = (np.ptp(spans_x[at : at + n], axis=1) == 1)[:, None] & (np.ptp(spans_y, axis=1) == 1)[None, :]
        inside = near & ~single & (gap + reach <= self.bound - SLACK)
        exact = near & single
        if same:
            exact &= np.arange(at, at + n)[:, None] != np.arange(len(centers_y))[None, :]
        exact &= dots >= self.cosine - _TIE
        for i, j in np.argwhere(exact & (dots < self.cosine + _TIE)):
            exact[i, j] = cosine_of(self.raw[rows_left[centers_x[at + i]]], self.raw[rows_right[centers_y[j]]]) >= self.cosine
        if exact.any():
            ours, theirs = rows_left[centers_x[at : at + n]], rows_right[centers_y]
            self.linked[ours] += exact @ self.weights[theirs]
            self.linked[theirs] += exact.T @ self.weights[ours]
            for i in np.flatnonzero(exact.any(axis=1)):
                self._join(np.append(theirs[exact[i]], ours[i]))
        for i, j in np.argwhere(near & ~single & ~inside):
            todo.append((self._node(left, nodes_x[at + i], spans_x[at + i]), self._node(right, nodes_y[j], spans_y[j])))
        for i, j in np.argwhere(inside):
            self._whole(left, right, rows_left, rows_right, same and at + i == j, spans_x[at + i], spans_y[j])

    @staticmethod
    def _node(tree: Tree, node: int, span) -> int:
        """A node, or one made for a member of a leaf."""
        if node >= 0:
            return node
        tree.center.append(int(tree.order[span[0]]))
        tree.radius.append(0.0)
        tree.span.append((int(span[0]), int(span[1])))
        tree.children.append([])
        return len(tree.center) - 1

    def _whole(self, left, right, rows_left, rows_right, itself, span_x, span_y):
        """All members of two nodes are linked, or all of one node with each other."""
        ours = rows_left[left.order[slice(*span_x)]]
        if itself:
            self.linked[ours] += self.weights[ours].sum() - self.weights[ours]
            self._join(ours)
            return
        theirs = rows_right[right.order[slice(*span_y)]]
        self.linked[ours] += self.weights[theirs].sum()
        self.linked[theirs] += self.weights[ours].sum()
        self._join(np.concatenate([ours, theirs]))


def linked(raw: np.ndarray, weights: np.ndarray, side: np.ndarray, cosine: float, within: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """For each vector the weight of those that it is linked with, and the first row that its links reach.

    Vectors of ``side`` 0 are compared with those of side 1, or with each other if ``within``.
    """
    raw = scaled(raw)
    found = Links(raw, unit(raw), weights, cosine)
    groups = [np.flatnonzero(side == s) for s in (0, 1)]
    trees = [Tree(found.points[rows]) for rows in groups]
    if within:
        found.walk(trees[0], trees[0], groups[0], groups[0])
    else:
        found.walk(trees[0], trees[1], groups[0], groups[1])
    return found.linked, found.root


def _dealt(pivots: dict[str, np.ndarray], bound: float, batches):
    """Each class in the cell of its nearest pivot, and as a visitor in those it may have links in."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            group = np.array(part["group"].to_pylist(), object)
            home, rows, cells = np.zeros(len(group), np.int64), [], []
            for name in {x for x in group if x in pivots}:
                own, around = np.flatnonzero(group == name), pivots[name]
                gap = apart(unit(scaled(matrix(part["vector"].take(pa.array(own))))) @ around.T)
                home[own] = near = gap.argmin(axis=1)
                between = apart(around @ around.T)[near]
                side = gap**2 - gap.min(axis=1)[:, None] ** 2 <= 2 * between * (bound + SLACK) + SLACK
                row, cell = np.nonzero(side & (np.arange(len(around))[None, :] > near[:, None]))
                rows.append(own[row])
                cells.append(cell)
            take = np.concatenate([np.arange(len(group)), *rows])
            cell = np.concatenate([home, *cells])
            guest = np.arange(len(take)) >= len(group)
            for to in range(0, len(take), 8192):
                some = take[to : to + 8192]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([f"{group[i]}#{c}" for i, c in zip(some, cell[to:])], pa.string()),
                        pa.array(guest[to : to + 8192]), *(part[c].take(pa.array(some)) for c in ("key", "n", "vector")),
                    ],
                    ["cell", "guest", "key", "n", "vector"],
                )


def _compared(cosine: float, table: pa.Table) -> pa.Table:
    """Counts of a pair of blocks, and for each class the least key its links reach there."""
    table = table.sort_by("key")
    side = table["side"].to_numpy()
    within = bool(table["within"][0].as_py())
    weights = table["n"].to_numpy().astype(np.int64)
    count, root = linked(matrix(table["vector"]), weights, side, cosine, within)
    keep = np.flatnonzero(count > 0)
    keys = table["key"].combine_chunks()
    return pa.table({"a": keys.take(pa.array(keep)), "b": keys.take(pa.array(root[keep])), "n": pa.array(count[keep])})


def _links(classes: DataFrame, cosine: float) -> DataFrame:
    """For each class and each pair of blocks with links of it: ``a``, its key, the least key ``b`` that they reach,
    and how many rows it is linked with."""
    bound = math.sqrt(2 - 2 * cosine)
    sizes = classes.agg(F.count("*"), F.max(F.size("vector"))).first()
    share = min(1 / CELL, PIVOT_BYTES / (8 * max(1, sizes[0]) * max(1, sizes[1] or 1)))
    drawn = classes.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(share * (1 << 30)))
    pivots: dict[str, list] = {}
    for group, vector in drawn.select("group", "vector").orderBy("key").toLocalIterator():
        pivots.setdefault(group, []).append(vector)
    held = {g: unit(scaled(np.array(v, np.float64))) for g, v in pivots.items()}

    kinds = dict(classes.dtypes)
    schema = f"cell string, guest boolean, key {kinds['key']}, n long, vector {kinds['vector']}"
    placed = classes.mapInArrow(partial(_dealt, held, bound), schema)
    blocks = placed.groupBy("cell").agg(
        F.ceil(F.count(F.when(~F.col("guest"), 1)) / BLOCK).cast("int").alias("homes"),
        F.ceil(F.count(F.when(F.col("guest"), 1)) / BLOCK).cast("int").alias("guests"),
    )
    placed = placed.join(store(blocks, "blocks"), "cell")
    own = F.pmod(F.xxhash64("key"), F.when(F.col("guest"), F.col("guests")).otherwise(F.greatest("homes", F.lit(1)))).cast("int")
    # A block at home meets itself, each other home block once, and each block of guests.
    homes = F.transform(
        F.sequence(F.lit(0), F.col("homes") - 1),
        lambda i: F.struct(
            F.lit("h").alias("kind"), F.least(i, F.col("own")).alias("x"), F.greatest(i, F.col("own")).alias("y"),
            F.when(i < F.col("own"), 1).otherwise(0).alias("side"),
        ),
    )
    guests = F.transform(
        F.sequence(F.lit(0), F.col("guests") - 1),
        lambda i: F.struct(F.lit("g").alias("kind"), F.col("own").alias("x"), i.alias("y"), F.lit(0).alias("side")),
    )
    visits = F.transform(
        F.sequence(F.lit(0), F.col("homes") - 1),
        lambda i: F.struct(F.lit("g").alias("kind"), i.alias("x"), F.col("own").alias("y"), F.lit(1).alias("side")),
    )
    none = F.array().cast("array<struct<kind:string,x:int,y:int,side:int>>")
    at_home = F.concat(homes, F.when(F.col("guests") > 0, guests).otherwise(none))
    tasks = F.when(~F.col("guest"), at_home).when(F.col("homes") > 0, visits).otherwise(none)
    dealt = placed.withColumn("own", own).withColumn("task", F.explode(tasks)).select(
        F.concat_ws("#", "cell", "task.kind", "task.x", "task.y").alias("task"), "task.side",
        ((F.col("task.kind") == "h") & (F.col("task.x") == F.col("task.y"))).alias("within"), "key", "n", "vector",
    )
    return dealt.groupBy("task").applyInArrow(lambda table: _compared(cosine, table), f"a {kinds['key']}, b {kinds['key']}, n long")


def near_vectors(
    rows: DataFrame, id: str = "vec_id", label: str = "label", vector: str = "embedding", cosine: float = 0.98
) -> DataFrame:
    """One row for each row: its id, ``n_links``, ``component_id`` and ``kept``.

    Two rows are linked if their labels are equal and not null and the cosine of their vectors in
    double precision is at least ``cosine`` (over 0). ``component_id`` is the smallest id that links reach, the
    row's own included, ``kept`` whether it is the row's own.

    * Vectors that are null, empty, zero, or hold a null or a component that is not finite are linked with
      nothing, and so are vectors of unlike lengths; such rows are kept.
    * Rows that repeat an id are rows each, and linked if their vectors are. A null id is never the smallest;
      a component without any id has null, and rows without an id are not kept.
    * Other columns are not looked at. An empty table gives an empty result.
    """
    if not 0 < cosine < 1:
        raise ValueError("a cosine between 0 and 1")
    ready = finite(vector) & F.col(label).isNotNull() & F.exists(vector, lambda x: x != 0)
    digest = F.concat(F.hex(F.xxhash64(vector)), F.hex(F.xxhash64(F.lit(41), F.col(vector))))
    group = F.concat_ws("#", F.col(label).cast("string"), F.size(vector).cast("string"))
    named = rows.select(
        F.col(id).alias("id"), F.when(ready, group).alias("group"),
        F.when(ready, F.concat_ws("#", group, digest)).alias("key"), F.when(ready, F.col(vector)).alias("vector"),
    )
    classes = named.where("key is not null").groupBy("key").agg(
        F.first("group").alias("group"), F.first("vector").alias("vector"), F.count("*").alias("n"), F.min("id").alias("low")
    )
    classes = store(classes, "classes")
    links = store(_links(classes, cosine), "links")
    found = store(components(links, "a", "b"), "components")

    counted = links.groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("others"))
    placed = classes.select("key", "n", "low").join(found.withColumnRenamed("node", "key"), "key", "left")
    placed = store(placed.join(counted, "key", "left"), "placed")
    least = placed.where("component is not null").groupBy("component").agg(F.min("low").alias("least"))
    placed = placed.join(store(least, "least"), "component", "left").select(
        "key", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("least", "low").alias("first")
    )
    alone = named.where("key is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    met = named.where("key is not null").select("id", "key").join(store(placed, "verdicts"), "key")
    out = met.select("id", "n_links", F.col("first").alias("component_id")).unionByName(alone)
    return out.select(
        F.col("id").alias(id), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept")
    )
