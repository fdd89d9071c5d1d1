"""Order, one page, and the rank of every row without a one-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from shelfmark.functions.columns import backtick, column_name
from shelfmark.session import store

# A page is cut by a per-task top-k while its offset is at most this; each task sends
# that many rows, and those of the page, to the final merge. Deeper pages are narrowed first.
TOP_ROWS = 10_000

# Bounds that a deep page is looked for between, and the rows they are chosen from.
BOUNDS, SAMPLE = 32, 1024

# monotonically_increasing_id() holds the partition above bit 33, the row below it.
_ROW_BITS = 33


def order_by(df: DataFrame, sort_by: str, ascending: bool, id_column: str) -> list[tuple[str, bool]]:
    """The columns to sort by, and whether they ascend; ties go by id."""
    key, tie = column_name(df.schema, sort_by), column_name(df.schema, id_column)
    return [(key, ascending)] + ([(tie, True)] if tie != key else [])


def sorted_by(keys: list[tuple[str, bool]]) -> list[Column]:
    """The keys as a sort order, nulls last in both directions."""
    columns = [(F.col(backtick(name)), ascending) for name, ascending in keys]
    return [c.asc_nulls_last() if ascending else c.desc_nulls_last() for c, ascending in columns]


def sortable(rows: DataFrame) -> list[Column]:
    """All columns as a sort order; maps, which have none, by their JSON."""
    return [
        F.to_json(F.struct(backtick(f.name))) if "map<" in f.dataType.simpleString() else F.col(backtick(f.name))
        for f in rows.schema
    ]


def _placed(df: DataFrame, order: list[Column]) -> tuple[DataFrame, list[tuple[int, int, int]]]:
    """``df`` in ``order`` with each row's ``_place``, and per partition the rows before it
    and in it.

    Rows are range-partitioned and sorted in parallel and then written, because the
    sampled range bounds differ from run to run. The list has one entry for each range
    partition: it is bounded by their number, not by the data.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    table = store(ranged.withColumn("_place", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_place", _ROW_BITS).alias("part")
    starts, before = [], 0
    for number, size in sorted(table.groupBy(part).agg(F.count(F.lit(1))).collect()):
        starts.append((number, before, size))
        before += size
    return table, starts


def _begins(df: DataFrame, rows: list[tuple[int, object]], number: str) -> DataFrame:
    """Ranges and what comes before them, as literal rows of the plan."""
    values = ", ".join(f"({part}, {before})" for part, before in rows or [(0, 0)])
    found = df.sparkSession.sql(f"SELECT CAST(a AS bigint) AS {number}, CAST(b AS bigint) AS _before FROM VALUES {values} AS t(a, b)")
    return found if rows else found.where(F.lit(False))


def rank_rows(df: DataFrame, order: list[Column], rank: str = "rank") -> DataFrame:
    """``df`` with the 1-based position of each row in ``order``: its place in its range
    partition plus the rows in the partitions before."""
    table, starts = _placed(df, order)
    begins = _begins(df, [(number, before) for number, before, _ in starts], "_part")
    in_part = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        table.withColumn("_part", F.shiftright("_place", _ROW_BITS))
        .join(F.broadcast(begins), "_part")
        .withColumn(rank, F.col("_before") + in_part + 1)
        .drop("_part", "_place", "_before")
    )


def running_sum(df: DataFrame, order: list[Column], amount: Column, total: str) -> DataFrame:
    """``df`` with the sum of ``amount`` over the rows up to each in ``order``: the sum in its range
    partition plus those of the partitions before."""
    table, _ = _placed(df, order)
    table = table.withColumn("_range", F.shiftright("_place", _ROW_BITS))
    begins, before = [], 0
    for number, held in sorted(table.groupBy("_range").agg(F.sum(amount)).collect()):
        begins.append((number, before))
        before += held
    begins = _begins(df, begins, "_range")
    along = Window.partitionBy("_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    summed = table.withColumn(total, F.sum(amount).over(along)).join(F.broadcast(begins), "_range")
    return summed.withColumn(total, F.col("_before") + F.col(total)).drop("_range", "_place", "_before")


def _before(df: DataFrame, keys: list[tuple[str, bool]], bound: tuple) -> Column:
    """Whether a row comes before ``bound``, which has a text or null for each key."""
    found = F.lit(False)
    for (name, ascending), value in reversed(list(zip(keys, bound))):
        key, limit = F.col(backtick(name)), F.lit(value).cast(df.schema[name].dataType)
        if value is None:
            found = key.isNotNull() | found
        else:
            less = key < limit if ascending else key > limit
            found = F.coalesce(less, F.lit(False)) | (key.eqNullSafe(limit) & found)
    return found


def _first_key(df: DataFrame, keys: list[tuple[str, bool]], low: tuple | None, high: tuple | None) -> list[Column]:
    """What a range says of its first key alone; scans skip data by it."""
    (name, ascending), found = keys[0], []
    key, kind = F.col(backtick(name)), df.schema[name].dataType
    if high and high[0] is not None:
        limit = F.lit(high[0]).cast(kind)
        found.append(key <= limit if ascending else key >= limit)
    if low and low[0] is not None:
        limit = F.lit(low[0]).cast(kind)
        found.append(key.isNull() | (key >= limit if ascending else key <= limit))
    return found


def _narrowed(df: DataFrame, keys: list[tuple[str, bool]], offset: int, limit: int) -> tuple[DataFrame, int] | None:
    """A range of ``df`` that holds the page, and the page's offset there; None if the rows
    can't be told apart by bounds.

    The bounds come from the rows with the least hashes, a sample of bounded size. How many rows
    precede each is counted in one aggregate, so any bounds give the right page.
    """
    names = [backtick(name) for name, _ in keys]
    if any(isinstance(df.schema[name].dataType, (ArrayType, StructType)) for name, _ in keys):
        return None
    sample = df.select(*names).orderBy(F.xxhash64(*names)).limit(SAMPLE).orderBy(*sorted_by(keys))
    sample = sample.select(*(F.col(n).cast("string") for n in names)).collect()
    bounds = list(dict.fromkeys(tuple(row) for row in sample[:: max(1, len(sample) // BOUNDS)]))
    befores = [F.count(F.when(_before(df, keys, bound), 1)) for bound in bounds]
    rows, *counts = df.agg(F.count(F.lit(1)), *befores).first()
    if offset >= rows:
        return df.where(F.lit(False)), 0
    counted = list(zip(counts, bounds))
    first, low = max(((n, b) for n, b in counted if n <= offset), key=lambda x: x[0], default=(0, None))
    end, high = min(((n, b) for n, b in counted if n >= offset + limit), key=lambda x: x[0], default=(rows, None))
    if 4 * (end - first) > 3 * rows:
        return None
    inside = _first_key(df, keys, low, high)
    inside += [~_before(df, keys, low)] if low else []
    inside += [_before(df, keys, high)] if high else []
    for condition in inside:
        df = df.where(condition)
    return df, offset - first


def cut_page(df: DataFrame, keys: list[tuple[str, bool]], offset: int, limit: int) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of ``df`` in the order of ``keys``.

    Callers pass ``df`` narrowed to what the page and the order need. A deep page is looked for
    between counted bounds until it lies near the start of a range: each step reads the keys
    and moves no row. Only where most rows have the same keys are rows ranked.
    """
    order = sorted_by(keys)
    while offset > TOP_ROWS:
        found = _narrowed(df, keys, offset, limit)
        if not found:
            return _cut_ranked(df, order, offset, limit)
        df, offset = found
    return df.orderBy(*order).offset(offset).limit(limit)


def _cut_ranked(df: DataFrame, order: list[Column], offset: int, limit: int) -> DataFrame:
    """As ``cut_page``, by a range of places, so of the ranked rows only the row groups that hold it are read."""
    table, starts = _placed(df, order)
    wanted = F.lit(False)
    for number, before, size in starts:
        first, last = max(offset, before), min(offset + limit, before + size)
        if first < last:
            base = (number << _ROW_BITS) - before
            wanted |= F.col("_place").between(base + first, base + last - 1)
    return table.where(wanted).orderBy("_place").limit(limit).drop("_place")
