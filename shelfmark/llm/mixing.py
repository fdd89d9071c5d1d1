"""Mixing sources to target weights along a training run, as a time-varying curriculum.

Sources share all words by weight, none takes more than a few times what it has, and what it can't
take goes to the others. Within a source, documents lie one after another on an
axis of words, in the order of their ids' digests and again from the start for every further pass.
A source's demand up to a moment of training is the integral of its weight schedule; inverting
it at a document's place on the axis gives the moment it is trained on. Sorting all
documents by that moment, across ranges, is the curriculum.

Only DataFrame functions are used. The running sum of a source never is one task's work: documents are
summed by slices of their digests first, and each slice goes on from the slices before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.operators.ranking import rank_rows
from shelfmark.session import store

#: Weights of the sources in code point order, repeated; the most passes over a source.
WEIGHTS, MOST = (5, 2, 1), 3
#: For each weight, the relative strength at moments from 0 to 1, joined by straight lines.
SCHEDULES = (
    ((0.0, 3.0), (0.5, 2.0), (1.0, 1.0)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 1.0), (0.5, 1.0), (1.0, 3.0)),
)
WORD = r"[^\x20\x09-\x0D]+"
#: Hexadecimal digits of a digest that name a slice; each source has up to 4096 of them.
_DIGITS = 3


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """``of``, ``source_size``, ``place`` (the schedule's number) and ``target``, one row a source;
    ``sizes`` has ``of``, ``source`` and ``source_size``.

    Sources over their limit are held at it and the others share again, until none is over. Each round
    is one aggregate of one row, and there are at most as many as sources.
    """
    ranked = rank_rows(sizes, [F.col("source").asc_nulls_last()], "place")
    place = ((F.col("place") - 1) % len(weights)).cast("int")
    ranked = store(
        ranked.select("of", "source_size", place.alias("place"), F.element_at(F.array(*map(F.lit, weights)), place + 1).cast("double").alias("weight")),
        "sources",
    )
    limit, level, before = F.lit(most) * F.col("source_size"), None, -1.0
    while level != before:
        over = F.lit(False) if level is None else F.col("weight") * F.lit(level) > limit
        held, free = F.sum(F.when(over, limit).otherwise(0)), F.sum(F.when(over, 0.0).otherwise(F.col("weight")))
        total, held, free = ranked.agg(F.sum("source_size"), held, free).first()
        before, level = level, ((total or 0) - (held or 0)) / free if free else level or 0.0
    target = F.least(F.col("weight") * F.lit(level), limit.cast("double"))
    return ranked.select("of", "source_size", "place", F.round(target, 6).alias("target"))


def integrated(schedules) -> list[list[dict[str, float]]]:
    """For each schedule its stretches between knots: where one begins, weight and slope of the demand there, and the
    shares of the whole demand that come before its begin and its end."""
    found = []
    for knots in schedules:
        areas = [(z[0] - a[0]) * (a[1] + z[1]) / 2 for a, z in zip(knots, knots[1:])]
        done, parts = 0.0, []
        for (t, w), (u, v), area in zip(knots, knots[1:], areas):
            slope = (v - w) / (u - t) / sum(areas) if u > t else 0.0
            parts.append({"t": t, "w": w / sum(areas), "slope": slope, "done": done, "to": done + area / sum(areas)})
            done = parts[-1]["to"]
        found.append(parts)
    return found


def _moment(share: Column, place: Column, schedules) -> Column:
    """The moment by which ``share`` of a source's demand has come."""
    rows = [F.array(*(F.struct(*(F.lit(float(x)).alias(k) for k, x in p.items())) for p in parts)) for parts in integrated(schedules)]
    parts = F.element_at(F.array(*rows), place % F.lit(len(rows)) + 1)
    part = F.coalesce(F.filter(parts, lambda p: p["to"] > share)[0], F.element_at(parts, -1))
    rest = F.greatest(share - part["done"], F.lit(0.0))
    root = part["w"] + F.sqrt(F.greatest(part["w"] * part["w"] + 2 * part["slope"] * rest, F.lit(0.0)))
    return part["t"] + F.when(root > 0, 2 * rest / root).otherwise(0.0)


def mix(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights=WEIGHTS,
    most: int = MOST,
    schedules=SCHEDULES,
    keep: list[str] | None = None,
    name: str = "mix",
) -> DataFrame:
    """The rows of ``docs`` (the columns in ``keep``, or all) with one further column, a struct of
    ``size``, ``source_size``, ``target`` and ``moments``: one number from 0 to 1 for each time that the
    document is taken.

    * A pass of a document is taken if its middle lies before the source's target, so a source ends
      within half a document of it; no document is taken more than ``most`` times.
    * A null text has size 0 and, as any text without words, adds none. Null sources are one source, the last.
    * Documents with the same digest order (repeated rows) stand in order of id and size; reruns agree.
    * An empty table gives an empty result. Columns of any name pass unchanged; one called ``name``
      is replaced.
    """
    kept = [c for c in (keep or docs.columns) if c != name]
    digest = F.md5(F.coalesce(F.col(id).cast("string"), F.lit("")))
    rows = docs.select(
        *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)),
        F.col(source).cast("string").alias("source"),
        F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")).alias("of"),
        F.col(id).alias("id"), digest.alias("digest"), F.substring(digest, 1, _DIGITS).alias("slice"),
        word_count(text).alias("size"),
    )
    if text not in kept:
        rows = store(rows, "sizes")  # the text is read once
    slices = store(rows.groupBy("of", "source", "slice").agg(F.sum("size").alias("held")), "slices")
    sizes = slices.groupBy("of", "source").agg(F.sum("held").alias("source_size"))
    shares = targets(sizes, weights, most)
    before = F.sum("held").over(Window.partitionBy("of").orderBy("slice")) - F.col("held")
    begins = slices.select("of", "slice", before.alias("before")).join(shares, "of")

    inside = Window.partitionBy("of", "slice").orderBy("digest", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.join(begins, ["of", "slice"]).withColumn("start", F.col("before") + F.sum("size").over(inside) - F.col("size"))
    middle = lambda n: F.col("start") + n * F.col("source_size") + F.col("size") / 2
    passes = F.filter(F.sequence(F.lit(0), F.lit(most - 1)), lambda n: middle(n) < F.col("target"))
    moments = F.transform(passes, lambda n: _moment(middle(n) / F.col("target"), F.col("place"), schedules))
    # Apart from the renaming, where a name in a lambda would mean the renamed column.
    mixed = placed.withColumn("mixed", F.struct("size", "source_size", "target", moments.alias("moments")))
    return mixed.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(kept)), F.col("mixed").alias(name))


def curriculum(docs: DataFrame, id: str = "doc_id", **options) -> DataFrame:
    """``docs`` as it is trained on: a row for each time a document is taken, sorted by moment
    across partitions. See ``mix``; the columns are those of ``docs``."""
    name = "mix"
    while name in docs.columns:
        name += "_"
    mixed = mix(docs, id=id, name=name, **options)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    taken = mixed.select(row.alias("row"), F.explode(f"{name}.moments").alias("moment"))
    return taken.orderBy("moment", F.col("row")[id]).select("row.*")


def positions(mixed: DataFrame, id: str = "doc_id", name: str = "mix") -> DataFrame:
    """The rows of ``mix``, each with the ``positions`` at which it is trained on, from 1 and in order; none for
    a row that isn't taken. Repeated rows and rows without ids are rows each; an empty table gives an empty result.

    All takings are range-sorted by moment, ties by id, and a position is a place in that order: that in its range
    and the rows of the ranges before. Takings of a row come together again by a number of the row.
    """
    mixed = store(mixed, "mix")  # so that a task that is run again numbers the same rows alike
    own, moments = mixed.columns, F.col(f"`{name}`.moments")
    row = F.struct(*(F.col(f"`{c}`") for c in own)).alias("row")
    numbered = mixed.select(row, moments.alias("moments")).withColumn("number", F.monotonically_increasing_id())
    taken = numbered.select("row", "number", F.explode_outer("moments").alias("moment"))
    order = [F.col("moment").asc_nulls_last(), F.col(f"row.`{id}`").asc_nulls_last()]
    ranked = rank_rows(taken, order, "position")
    at = F.sort_array(F.collect_list(F.when(F.col("moment").isNotNull(), F.col("position"))))
    found = ranked.groupBy("number").agg(F.first("row").alias("row"), at.alias("positions"))
    return found.select("row.*", "positions")
