"""Quality rules: plain limits first, then robust multivariate outliers.

Every text becomes a few counts, and the counts a vector of transformed shares. For each
language and source the minimum-covariance-determinant estimate gives a centre and a
covariance that up to a quarter of bad rows cannot move; a row whose Mahalanobis distance from
them is improbable is rejected.

The estimate is the least determinant that concentration steps reach from several starts: the coordinates'
medians, two correlations that far rows can't bend (of hyperbolic tangents and of spatial signs), and small subsets by
hash. All starts go two steps, the best two of a pool go on until their determinant falls no more, the lesser one counts.
The determinant is that of the covariance with the least spreads added, which keeps it above nothing where most rows are
equal in a coordinate; a step never raises it.

A step sums counts, vectors and products by pool, start and bin of the distance, which combines before
the shuffle. The bins nearest to the centre that hold the wanted share of the pool count, the last one in
proportion. So a step is one aggregation over narrow rows for pools of any size, no pool meets in a task,
and as vectors are whole multiples of 1/65536 and sums exact, every run gives the same verdicts.
"""

from __future__ import annotations

import math
from fractions import Fraction
from functools import partial
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm import text as T
from shelfmark.session import store

LEAST_WORDS, MOST_REPEATED = 20, 30
#: Words of a window that counts as repeated.
WINDOW = 8
#: Groups of fewer rows are pooled by language, and such pools with each other.
LEAST_GROUP = 60
#: Share of a group that the estimate rests on.
SHARE = 0.75
#: Starts from subsets, rows of one in expectation, steps that all starts take and starts that go on.
SUBSETS, SUBSET_ROWS, FIRST_STEPS, BEST = 4, 4 * 7, 2, 2
#: Fall of a determinant's logarithm under which a start has converged, and bins to an octave of the distance.
FALL, BINS = 1e-4, 64
#: How improbable the distance of a rejected row is for a sound one.
IMPROBABLE = 1e-6
#: Coordinates and the least spread each is taken to have.
COORDINATES = {"symbols": 0.1, "word_length": 0.06, "marks": 0.1, "capitals": 0.08, "lines": 0.15, "windows": 0.15}
NAMES = tuple(COORDINATES)
SIZE = len(NAMES)
UNIT = 65536
_PAIRS = [(i, j) for i in range(SIZE) for j in range(i + 1)]


def _held(characters: str) -> np.ndarray:
    return np.isin(np.arange(256), [ord(c) for c in characters])


_SYMBOLS, _MARKS = _held("#*$%&|<>"), _held(".,;:!?")
_CAPITALS = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_FIRST = (np.arange(256) & 0xC0) != 0x80


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _earlier(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values occur before in the array, and which occur twice or more."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys), bool)
    same[1:] = keys[order][1:] == keys[order][:-1]
    before, often = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    before[order] = same
    same[:-1] |= same[1:]
    often[order] = same
    return before, often


def _of_row(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    return T.mixed(hashes ^ (owner.astype(np.uint64) * np.uint64(0x9E6C63D0876A9A47)))


def counts(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each text."""
    plain = T.PLAIN[data]
    starts, ends, first = T.spans(plain, bounds)
    hashes = T.Hashes(data)
    n_words = np.diff(first)
    owner = np.repeat(np.arange(len(n_words)), n_words)
    windows = T.grams(hashes.of(starts, ends), WINDOW)
    held = owner[: len(windows)] == owner[len(owner) - len(windows) :]
    _, often = _earlier(_of_row(windows, owner[: len(windows)])[held])
    cover = np.zeros(len(starts) + WINDOW + 1, np.int64)
    at = np.flatnonzero(held)[often]
    np.add.at(cover, at, 1)
    np.add.at(cover, at + WINDOW, -1)
    repeated = np.cumsum(cover)[: len(starts)] > 0
    from_, to, lines = T.spans(data != 10, bounds)
    worded = np.searchsorted(starts, to) > np.searchsorted(starts, from_)
    line_owner = np.repeat(np.arange(len(n_words)), np.diff(lines))[worded]
    before, _ = _earlier(_of_row(hashes.of(from_[worded], to[worded]), line_owner))
    return {
        "n_words": n_words,
        "word_chars": _sums(plain & _FIRST[data], bounds),
        "n_symbols": _sums(_SYMBOLS[data], bounds),
        "n_dup_lines": np.bincount(line_owner[before], minlength=len(n_words)),
        "n_repeat_words": _sums(repeated, first),
        "n_lines": np.bincount(line_owner, minlength=len(n_words)),
        "n_marks": _sums(_MARKS[data], bounds),
        "n_capitals": _sums(_CAPITALS[data], bounds),
    }


def vectors(c: dict[str, np.ndarray]) -> np.ndarray:
    """The transformed statistics, in units of 1/65536."""
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    parts = (
        np.sqrt(c["n_symbols"] / words),
        np.log(chars / words),
        np.sqrt(c["n_marks"] / words),
        np.sqrt(c["n_capitals"] / chars),
        np.sqrt(c["n_dup_lines"] / np.maximum(c["n_lines"], 1)),
        np.sqrt(c["n_repeat_words"] / words),
    )
    return np.rint(np.stack(parts) * UNIT).astype(np.int64)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _measured(whole: bool, batches):
    for batch in batches:
        for rows, data, bounds in T.pieces(batch, "text"):
            c = counts(data, bounds)
            values = [pa.array(c[name], pa.int64()) for name in COUNTS]
            values += [pa.array(x, pa.int64()) for x in vectors(c)]
            names = [name for name in rows.schema.names if name != "text" or whole]
            kept = [rows[name] for name in names]
            yield pa.RecordBatch.from_arrays(kept + values, [*names, *COUNTS, *NAMES])


def chi_square_below(x: float, size: int) -> float:
    """Probability of a chi-square value under ``x``, for an even number of coordinates."""
    term = total = 1.0
    for i in range(1, size // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def chi_square_limit(share: float, size: int) -> float:
    """The value that ``share`` of chi-square values lie under."""
    z = NormalDist().inv_cdf(share)
    low, high = 0.0, 10 * size * max(1.0, 1 - 2 / (9 * size) + z * math.sqrt(2 / (9 * size))) ** 3
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_below(middle, size) < share else (low, middle)
    return high


#: A covariance of the nearest rows only is too small by this factor.
NARROW = SHARE / chi_square_below(chi_square_limit(SHARE, SIZE), SIZE + 2)
LIMIT = chi_square_limit(1 - IMPROBABLE, SIZE)


def _shape(covariance: np.ndarray) -> np.ndarray:
    """The triangle that turns a deviation into coordinates of unit spread."""
    floor = np.array(list(COORDINATES.values())) ** 2
    return np.linalg.inv(np.linalg.cholesky(covariance + np.diag(floor)))


_PARAMETERS = [f"m{i}" for i in range(SIZE)] + [f"l{i}{j}" for i, j in _PAIRS]
_SCHEMA = "pool string, start int, logdet double, done boolean, " + ", ".join(f"{name} double" for name in _PARAMETERS)
_FIELDS = ["pool", "start", "logdet", "done", *_PARAMETERS]
#: Scores are taken in units of 1/4096, so that sums of products are exact.
_SCORE = 4096


def _row(pool: str, start: int, centre: np.ndarray, covariance: np.ndarray, known: bool = True) -> list:
    shape = _shape(covariance)
    logdet = -2 * float(np.log(np.diag(shape)).sum()) if known else math.inf
    return [pool, start, logdet, False, *centre.tolist(), *(float(shape[i, j]) for i, j in _PAIRS)]


def _started(frames):
    """The starts of each pool from its medians, with correlations of scores that are bounded."""
    for frame in frames:
        found = []
        for row in frame.itertuples(index=False):
            spread = np.array([getattr(row, f"s{i}") for i in range(SIZE)], float) / UNIT * 1.4826
            centre = np.array([getattr(row, f"c{i}") for i in range(SIZE)], float) / UNIT
            found.append(_row(row.pool, 0, centre, np.diag(spread**2), known=False))
            for start, kind in enumerate(("t", "g"), start=1):
                products = np.zeros((SIZE, SIZE))
                for i, j in _PAIRS:
                    products[i, j] = products[j, i] = getattr(row, f"{kind}{i}{j}")
                sides = np.sqrt(np.maximum(np.diag(products), 1.0))
                alike = products / np.outer(sides, sides)
                np.fill_diagonal(alike, 1.0)
                found.append(_row(row.pool, start, centre, alike * np.outer(spread, spread), known=False))
        yield pd.DataFrame(found, columns=_FIELDS)


def _moments(n, sums: list, products: list) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance; whole numbers and fractions up to the last division."""
    covariance = np.zeros((SIZE, SIZE))
    for (i, j), product in zip(_PAIRS, products):
        covariance[i, j] = covariance[j, i] = float((n * product - sums[i] * sums[j]) / Fraction(n * n * UNIT * UNIT))
    return np.array([float(Fraction(x) / (n * UNIT)) for x in sums]), covariance


def _subset(frames):
    """A start from each subset's moments."""
    for frame in frames:
        found = []
        for row in frame.itertuples(index=False):
            values = [int(getattr(row, c)) for c in _SUMS]
            centre, covariance = _moments(int(row.n), values[:SIZE], values[SIZE:])
            found.append(_row(row.pool, row.start, centre, covariance, known=False))
        yield pd.DataFrame(found, columns=_FIELDS)


def _concentrated(frames):
    """Each start moved to the moments of its nearest rows, or done where this lowers the determinant no more."""
    for frame in frames:
        found = []
        for row in frame.itertuples(index=False):
            part = Fraction(int(row.wanted) - int(row.n_in), int(row.n_edge))
            values = [int(getattr(row, f"{c}_in")) + part * int(getattr(row, f"{c}_edge")) for c in _SUMS]
            centre, covariance = _moments(int(row.wanted), values[:SIZE], values[SIZE:])
            moved = _row(row.pool, row.start, centre, covariance * NARROW)
            moved[3] = moved[2] > row.logdet - FALL
            if moved[2] > row.logdet:
                moved = [row.pool, row.start, row.logdet, True, *(getattr(row, name) for name in _PARAMETERS)]
            found.append(moved)
        yield pd.DataFrame(found, columns=_FIELDS)


def _medians(rows: DataFrame, columns: list[str], scale: int) -> DataFrame:
    """Per pool the medians of whole-number columns, to ``scale``, from counts of each value."""
    each = F.explode(
        F.array(*(F.struct(F.lit(i).alias("i"), F.floor(F.col(c) / scale).alias("v")) for i, c in enumerate(columns)))
    )
    held = rows.select("pool", each.alias("e")).groupBy("pool", "e.i", "e.v").agg(F.count("*").alias("n"))
    along = Window.partitionBy("pool", "i")
    total, so_far = F.sum("n").over(along), F.sum("n").over(along.orderBy("v"))
    found = held.select("pool", "i", "v", (2 * so_far >= total).alias("over")).where("over")
    found = found.groupBy("pool", "i").agg((F.min("v") * scale + scale // 2).alias("v"))
    return found.groupBy("pool").agg(
        *(F.max(F.when(F.col("i") == i, F.col("v"))).alias(f"c{i}") for i in range(len(columns)))
    )


def _distance():
    """The squared distance, from a row's vector and the parameters joined to it."""
    off = [F.col(name) / UNIT - F.col(f"m{i}") for i, name in enumerate(NAMES)]
    total = F.lit(0.0)
    for i in range(SIZE):
        along = sum((F.col(f"l{i}{j}") * off[j] for j in range(i + 1)), F.lit(0.0))
        total = total + along * along
    return total


_SUMS = [f"s{i}" for i in range(SIZE)] + [f"p{i}{j}" for i, j in _PAIRS]


def _summed():
    """Exact sums of vectors and of products; the names are those of ``_SUMS``."""
    sums = [F.sum(F.col(name)).alias(f"s{i}") for i, name in enumerate(NAMES)]
    products = [(F.col(NAMES[i]) * F.col(NAMES[j])).cast("decimal(20,0)") for i, j in _PAIRS]
    return [*sums, *(F.sum(x).cast("decimal(38,0)").alias(f"p{i}{j}") for x, (i, j) in zip(products, _PAIRS))]


def _step(sound: DataFrame, starts: DataFrame) -> DataFrame:
    """One concentration step of each start."""
    binned = sound.join(starts, "pool").withColumn("bin", F.floor(F.log2(1 + _distance()) * BINS))
    binned = binned.groupBy("pool", "start", "bin").agg(F.count("*").alias("n"), *_summed())
    own = Window.partitionBy("pool", "start")
    upto = F.sum("n").over(own.orderBy("bin"))
    binned = binned.withColumn("upto", upto).withColumn("wanted", F.ceil(SHARE * F.sum("n").over(own)))
    near = binned.where(F.col("upto") - F.col("n") < F.col("wanted"))
    inside = F.col("upto") < F.col("wanted")
    parts = [
        F.coalesce(F.sum(F.when(here, F.col(c))), F.lit(0)).alias(f"{c}_{name}")
        for name, here in (("in", inside), ("edge", ~inside))
        for c in ("n", *_SUMS)
    ]
    near = near.groupBy("pool", "start").agg(F.max("wanted").alias("wanted"), *parts)
    return near.join(starts, ["pool", "start"]).mapInPandas(_concentrated, _SCHEMA)


def estimates(sound: DataFrame) -> DataFrame:
    """The estimate of each ``pool``: centre, triangle of the shape and logarithm of the determinant.

    ``sound`` has the pool of each row and its vector. Pools of any size share the same few jobs; after
    them only starts that still fall are worked on, and each fall is at least ``FALL``, so there is an end.
    """
    centres = _medians(sound, list(NAMES), 64)
    off = [F.abs(F.col(name) - F.col(f"c{i}")).alias(name) for i, name in enumerate(NAMES)]
    spreads = _medians(sound.join(centres, "pool").select("pool", *off), list(NAMES), 64)
    spreads = spreads.select("pool", *(F.col(f"c{i}").alias(f"s{i}") for i in range(SIZE)))
    middles = store(centres.join(spreads, "pool"), "medians")

    scores = [
        (F.col(name) - F.col(f"c{i}")) / F.greatest(F.col(f"s{i}") * 1.4826, F.lit(COORDINATES[name] * UNIT))
        for i, name in enumerate(NAMES)
    ]
    scored = sound.join(middles, "pool").select("pool", *(x.alias(f"z{i}") for i, x in enumerate(scores)))
    length = F.greatest(F.sqrt(sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(SIZE)), F.lit(0.0))), F.lit(1e-9))
    bent = [F.round(F.tanh(f"z{i}") * _SCORE).cast("long").alias(f"t{i}") for i in range(SIZE)]
    turned = [F.round(F.col(f"z{i}") / length * _SCORE).cast("long").alias(f"g{i}") for i in range(SIZE)]
    products = [F.sum(F.col(f"{k}{i}") * F.col(f"{k}{j}")).alias(f"{k}{i}{j}") for k in "tg" for i, j in _PAIRS]
    alike = scored.select("pool", *bent, *turned).groupBy("pool").agg(F.count("*").alias("size"), *products)
    alike = store(alike, "scores")
    named = middles.join(alike, "pool").mapInPandas(_started, _SCHEMA)

    every = F.greatest(F.floor(F.col("size") / SUBSET_ROWS), F.lit(SUBSETS))
    drawn = sound.join(alike.select("pool", "size"), "pool").withColumn("start", F.pmod(F.xxhash64(*NAMES), every))
    drawn = drawn.where(F.col("start") < SUBSETS).withColumn("start", (F.col("start") + 3).cast("int"))
    drawn = drawn.groupBy("pool", "start").agg(F.count("*").alias("n"), *_summed()).mapInPandas(_subset, _SCHEMA)

    state = store(named.unionByName(drawn), "estimate")
    for _ in range(FIRST_STEPS):
        state = store(_step(sound, state), "estimate")
    place = F.row_number().over(Window.partitionBy("pool").orderBy("logdet", "start"))
    state = store(state.withColumn("place", place).where(F.col("place") <= BEST).drop("place"), "estimate")
    while not (moving := state.where("not done")).isEmpty():
        state = store(state.where("done").unionByName(_step(sound, moving)), "estimate")
    least = F.min_by(F.struct("start", "logdet", *_PARAMETERS), F.struct("logdet", "start")).alias("e")
    return state.groupBy("pool").agg(least).select("pool", "e.*")


def _pools(rows: DataFrame) -> DataFrame:
    """For each language and source the pool it is estimated in."""
    groups = rows.groupBy("lang_key", "source_key").agg(F.count("*").alias("n"))
    alone = F.col("n") >= LEAST_GROUP
    left = F.sum(F.when(~alone, F.col("n")).otherwise(0)).over(Window.partitionBy("lang_key"))
    pool = (
        F.when(alone, F.to_json(F.array("lang_key", "source_key")))
        .when(left >= LEAST_GROUP, F.to_json(F.array("lang_key")))
        .otherwise("rest")
    )
    return groups.select("lang_key", "source_key", pool.alias("pool"))


def _key(column: str):
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def _rows(docs: DataFrame, keep: list[str], text: str, lang: str, source: str) -> DataFrame:
    """Counts and vector of each row, with the columns in ``keep`` as c0, c1 and so on."""
    whole = text in keep
    carried = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep) if c != text]
    rows = docs.select(*carried, F.col(text).cast("string").alias("text"), _key(lang).alias("lang_key"), _key(source).alias("source_key"))
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text" or whole]
    fields += [f"{name} long" for name in (*COUNTS, *NAMES)]
    rows = rows.mapInArrow(partial(_measured, whole), ", ".join(fields))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def quality(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    keep: list[str] | None = None,
    name: str = "quality",
) -> DataFrame:
    """The rows of ``docs`` (the columns in ``keep``, or all) with one further column, a struct of the counts,
    ``base_failed``, ``distance`` and ``kept``.

    * ``base_failed``: fewer than 20 words, or over 30 % of them in repeated windows of eight.
    * ``distance``: squared distance from the pool's estimate; null if the base failed, or if even the
      rest pool has fewer than ``LEAST_GROUP`` rows, where nothing more is asked. Smaller groups are pooled.
    * A text of any length is measured whole; a task holds one such text and its hashes at once.
    * A null or empty text has no words and fails. Null languages and sources are groups of
      their own. Equal rows get equal verdicts; an empty table gives an empty result.
    * Columns of any name pass unchanged; one called ``name`` is replaced.
    """
    keep = [c for c in (keep or docs.columns) if c != name]
    narrow = text not in keep
    rows = store(_rows(docs, keep if narrow else [], text, lang, source), "statistics")

    sound = rows.where("not base_failed").select("lang_key", "source_key", *NAMES)
    pools = _pools(sound)
    pools = store(pools, "pools")
    sound = sound.join(pools, ["lang_key", "source_key"]).select("pool", *NAMES)
    size = sound.groupBy("pool").agg(F.count("*").alias("size"))
    estimate = estimates(sound)

    judged = pools.join(estimate, "pool").join(size.where(F.col("size") >= LEAST_GROUP), "pool")
    if not narrow:  # texts are measured again, which costs less than to join them to their counts
        rows = _rows(docs, keep, text, lang, source)
    out = rows.join(judged, ["lang_key", "source_key"], "left")
    out = out.withColumn("distance", F.when(~F.col("base_failed"), _distance()))
    kept = ~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= LIMIT)
    result = F.struct(*COUNTS, "base_failed", kept.alias("kept"), "distance").alias(name)
    columns = [F.col("text" if c == text else f"c{i}").alias(c) for i, c in enumerate(keep)]
    return out.select(*columns, result)
