"""Benchmark decontamination: test passages found through an FM-index of each training shard.

A shard is a stretch of a task's rows with a bounded number of bytes. Its words are numbered by
the vocabulary of the test items; a word outside it ends every match, so only runs
that can hold a whole window are indexed. All windows of all items are searched backwards at once,
their occurrences located and merged to spans of words to remove. Nothing is shuffled: what
a document holds is decided where it is read.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import text as T
from shelfmark.llm.fmindex import FMIndex

WINDOW = 10
#: Bytes of text in a shard; one longer text is a shard of its own.
SHARD_BYTES = 4 << 20
#: Bytes of test items that one pass over the documents searches for; more take more passes.
BLOCK_BYTES = 8 << 20

_RESULT = "struct<n_words:long,n_hit:long,items:array<string>,spans:array<struct<start:long,end:long>>>"


class Passages:
    """The distinct windows of test items, as rows of word numbers, and whose they are."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        batch = pa.record_batch({"text": pa.array([text for _, text in items], pa.string())})
        words = []
        for _, data, bounds in T.pieces(batch, "text"):
            data = T.lower_ascii(data)
            starts, ends, first = T.spans(T.LETTERS[data], bounds)
            hashes = T.Hashes(data).of(starts, ends)
            words += [hashes[a:z] for a, z in zip(first[:-1], first[1:])]
        self.vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *words]))
        found: dict[tuple, set[str | None]] = {}
        for (name, _), row in zip(items, words):
            numbers = (np.searchsorted(self.vocabulary, row) + 1).tolist()
            for at in range(max(len(numbers) > 0, len(numbers) - window + 1)):
                found.setdefault(tuple(numbers[at : at + window]), set()).add(name)
        self.names = [sorted(x for x in names if x is not None) for names in found.values()]
        self.lengths = np.array([len(x) for x in found], np.int64)
        self.rows = np.zeros((len(found), window), np.int64)
        for i, x in enumerate(found):
            self.rows[i, window - len(x) :] = x
        self.shortest = int(self.lengths.min(initial=window))

    def numbers(self, words: np.ndarray) -> np.ndarray:
        """The number of each word; 0 if no item has it."""
        if not len(self.vocabulary):
            return np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words, at + 1, 0)


def _matches(passages: Passages, numbers: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows that occur and the words they begin at; ``first`` bounds the texts."""
    starts, ends, _ = T.spans(numbers > 0, first)
    wide = ends - starts >= passages.shortest
    starts, ends = starts[wide], ends[wide]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = ends - starts + 1
    closes = np.cumsum(sizes) - 1
    places = np.arange(sizes.sum()) + np.repeat(starts - (closes - sizes + 1), sizes)
    closed = np.zeros(len(places), bool)
    closed[closes] = True
    symbols = np.where(closed, 0, numbers[np.minimum(places, len(numbers) - 1)])
    index = FMIndex(symbols, len(passages.vocabulary))
    windows, low, high = index.search(passages.rows, passages.lengths)
    each = high - low
    suffixes = np.arange(each.sum()) + np.repeat(low - (np.cumsum(each) - each), each)
    return np.repeat(windows, each), places[index.locate(suffixes)]


def _merged(passages: Passages, before: list, size: int, windows: np.ndarray, at: np.ndarray) -> dict:
    """The result of one text: what an earlier pass has found, and the matches."""
    cover = np.zeros(size + 1, np.int64)
    held = before or {"items": [], "spans": []}
    names = {name for i in np.unique(windows).tolist() for name in passages.names[i]}
    starts = np.concatenate([at, [s["start"] for s in held["spans"]]]).astype(np.int64)
    ends = np.concatenate([at + passages.lengths[windows], [s["end"] for s in held["spans"]]]).astype(np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, ends, -1)
    hit = np.cumsum(cover)[:size] > 0
    from_, to, _ = T.spans(hit, np.array([0, size]))
    return {
        "n_words": size,
        "n_hit": int(hit.sum()),
        "items": sorted(names.union(held["items"])),
        "spans": [{"start": a, "end": z} for a, z in zip(from_.tolist(), to.tolist())],
    }


def _searched(items: list, window: int, schema: pa.DataType, batches):
    passages = Passages(items, window)
    for batch in batches:
        for shard, _, bounds in T.pieces(batch, "text", SHARD_BYTES):
            numbers, counts = [], []
            for _, data, part in T.pieces(shard, "text"):
                data = T.lower_ascii(data)
                starts, ends, first = T.spans(T.LETTERS[data], part)
                numbers.append(passages.numbers(T.Hashes(data).of(starts, ends)))
                counts.append(np.diff(first))
            first = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
            windows, at = _matches(passages, np.concatenate(numbers), first)
            order = np.argsort(at, kind="stable")
            windows, at = windows[order], at[order]
            cut = np.searchsorted(at, first)
            before = shard["found"].to_pylist()
            found = [
                _merged(passages, before[i], int(first[i + 1] - first[i]), windows[cut[i] : cut[i + 1]], at[cut[i] : cut[i + 1]] - first[i])
                for i in range(len(before))
            ]
            yield T.reply(shard, {"found": pa.array(found, schema)})


def _arrow_type() -> pa.DataType:
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    return pa.struct(
        [("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(span))]
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    keep: list[str] | None = None,
    name: str = "contamination",
) -> DataFrame:
    """The rows of ``docs`` (the columns in ``keep``, or all) with one further column, a struct of
    ``n_words``, ``n_hit``, ``items`` (ids that occur, as sorted strings) and ``spans`` (merged, in words).

    * Words are runs of digits, lower-case letters and non-ASCII characters after A-Z is lowered.
    * An item with fewer words than a window is one window; without words, or null, it is none.
    * A null or empty text has no words and no hits. Items without an id are hit but not named.
    * Rows are independent: repeated rows get equal results, an empty table an empty one.
    * Columns of any name pass unchanged; one called ``name`` is replaced.
    """
    kept = [c for c in (keep or docs.columns) if c != name]
    numbered = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)), F.col(text).cast("string").alias("text"))
    numbered = numbered.withColumn("found", F.lit(None).cast(_RESULT))
    items = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).cast("string").alias("text"))
    items = items.where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-size // BLOCK_BYTES))
    for i in range(passes):
        block = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(passes)) == i)
        block = sorted(map(tuple, block.collect()), key=lambda x: (x[0] is not None, x[0], x[1]))
        numbered = numbered.mapInArrow(partial(_searched, block, window, _arrow_type()), numbered.schema)
    return numbered.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(kept)), F.col("found").alias(name))

