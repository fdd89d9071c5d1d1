"""Words, word runs and their fingerprints, read from the buffers of Arrow batches.

A batch of texts is one array of UTF-8 bytes and the bounds of its rows, so finding words and
hashing them are a few numpy passes over all rows at once and no Python object is made for a
word. Every fingerprint has 64 bits and depends on the bytes alone: equal words, wherever they
stand, get equal ones in every task and every run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; one longer text is still taken whole.
CHUNK_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = np.random.Generator(np.random.PCG64(20250101)).integers(1, 1 << 63, 256, np.uint64) * np.uint64(
    2
) + np.uint64(1)


def word_bytes(pattern: str) -> np.ndarray:
    """For each byte value, whether a word may hold it; ``pattern`` is a character class whose
    characters over U+007F are all in or all out."""
    high = bool(re.fullmatch(pattern, "Ā"))
    return np.array([bool(re.fullmatch(pattern, chr(i))) if i < 128 else high for i in range(256)])


#: Characters other than white space.
PLAIN = word_bytes(r"[^\x20\x09-\x0D]")
#: Digits, lower-case letters and everything that is not ASCII.
LETTERS = word_bytes(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]")

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return _LOWER[data]


def rows(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the bounds of its rows; a null is an empty text."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("")
    array = array.cast(pa.large_string()).cast(pa.large_binary())
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, bounds, data = array.buffers()
    bounds = np.frombuffer(bounds, np.int64)[array.offset : array.offset + len(array) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def pieces(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows with at most ``limit`` bytes of text together, or one row with more."""
    data, bounds = rows(batch.column(batch.schema.get_field_index(text)))
    at, last = 0, len(bounds) - 1
    while at < last:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at), data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at]
        at = to


def spans(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values, which never cross a row, and for each bound
    of a row how many runs start before it."""
    if not len(inside):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(bounds), np.int64)
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    before[bounds[:-1][bounds[:-1] < len(inside)]] = False
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[bounds[1:] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


@lru_cache(1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    start = np.ones(1, np.uint64)
    with np.errstate(over="ignore"):
        return tuple(
            np.concatenate([start, np.multiply.accumulate(np.full(size, base, np.uint64))])
            for base in (_BASE, _INVERSE)
        )


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all of their bits."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


class Hashes:
    """Fingerprints of any stretch of ``data`` in constant time: a polynomial over random byte
    values modulo 2**64, kept as prefix sums and moved to its origin when asked."""

    def __init__(self, data: np.ndarray):
        size = 1 << max(CHUNK_BYTES.bit_length() - 1, int(len(data)).bit_length())
        powers, self._back = _powers(size)
        self._sums = np.empty(len(data) + 1, np.uint64)
        self._sums[0] = 0
        np.cumsum(_BYTES[data] * powers[: len(data)], out=self._sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self._sums[ends] - self._sums[starts]) * self._back[starts])


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints of all runs of ``n`` neighbours, rows not regarded."""
    total, weight = np.zeros(max(0, len(hashes) - n + 1), np.uint64), np.uint64(1)
    with np.errstate(over="ignore"):
        for i in range(n if len(total) else 0):
            total += hashes[i : i + len(total)] * weight
            weight = weight * _BASE
    return mixed(total)


def texts(batches, column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """``pieces`` of all batches of a task."""
    for batch in batches:
        yield from pieces(batch, column)


def reply(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch with further columns; those of the same name are replaced."""
    for name, values in columns.items():
        at = batch.schema.get_field_index(name)
        batch = batch.append_column(name, values) if at < 0 else batch.set_column(at, name, values)
    return batch
