"""Byte-exact removal of long repeats by prefix-free parsing.

A rolling hash picks a *trigger* for every position: the least hash among the next ``REACH``
positions, which depends on the bytes there alone. Positions with one trigger form a *phrase*; equal
strings of ``LENGTH`` bytes have the same trigger at the same offset, wherever they stand, so
repeats can only meet inside one entry of the dictionary, named by the ``KEY`` bytes after the trigger.

The dictionary is counted first. Entries that occur once are done, which is nearly all of plain
text. Phrases of the others are named by all bytes their strings reach (the phrase and the parse after it): a
name that occurs twice settles all of its positions at once, however many copies there are.
Only where an entry has several names, its distinct phrases are brought together and their
strings compared position by position.

Strings are named by fingerprints where the method as published sorts them: only equality counts
here, and a name is counted in parts while a sorted run of a passage that a third of all rows
share would have to lie in one task.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import text as T
from shelfmark.session import store

#: Bytes of a repeat.
LENGTH = 400
#: Positions looked at for a trigger (a power of two), bytes of a rolling hash and of an entry's
#: name. REACH + KEY may not be more than LENGTH.
REACH, ROLL, KEY = 128, 8, 256
#: Distinct phrases of an entry that one task compares; the strings of larger entries are counted
#: one by one, by a shuffle of their fingerprints.
TOGETHER = 4096


def _triggers(data: np.ndarray) -> np.ndarray:
    """For each position the place of the least rolling hash among those from it on."""
    padded = np.concatenate([data, np.zeros(ROLL + REACH, np.uint8)])
    windows = np.ndarray((len(data) + REACH,), "<u8", padded.tobytes(), strides=(1,))
    values = (T.mixed(windows.astype(np.uint64)) >> np.uint64(32)) << np.uint64(32)
    values |= np.arange(len(values), dtype=np.uint64)
    step = 1
    while step < REACH:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    return (values[: len(data)] & np.uint64(0xFFFFFFFF)).astype(np.int64)


def phrases(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Of each phrase: its row, first and last position, dictionary entry and full name."""
    last = np.repeat(bounds[1:] - length, np.diff(bounds))
    at = np.flatnonzero(np.arange(len(data)) <= last)
    if not len(at):
        return (np.zeros(0, np.int64),) * 5
    trigger = _triggers(data)[at]
    row = np.searchsorted(bounds, at, "right") - 1
    new = np.concatenate([[True], (trigger[1:] != trigger[:-1]) | (row[1:] != row[:-1])])
    first = np.flatnonzero(new)
    final = np.concatenate([first[1:], [len(at)]]) - 1
    hashes = T.Hashes(data)
    entry = hashes.of(trigger[first], trigger[first] + KEY)
    name = hashes.of(at[first], at[final] + length)
    row = row[first]
    return row, at[first] - bounds[row], at[final] - bounds[row], entry.view(np.int64), name.view(np.int64)


def _entries(length: int, batches):
    for _, data, bounds in T.texts(batches, "text"):
        yield pa.RecordBatch.from_arrays([pa.array(phrases(data, bounds, length)[3])], ["entry"])


def _phrases(length: int, batches):
    for rows, data, bounds in T.texts(batches, "text"):
        row, first, last, entry, name = phrases(data, bounds, length)
        yield pa.RecordBatch.from_arrays(
            [pa.array(entry), pa.array(name), rows["key"].take(pa.array(row)), pa.array(first), pa.array(last)],
            ["entry", "name", "key", "first", "last"],
        )


def _contents(length: int, batches):
    """The bytes of the phrases listed with each text."""
    for batch in batches:
        for rows, data, bounds in T.pieces(batch, "text"):
            lists = rows["wanted"]
            owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            each = lists.flatten()
            first, last = each.field("first").to_numpy(), each.field("last").to_numpy()
            starts, ends = first + bounds[owner], last + length + bounds[owner]
            whole = data.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    each.field("entry"), rows["key"].take(pa.array(owner)), each.field("first"), each.field("settled"),
                    pa.array([whole[a:z] for a, z in zip(starts.tolist(), ends.tolist())], pa.binary()),
                ],
                ["entry", "key", "first", "settled", "bytes"],
            )


def _strings(contents: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every string in every phrase: the phrase, the offset in it and the fingerprint."""
    sizes = np.array([len(x) for x in contents])
    data = np.frombuffer(b"".join(contents), np.uint8)
    begin = np.cumsum(sizes) - sizes
    counts = sizes - length + 1
    owner = np.repeat(np.arange(len(contents)), counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = begin[owner] + offset
    return owner, offset, T.Hashes(data).of(starts, starts + length)


def _runs(keys: list, firsts: list, owner: np.ndarray, offset: np.ndarray) -> pa.RecordBatch:
    """Runs of neighbouring positions of one phrase."""
    new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1)])[: len(owner)]
    starts = np.flatnonzero(new)
    ends = np.concatenate([starts[1:], [len(owner)]])[: len(starts)] - 1
    base = np.array(firsts, np.int64)[owner[starts]]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([keys[i] for i in owner[starts].tolist()], pa.binary()),
            pa.array(base + offset[starts]),
            pa.array(base + offset[ends]),
        ],
        ["key", "first", "last"],
    )


def _compared(length: int, batches):
    """Positions whose string occurs in another phrase of the entry; phrases come by entry."""
    held: list[tuple] = []

    def found(group: list[tuple]):
        entries = np.array([x[0] for x in group], np.int64)
        owner, offset, names = _strings([x[4] for x in group], length)
        keys = T.mixed(names ^ T.mixed(entries.view(np.uint64))[owner])
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        often = np.zeros(len(keys), bool)
        often[order[1:][same]] = True
        often[order[:-1][same]] = True
        often &= ~np.array([x[3] for x in group])[owner]
        return _runs([x[1] for x in group], [x[2] for x in group], owner[often], offset[often])

    for batch in batches:
        for row in zip(*(batch[c].to_pylist() for c in ("entry", "key", "first", "settled", "bytes"))):
            if len(held) >= 1024 and held[-1][0] != row[0]:
                yield found(held)
                held = []
            held.append(row)
    if held:
        yield found(held)


def _exploded(length: int, batches):
    """One row for each string of large entries."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            owner, offset, names = _strings(part["bytes"].to_pylist(), length)
            owner = pa.array(owner)
            place = pa.array(offset + part["first"].to_numpy()[owner.to_numpy()])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names.view(np.int64)), part["key"].take(owner), place, part["settled"].take(owner)],
                ["name", "key", "first", "settled"],
            )


def _cleaned(length: int, batches):
    """What is removed from each text and what is left of it."""
    for batch in batches:
        for rows, data, bounds in T.pieces(batch, "text"):
            removed, spans, digests, kept = [], [], [], []
            for i, runs in enumerate(rows["runs"].to_pylist()):
                own = data[bounds[i] : bounds[i + 1]]
                cover = np.zeros(len(own) + 1, np.int64)
                np.add.at(cover, [r["first"] for r in runs], 1)
                np.add.at(cover, [r["last"] + length for r in runs], -1)
                gone = np.cumsum(cover)[:-1] > 0
                left = own[~gone].tobytes()
                removed.append(int(gone.sum()))
                starts, ends, _ = T.spans(gone, np.array([0, len(own)]))
                spans.append([{"start": a, "end": z} for a, z in zip(starts.tolist(), ends.tolist())])
                digests.append(hashlib.sha256(left).hexdigest())
                kept.append(left)
            yield pa.RecordBatch.from_arrays(
                [
                    rows["key"], pa.array(removed, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array(digests, pa.string()), pa.array(kept, pa.binary()),
                ],
                ["key", "n_removed", "spans", "kept_sha256", "kept"],
            )


def repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, whole: bool = False
) -> DataFrame:
    """One row for each row of ``docs``: its id, ``n_bytes``, ``n_removed``, ``spans`` (removed runs of bytes),
    ``kept_sha256`` and ``kept``, the bytes left; null where nothing is removed, or with ``whole`` all of them.

    A byte is removed if a string of ``length`` bytes over it also starts anywhere else, in any
    text, its own included. All is judged on the input.

    * A null text is empty; a text under ``length`` bytes loses nothing. Bytes left over may be
      half a character.
    * Repeated rows are repeats of each other: texts of ``length`` bytes or more that occur
      twice lose everything. Ids may be null or repeated, as rows are told apart by their text.
    * Other columns of ``docs`` are not looked at. An empty table gives an empty result.
    """
    if REACH + KEY > length:
        raise ValueError(f"a repeat has {REACH + KEY} bytes at least")
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    key = F.unhex(F.md5(value))
    texts = docs.select(key.alias("key"), value.alias("text")).where(F.octet_length("text") >= length)

    counted = texts.select("text").mapInArrow(partial(_entries, length), "entry long").groupBy("entry").agg(F.count("*").alias("n"))
    # Written, and merged at every size: a table that is an exchange's whole side has its large keys split, and what
    # is moved grows as the input does.
    often = store(counted.where("n > 1").select("entry"), "often").hint("merge")
    parsed = texts.mapInArrow(partial(_phrases, length), "entry long, name long, key binary, first long, last long")
    found = store(parsed.join(often, "entry"), "phrases")
    place = F.struct("key", "first", "last")
    names = found.groupBy("entry", "name").agg(F.count("*").alias("n"), F.min(place).alias("place"))
    names = store(names, "names")
    repeated = found.join(names.where("n > 1").select("entry", "name"), ["entry", "name"]).select("key", "first", "last").distinct()

    # Written, so that both sides of the joins below are plain exchanges, whose large keys are split.
    entries = store(names.groupBy("entry").agg(F.count("*").alias("names")).where("names > 1"), "entries")
    pool = names.join(entries, "entry").select(
        "place.key", F.struct("entry", "place.first", "place.last", (F.col("n") > 1).alias("settled"), "names").alias("each")
    )
    wanted = pool.groupBy("key").agg(F.collect_list("each").alias("wanted"))
    touched = store(found.select("key").distinct(), "touched")
    one = texts.join(touched.hint("merge"), "key").groupBy("key").agg(F.first("text").alias("text"))
    one = store(one, "texts")

    schema = "entry long, key binary, first long, settled boolean, bytes binary"
    contents = wanted.join(one, "key").mapInArrow(partial(_contents, length), schema)
    contents = store(contents.join(entries, "entry"), "contents")
    near = contents.where(F.col("names") <= TOGETHER).drop("names")
    near = near.repartition("entry").sortWithinPartitions("entry").mapInArrow(
        partial(_compared, length), "key binary, first long, last long"
    )
    far = contents.where(F.col("names") > TOGETHER).drop("names")
    far = far.mapInArrow(partial(_exploded, length), "name long, key binary, first long, settled boolean")
    twice = far.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name")
    far = far.where("not settled").join(twice, "name").select("key", "first", F.col("first").alias("last"))

    runs = repeated.unionByName(near).unionByName(far).groupBy("key").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    span = "array<struct<start:long,end:long>>"
    cleaned = runs.join(one, "key").mapInArrow(
        partial(_cleaned, length), f"key binary, n_removed long, spans {span}, kept_sha256 string, kept binary"
    )
    rows = docs.select(
        F.col(id).alias("id"), key.alias("key"), F.octet_length(value).cast("long").alias("n_bytes"), F.sha2(value, 256).alias("sha"),
        (F.encode(value, "UTF-8") if whole else F.lit(None).cast("binary")).alias("all"),
    )
    return rows.join(cleaned.hint("merge"), "key", "left").select(
        F.col("id").alias(id), "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("spans", F.array().cast(span)).alias("spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
        F.coalesce("kept", "all").alias("kept"),
    )
