"""Line dedup by a log-template tree.

A line is parsed to a leaf of a tree of fixed depth: by its number of tokens, then by its leading
tokens, where a token with a digit is a variable field. In a leaf, a line joins the template that it
shares most tokens with, if they are enough, and the fields in which they differ become
variable; else it starts a new one. Lines of templates that occur in many different
documents are dropped.

Leaves that too few lines reach to recur are set aside by a count of fingerprints, so only the
lines of the others are shuffled with their tokens, each distinct one once.
"""

from __future__ import annotations

import hashlib
import re
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import text as T
from shelfmark.session import store

#: Leading tokens that name a leaf, and the share of equal tokens that joins a template.
DEPTH, SIMILAR = 3, 0.7
#: Documents that make a template recur. What stands in fewer is mostly what texts that are largely alike
#: share, and they would lose it all: at sf0.1 1,405 of 1,457 lines (three tokens and more) in two to nine texts.
LEAST_DOCUMENTS = 10
#: Leaves that are sent to every task; with more, their lines are joined by a shuffle.
SENT_LEAVES = 1_000_000
VARIABLE = b"<*>"
_DIGIT = re.compile(rb"[0-9]").search


def _hash(parts: list[bytes]) -> int:
    return int.from_bytes(hashlib.blake2b(b" ".join(parts), digest_size=8).digest(), "little", signed=True)


def parsed(line: bytes) -> tuple[int, int, list[bytes]] | None:
    """Leaf, fingerprint and tokens of a line; None if it has none. All tokens of a line of fewer than ``DEPTH`` name
    its leaf, so such lines are equal there; if all have a digit, none is a field."""
    tokens = line.split()
    if not tokens:
        return None
    if _DIGIT(line) and not (len(tokens) < DEPTH and all(map(_DIGIT, tokens))):
        tokens = [VARIABLE if _DIGIT(token) else token for token in tokens]
    return _hash([b"%d" % len(tokens), *tokens[:DEPTH]]), _hash(tokens), tokens


def _lines(full: bool, batches):
    """Distinct lines of each text, with their tokens or the text's key."""
    for batch in batches:
        for rows, data, bounds in T.pieces(batch, "text"):
            keys, found = rows["key"].to_pylist(), []
            for i, key in enumerate(keys):
                own: dict[int, tuple] = {}
                for line in data[bounds[i] : bounds[i + 1]].tobytes().split(b"\n"):
                    if got := parsed(line):
                        own[got[1]] = got
                found += [(leaf, line, b" ".join(tokens) if full else key) for leaf, line, tokens in own.values()]
            leaf, line, last = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaf, pa.int64()), pa.array(line, pa.int64()), pa.array(last, pa.binary())],
                ["leaf", "line", "tokens" if full else "key"],
            )


class Leaf:
    """The templates of one leaf, as rows of token fingerprints."""

    def __init__(self, tokens: int):
        self.rows, self.count = np.zeros((8, tokens), np.uint64), 0

    def put(self, line: np.ndarray) -> int:
        """The number of the template that the line joins or starts."""
        if self.count:
            same = (self.rows[: self.count] == line).sum(axis=1)
            best = int(same.argmax())
            if same[best] >= SIMILAR * len(line):
                self.rows[best][self.rows[best] != line] = 0  # variable from now on
                return best
        if self.count == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[self.count] = line
        self.count += 1
        return self.count - 1


def _placed(batches):
    """Lines come by leaf, the commonest first."""
    at, leaf = None, None
    for batch in batches:
        numbers = []
        for name, tokens in zip(batch["leaf"].to_pylist(), batch["tokens"].to_pylist()):
            data = np.frombuffer(tokens, np.uint8)
            starts, ends, _ = T.spans(data != 32, np.array([0, len(data)]))
            line = T.Hashes(data).of(starts, ends)
            if name != at:
                at, leaf = name, Leaf(len(line))
            if leaf.rows.shape[1] != len(line):  # two leaves of one fingerprint
                numbers.append(-1)
            else:
                numbers.append(leaf.put(line))
        yield pa.RecordBatch.from_arrays(
            [batch["leaf"], batch["line"], pa.array(numbers, pa.int64())], ["leaf", "line", "template"]
        )


def _without(batches):
    """Texts without their dropped lines."""
    for batch in batches:
        for rows, data, bounds in T.pieces(batch, "text"):
            kept, lines, dropped = [], [], []
            for i, drop in enumerate(rows["drop"].to_pylist()):
                own = data[bounds[i] : bounds[i + 1]].tobytes().split(b"\n")
                gone = set(drop or ())
                left = [x for x in own if not gone or not (got := parsed(x)) or got[1] not in gone]
                kept.append(b"\n".join(left).decode())
                lines.append(sum(1 for x in own if x.split()))
                dropped.append(len(own) - len(left))
            yield pa.RecordBatch.from_arrays(
                [rows["id"], pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())],
                ["id", "n_lines", "n_dropped", "kept"],
            )


def template_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST_DOCUMENTS) -> DataFrame:
    """One row for each row of ``docs``: its id, ``n_lines`` (with a word), ``n_dropped`` and ``kept``, the
    text without the lines of templates that occur in ``least`` or more different texts.

    * Lines end at ``\\n``; a line without a token stays. Lines of one or two tokens recur if all are equal, but for
      those with digits beside one without.
    * Copies of a text are one document, so copying alone makes no line recur.
    * A null text is empty. Ids may be null or repeated; rows are told apart by their text. Other
      columns are not looked at. An empty table gives an empty result.
    * Templates of a leaf form in falling order of how many texts hold a line, then by fingerprint,
      so every run gives the same.
    """
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    texts = docs.select(F.col(id).alias("id"), F.unhex(F.md5(value)).alias("key"), value.alias("text"))
    lines = texts.select("key", "text").mapInArrow(partial(_lines, False), "leaf long, line long, key binary")
    lines = store(lines.distinct(), "lines")
    leaves = lines.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("leaf")
    leaves = store(leaves, "leaves")
    wanted = F.broadcast(leaves) if leaves.count() <= SENT_LEAVES else leaves
    tokens = texts.select("key", "text").mapInArrow(partial(_lines, True), "leaf long, line long, tokens binary")
    tokens = tokens.join(wanted, "leaf").groupBy("leaf", "line").agg(F.min("tokens").alias("tokens"))
    held = lines.join(leaves, "leaf")
    often = held.groupBy("leaf", "line").agg(F.count("*").alias("n"))
    ordered = tokens.join(often, ["leaf", "line"]).repartition("leaf").sortWithinPartitions("leaf", F.desc("n"), "line")
    placed = store(ordered.mapInArrow(_placed, "leaf long, line long, template long"), "templates")
    of_text = held.join(placed.where("template >= 0"), ["leaf", "line"])
    recurring = of_text.select("leaf", "template", "key").distinct().groupBy("leaf", "template").agg(F.count("*").alias("n"))
    recurring = recurring.where(F.col("n") >= least).select("leaf", "template")
    drop = of_text.join(recurring, ["leaf", "template"]).groupBy("key").agg(F.collect_set("line").alias("drop"))
    kind = dict(texts.dtypes)["id"]
    cleaned = texts.join(drop, "key", "left").select("id", "text", "drop")
    cleaned = cleaned.mapInArrow(_without, f"id {kind}, n_lines long, n_dropped long, kept string")
    return cleaned.withColumnRenamed("id", id)
