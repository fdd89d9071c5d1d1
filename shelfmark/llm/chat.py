"""Conversations as one text each, with token ids and a loss mask aligned by offsets.

A turn is written ``<turn>role<says>text</turn>``. The three marks are tokens of their own,
so the text of a turn always begins and ends with a token; inside roles and texts they are escaped.
The rendered text is encoded once, with offsets, and a binary search in the sorted spans of the
learnt turns finds the tokens that lie in one.
"""

from __future__ import annotations

import hashlib
import re
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, SAYS, CLOSE = "<turn>", "<says>", "</turn>"
LEARNT = ("assistant",)
#: Characters after which a longer conversation goes on in a further part, at the end of a turn.
PART_CHARACTERS = 1 << 20
#: Characters that are encoded at once, or one part with more.
ENCODED_CHARACTERS = 1 << 17

_ESCAPED = re.compile(r"\\|<(?=turn>|says>|/turn>)")
_TURN = re.compile(r"<turn>(.*?)<says>(.*?)</turn>", re.DOTALL)


def escape(text: str) -> str:
    """A backslash before each backslash and after the ``<`` of each mark."""
    return _ESCAPED.sub(lambda m: "\\\\" if m[0] == "\\" else "<\\", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def render(turns: list[tuple[str, str]], learnt=LEARNT) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the sorted spans of the learnt texts in it."""
    parts, spans, size = [], [], 0
    for role, text in turns:
        head, body = OPEN + escape(role) + SAYS, escape(text)
        if role in learnt:
            spans.append((size + len(head), size + len(head) + len(body)))
        parts.append(head + body + CLOSE)
        size += len(parts[-1])
    return "".join(parts), spans


def masked(offsets: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens (rows of start and end) lie in a span."""
    if not spans or not len(offsets):
        return np.zeros(len(offsets), bool)
    starts, ends = np.array(spans, np.int64).T
    at = np.searchsorted(starts, offsets[:, 0], "right") - 1
    return (at >= 0) & (offsets[:, 1] <= ends[at]) & (offsets[:, 1] > offsets[:, 0])


def load(tokenizer: str):
    """The tokenizer with the marks added; marks of its own in a text are ordinary text."""
    from tokenizers import AddedToken, Tokenizer, processors

    encoder = Tokenizer.from_str(tokenizer)
    encoder.add_tokens([AddedToken(mark, normalized=False) for mark in (OPEN, SAYS, CLOSE)])
    encoder.encode_special_tokens = True
    encoder.post_processor = processors.ByteLevel(trim_offsets=False)
    return encoder


def _parts(batches):
    """Conversation, number of the part and its turns; rows come by conversation and turn."""
    at, part, turns, size = None, 0, [], 0
    for batch in batches:
        for conversation, role, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "role", "text"))):
            if at is None or at[0] != conversation or size >= PART_CHARACTERS:
                if turns:
                    yield at[0], part, turns
                part = part + 1 if at is not None and at[0] == conversation else 0
                at, turns, size = (conversation,), [], 0
            turns.append((role, text))
            size += len(role) + len(text)
    if turns:
        yield at[0], part, turns


def _formatted(tokenizer: str, learnt: tuple, kind: pa.DataType, batches):
    encoder = load(tokenizer)

    def batch(group):
        rendered = [render(turns, learnt) for _, _, turns in group]
        encoded = encoder.encode_batch([text for text, _ in rendered], add_special_tokens=False)
        bounds = pa.array(np.cumsum([0, *map(len, encoded)]), pa.int32())
        offsets = np.empty((bounds[-1].as_py(), 2), np.int32)
        ids, loss = np.empty(len(offsets), np.int32), np.empty(len(offsets), bool)
        at = 0
        for (_, spans), tokens in zip(rendered, encoded):
            own = slice(at, at := at + len(tokens))
            ids[own] = tokens.ids
            offsets[own] = np.fromiter(chain.from_iterable(tokens.offsets), np.int32, 2 * len(tokens)).reshape(-1, 2)
            loss[own] = masked(offsets[own], spans)
        columns = (ids, offsets[:, 0].copy(), offsets[:, 1].copy(), loss)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([x[0] for x in group], kind),
                pa.array([x[1] for x in group], pa.int64()),
                pa.array([text for text, _ in rendered], pa.string()),
                *(pa.ListArray.from_arrays(bounds, pa.array(x)) for x in columns),
            ],
            ["conv_id", "part", "formatted", "ids", "starts", "ends", "loss"],
        )

    group, size = [], 0
    for part in _parts(batches):
        group.append(part)
        size += sum(len(role) + len(text) for role, text in part[2])
        if size >= ENCODED_CHARACTERS:
            yield batch(group)
            group, size = [], 0
    if group:
        yield batch(group)


def formatted(
    conversations: DataFrame,
    tokenizer: str,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learnt: tuple = LEARNT,
) -> DataFrame:
    """Each conversation in one row, or in several parts of a bounded length, numbered from 0 in one
    task and in order: ``conv_id``, ``part``, ``formatted``, token ``ids`` with ``starts`` and ``ends`` in characters, and
    ``loss``, whether a token is learnt. ``tokenizer`` is the JSON text of a byte-level tokenizer.

    * Turns stand in order of their number, null first; equal numbers by role and text.
    * A null role or text is empty; an empty text has no learnt token. Rows without a
      conversation are one conversation. Repeated rows are repeated turns.
    * Other columns are not looked at. An empty table gives an empty result.
    """
    rows = conversations.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))),
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(rows.schema["conv_id"].dataType)
    name = rows.schema["conv_id"].dataType.simpleString()
    ints = "array<int>"
    return rows.mapInArrow(
        partial(_formatted, tokenizer, tuple(learnt), kind),
        f"conv_id {name}, part long, formatted string, ids {ints}, starts {ints}, ends {ints}, loss array<boolean>",
    )


def _read_back(batch: pa.RecordBatch):
    """Each part of a batch with the runs of characters under its mask, from the buffers of a few rows at a time."""
    for at in range(0, batch.num_rows, 64):
        some = batch.slice(at, 64)
        bounds = some["loss"].offsets.to_numpy() - some["loss"].offsets[0].as_py()
        starts, ends, loss = (some[c].flatten().to_numpy(zero_copy_only=False) for c in ("starts", "ends", "loss"))
        for k in range(some.num_rows):
            own = slice(bounds[k], bounds[k + 1])
            kept = loss[own]
            first, last = starts[own][kept], np.maximum.accumulate(ends[own][kept])
            new = np.flatnonzero(np.concatenate([[True], first[1:] > last[:-1]])[: len(first)])
            runs = zip(first[new].tolist(), last[np.append(new[1:], len(first)) - 1].tolist()) if len(first) else ()
            yield some["conv_id"][k].as_py(), some["part"][k].as_py(), some["formatted"][k].as_py(), runs


def _digested(batches):
    """Digests of what is read back from formatted conversations, whose parts come in order."""
    at, state = None, None

    def row():
        turns, n, loss, characters, size = state
        return at[0], n, turns.hexdigest(), characters, loss.hexdigest(), size

    for batch in batches:
        done = []
        for conversation, part, text, runs in _read_back(batch):
            if part == 0:
                if at:
                    done.append(row())
                at, state = (conversation,), [hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
            for role, said in (m.groups() for m in _TURN.finditer(text)):
                state[0].update(f"{unescape(role)}\n{unescape(said)}\n".encode())
                state[1] += 1
            for a, z in runs:
                learnt = unescape(text[a:z])
                state[2].update(learnt.encode())
                state[3] += len(learnt)
            state[4] += len(text)
        if done:
            yield _rows(done, batch.schema.field("conv_id").type)
        kind = batch.schema.field("conv_id").type
    if at:
        yield _rows([row()], kind)


def _rows(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)


def digests(conversations: DataFrame) -> DataFrame:
    """One row for each conversation that ``formatted`` has written, from its text and mask alone."""
    kind = conversations.schema["conv_id"].dataType.simpleString()
    return conversations.select("conv_id", "part", "formatted", "starts", "ends", "loss").mapInArrow(
        _digested,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
