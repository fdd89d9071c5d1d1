"""Token counts of a unigram tokenizer, without making the tokens.

An Aho-Corasick automaton lists all pieces of the vocabulary in a word; dynamic programming over the
places where they end carries the best score and its number of pieces. Ties go as in the
tokenizer itself: of equally good ways to a place the one whose last piece starts first stays, and a
character that is no piece costs ten more than the worst piece and counts as its UTF-8 bytes.
A text is segmented whole, with its white space, or as its words alone; either way it is cut
where no piece of the vocabulary can cross, and each distinct stretch is segmented once per task.
"""

from __future__ import annotations

import re
from functools import partial

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import text as T

SPACE = "▁"
WHITE = " \t\n\v\f\r"
UNKNOWN_PENALTY = 10.0
#: Distinct stretches a task remembers; beyond, it forgets all and goes on.
REMEMBERED = 200_000


def unigram_vocabulary(path: str) -> list[tuple[str, float]]:
    """The ordinary pieces of a SentencePiece model file and their scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(len(model)) if not special(i)]


class Counter(dict):
    """Pieces of a word, given as UTF-8 bytes; remembers what it has counted."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {piece for piece, _ in vocabulary if len(piece) == 1}
        self.unknown = min((score for _, score in vocabulary), default=0.0) - UNKNOWN_PENALTY

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = count = self.count(SPACE + word.decode())
        return count

    def count(self, word: str) -> int:
        best, pieces = [0.0], [0]
        matches = self.automaton.iter(word) if len(self.automaton) else iter(())
        end, match = next(matches, (-1, None))
        for at, character in enumerate(word):
            top, count = None, 0
            while end == at:  # the longest, which starts first, comes first
                size, score = match
                score += best[at + 1 - size]
                if top is None or score > top:
                    top, count = score, pieces[at + 1 - size] + 1
                end, match = next(matches, (-1, None))
            if character not in self.single:
                score = best[at] + self.unknown
                if top is None or score > top:
                    top, count = score, pieces[at] + len(character.encode())
            best.append(top)
            pieces.append(count)
        return pieces[-1]


class Whole(Counter):
    """Pieces of whole texts, white space included, as a model with an identity normalizer sees them: one space
    mark before the text and one for each space, all other characters as they are."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        super().__init__(vocabulary)
        beside, led = set(), False
        for piece, _ in vocabulary:
            for x, y in zip(piece, piece[1:]):
                if x != y:
                    beside |= {x, y}
                    led = led or y == SPACE
        # White space that no piece has beside another character, and whether space marks can only lead.
        apart = [c for c in WHITE[1:] if c not in beside] + [" "] * (SPACE not in beside)
        alone = "|".join(f"{re.escape(c)}+" for c in apart)
        others = "[^" + "".join(map(re.escape, apart)) + "]" if apart else r"[\x00-\xff]"
        if not led and " " not in apart:
            stretch = " *[^" + "".join(map(re.escape, [" ", *apart])) + "]+| +"
        else:
            stretch = f"{others}+"
        self.stretches = re.compile("|".join(filter(None, [stretch, alone])).encode()).findall

    def __missing__(self, stretch: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[stretch] = count = self.count(stretch.decode().replace(" ", SPACE))
        return count

    def of(self, text: bytes) -> int:
        if not text:
            return 0
        return sum(map(self.__getitem__, self.stretches(b" " + text.replace(SPACE.encode(), b" "))))


def _counted(vocabulary: list[tuple[str, float]], whole: bool, batches):
    counter = (Whole if whole else Counter)(vocabulary)
    for batch in batches:
        for rows, data, bounds in T.pieces(batch, "text"):
            texts = [data[a:z].tobytes() for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            words = [x.split() for x in texts]
            counts = map(counter.of, texts) if whole else (sum(map(counter.__getitem__, x)) for x in words)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array([len(x) for x in words], pa.int64()),
                    pa.array(list(counts), pa.int64()),
                ],
                ["id", "n_words", "n_tokens"],
            )


def token_counts(
    docs: DataFrame, vocabulary: list[tuple[str, float]], id: str = "doc_id", text: str = "text", whole: bool = False
) -> DataFrame:
    """One row for each row of ``docs``: its id, ``n_words`` and ``n_tokens``.

    * A word is a run of characters other than ASCII white space.
    * With ``whole`` the tokens are those of the text as it stands: one space mark leads it, each space is one, and
      other white space is a character like any. Without, they are those of its words alone, each led by one space mark.
    * A null or empty text has no words and no tokens. Rows are independent of each other; an empty
      table gives an empty result. Other columns of ``docs`` are not looked at.
    """
    rows = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    kind = dict(rows.dtypes)["id"]
    counted = rows.mapInArrow(partial(_counted, vocabulary, whole), f"id {kind}, n_words long, n_tokens long")
    return counted.withColumnRenamed("id", id)
