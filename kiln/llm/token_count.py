"""Count-only Viterbi for unigram tokenizers.

An Aho-Corasick automaton enumerates the vocabulary pieces in a text; dynamic programming keeps, for each end, the
best score and the number of pieces, never the pieces. Ties go to the piece that starts first, as in the
tokenizer. A character with no piece of its own costs the least score less ten and counts as its bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "▁"
#: Counted words that a task keeps; the table starts anew beyond it.
MEMORY = 400_000
_UNKNOWN_PENALTY = 10.0


class UnigramCounter:
    """Piece counts under a unigram vocabulary of (piece, score) with byte fallback."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        self.scores = dict(vocabulary)
        self.automaton = ahocorasick.Automaton()
        for piece, score in self.scores.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {piece for piece in self.scores if len(piece) == 1}
        self.unknown = min(self.scores.values()) - _UNKNOWN_PENALTY
        inside = {c for piece in self.scores if len(piece) > 1 for c in piece}
        crossing = any(BLANK in piece.lstrip(BLANK) for piece in self.scores)
        # no piece goes from a word into the next blank, nor over a character of no longer piece
        if crossing:
            self.words = re.compile(r"[\s\S]+")
        elif "\n" in inside:
            self.words = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")
        else:
            self.words = re.compile(f"{BLANK}+[^{BLANK}\n]*|[^{BLANK}\n]+|\n")
        self.known: dict[str, int] = {}

    def viterbi(self, word: str) -> int:
        """Number of pieces on the best path through one word."""
        total = len(word)
        best: list[float | None] = [0.0] + [None] * total
        count = [0] * (total + 1)
        if self.single.issuperset(word):
            for end, (length, score) in self.automaton.iter(word):  # at one end the longest piece comes first
                start = end + 1 - length
                score += best[start]
                if best[end + 1] is None or score > best[end + 1]:
                    best[end + 1], count[end + 1] = score, count[start] + 1
            return count[total]
        ends: list[list[tuple[int, float]]] = [[] for _ in range(total)]
        for end, found in self.automaton.iter(word):
            ends[end].append(found)
        for end, found in enumerate(ends):
            for length, score in found:
                start = end + 1 - length
                score += best[start]
                if best[end + 1] is None or score > best[end + 1]:
                    best[end + 1], count[end + 1] = score, count[start] + 1
            if word[end] not in self.single:
                score = best[end] + self.unknown
                if best[end + 1] is None or score > best[end + 1]:
                    best[end + 1] = score
                    count[end + 1] = count[end] + len(word[end].encode("utf-8", "surrogatepass"))
        return count[total]

    def count(self, text: str | None) -> int:
        """Pieces of the whole text: blanks as pieces show them, and one before a text that starts with none."""
        if not text:
            return 0
        known, total = self.known, 0
        text = text.replace(" ", BLANK)
        for word in self.words.findall(text if text[0] == BLANK else BLANK + text):
            n = known.get(word)
            if n is None:
                if len(known) >= MEMORY:
                    known.clear()
                n = self.viterbi(word)
                if len(word) <= 64:
                    known[word] = n
            total += n
        return total


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Ordinary pieces and scores of a sentencepiece file."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(k), model.get_score(k)) for k in range(model.get_piece_size())
            if not (model.is_unknown(k) or model.is_control(k) or model.is_byte(k) or model.is_unused(k))]


@lru_cache(maxsize=2)
def counter(path: str) -> UnigramCounter:
    return UnigramCounter(vocabulary(path))


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_chars, n_tokens): one row per document of (doc_id, text), under the pieces and scores of ``path``.

    A null or empty text has 0 of both. Whole texts are counted whatever their length; repeated rows are counted
    one by one; other columns are ignored; an empty table gives no rows. Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).count
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([count(text.as_py()) for text in batch.column(1)], pa.int64())],
                names=["doc_id", "n_chars", "n_tokens"])

    return (docs.select(F.col("doc_id").cast("long"), "text", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n"))
            .mapInArrow(run, "doc_id long, n_chars long, n_tokens long"))
