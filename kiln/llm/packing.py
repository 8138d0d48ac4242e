"""Packing by dot-product vector bin packing.

Examples are vectors (tokens, one segment, loss-bearing tokens). A sequence is filled with the waiting
example whose vector has the largest dot product with what the sequence has left; when none fits whole,
that example is cut to fill the rest. Every task packs the rows it reads, with a bounded pool of waiting
examples, so nothing is shuffled and a lost task is simply run again.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END_ID = 1
#: Fixed value: the split pattern of byte-level BPE files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Waiting examples in a task's pool.
POOL = 512


@lru_cache(maxsize=4)
def byte_bpe(path: str) -> tiktoken.Encoding:
    """A byte-level BPE file of the tokenizers library as a tiktoken encoding (same ids, about 5x faster)."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain}
    letters |= {chr(0x100 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))}
    special = {t["content"]: t["id"] for t in model["added_tokens"]}
    ranks = {bytes(letters[c] for c in piece): n for piece, n in model["model"]["vocab"].items() if piece not in special}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def token_ids(text: str | None, path: str) -> np.ndarray:
    """Ids of the whole text followed by the end id."""
    ids = byte_bpe(path).encode(text or "", allowed_special="all")
    ids.append(END_ID)
    return np.array(ids, dtype=np.uint32)


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold."""

    tokens: int = 2048
    segments: int = 128
    loss: int = 2048


class Packer:
    """Fills sequences one after another from a pool of examples (doc, ids, tail) with tail loss-bearing ids at the end.

    Yields pieces (doc, start, ids, doc_tokens, loss, sequence, offset).
    """

    def __init__(self, limits: Limits):
        self.limits, self.sequence = limits, 0
        self.pool: list[tuple] = []  # (doc, ids, start, loss-bearing tail)
        self.size = np.zeros(0)
        self.loss = np.zeros(0)

    def add(self, doc: object, ids: np.ndarray, tail: int) -> Iterator[tuple]:
        """Queue one example; its full-length heads become sequences of their own."""
        full, start = self.limits.tokens, 0
        while len(ids) - start >= full and self._loss(len(ids), start, full, tail) <= self.limits.loss:
            yield self._piece((doc, ids, start, tail), full, 0)
            self.sequence += 1
            start += full
        if start < len(ids):
            self._push((doc, ids, start, tail))

    @staticmethod
    def _loss(total: int, start: int, length: int, tail: int) -> int:
        return max(0, start + length - max(start, total - tail))

    def _push(self, example: tuple) -> None:
        _, ids, start, tail = example
        rest = len(ids) - start
        self.pool.append(example)
        self.size = np.append(self.size, rest)
        self.loss = np.append(self.loss, self._loss(len(ids), start, rest, tail))

    def _pop(self, k: int) -> tuple:
        """Remove example k; the last one takes its place."""
        example, last = self.pool[k], self.pool.pop()
        if k < len(self.pool):
            self.pool[k], self.size[k], self.loss[k] = last, self.size[-1], self.loss[-1]
        self.size, self.loss = self.size[:-1], self.loss[:-1]
        return example

    def _piece(self, example: tuple, length: int, offset: int) -> tuple:
        doc, ids, start, tail = example
        return (doc, start, ids[start: start + length], len(ids), self._loss(len(ids), start, length, tail),
                self.sequence, offset)

    def _fit(self, example: tuple, tokens: int, loss: int) -> int:
        """Longest head of an example within what is left."""
        _, ids, start, tail = example
        return min(tokens, len(ids) - start, max(0, len(ids) - tail - start) + loss)

    def fill(self, tokens: int) -> Iterator[tuple]:
        """One sequence of at most ``tokens`` tokens. One that another limit ends is cut back to a power of two."""
        top, offset, segments, loss = self.limits, 0, self.limits.segments, self.limits.loss
        placed: list[tuple] = []
        while self.pool and offset < tokens and segments:
            left = tokens - offset
            score = (left / top.tokens) * (self.size / top.tokens) + (segments / top.segments) / top.segments \
                + (loss / top.loss) * (self.loss / top.loss)
            whole = (self.size <= left) & (self.loss <= loss)
            if whole.any():
                example = self._pop(int(np.argmax(np.where(whole, score, -1))))
                length = len(example[1]) - example[2]
            else:
                k = int(np.argmax(score))
                length = self._fit(self.pool[k], left, loss)
                if length <= 0:
                    break
                example = self._pop(k)
                doc, ids, start, tail = example
                self._push((doc, ids, start + length, tail))
            piece = self._piece(example, length, offset)
            placed.append((example, piece))
            offset, segments, loss = offset + length, segments - 1, loss - piece[4]
        if offset < tokens and offset & (offset - 1):
            end = 1 << (offset.bit_length() - 1)
            while offset > end:
                (doc, ids, start, tail), piece = placed.pop()
                offset -= len(piece[2])
                keep = max(0, end - offset)
                if start + len(piece[2]) < len(ids):  # its tail waits already: only this part of it comes back
                    self._rejoin(doc, ids, start + len(piece[2]), start + keep, tail)
                else:
                    self._push((doc, ids, start + keep, tail))
                if keep:
                    placed.append(((doc, ids, start, tail), self._piece((doc, ids, start, tail), keep, offset)))
                    offset += keep
        yield from (piece for _, piece in placed)
        self.sequence += 1

    def _rejoin(self, doc: object, ids: np.ndarray, start: int, earlier: int, tail: int) -> None:
        """Let the waiting rest of an example begin earlier."""
        k = next(k for k, x in enumerate(self.pool) if x[1] is ids and x[2] == start)
        self._pop(k)
        self._push((doc, ids, earlier, tail))

    def settle(self) -> Iterator[tuple]:
        """Fill sequences while the pool is more than half full."""
        while len(self.pool) > POOL // 2 and self.size.sum() >= self.limits.tokens:
            yield from self.fill(self.limits.tokens)

    def close(self) -> Iterator[tuple]:
        """Place all that waits; the last few sequences end at powers of two, which need no padding."""
        while self.pool:
            rest = int(self.size.sum())
            yield from self.fill(self.limits.tokens if rest >= self.limits.tokens else 1 << (rest.bit_length() - 1))


def pack(docs: DataFrame, tokenizer: str, limits: Limits = Limits(), ids: bool = False,
         loss_col: str | None = None) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, loss_tokens, sequence_id, offset[, ids]).

    ``docs`` has doc_id and text, and ``loss_col`` if given: how many tokens at the end of an example bear
    loss (null or absent: all of them). A null or empty text is the end id alone. Each token lies in
    exactly one piece, pieces of a sequence follow each other without gaps, and no sequence exceeds the
    limits. Repeated rows are packed one by one, a null doc_id stays null, other columns are ignored, and an
    empty table gives no rows. A sequence belongs to one input partition, whose number is in the
    upper half of sequence_id, so ``docs`` should be a scan of files: run again, a task then gets the same rows.
    """
    column = F.col(loss_col).cast("long") if loss_col else F.lit(None).cast("long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, base = Packer(limits), TaskContext.get().partitionId() << 32

        def table(pieces: list[tuple]) -> pa.RecordBatch:
            data = [x[2].astype("<u4") for x in pieces]
            columns = [[x[0] for x in pieces], [x[1] for x in pieces], [len(x) for x in data],
                       [zlib.crc32(x.tobytes()) for x in data], [x[3] for x in pieces], [x[4] for x in pieces],
                       [base + x[5] for x in pieces], [x[6] for x in pieces]]
            arrays = [pa.array(x, pa.int64()) for x in columns]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "loss_tokens", "sequence_id", "offset"]
            if ids:
                arrays.append(pa.array([x.astype(np.int32) for x in data], pa.list_(pa.int32())))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            pieces: list[tuple] = []
            for doc, text, tail in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(),
                                       strict=True):
                tokens = token_ids(text.as_py(), tokenizer)
                tail = len(tokens) if tail is None else min(max(tail, 0), len(tokens))
                pieces += packer.add(doc, tokens, tail)
                if len(packer.pool) >= POOL:
                    pieces += packer.settle()
                if len(pieces) >= 4096:
                    yield table(pieces)
                    pieces = []
            yield table(pieces)
        yield table(list(packer.close()))

    kind = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, loss_tokens long, "
            "sequence_id long, offset long") + (", ids array<int>" if ids else "")
    return docs.select(F.col("doc_id").cast("long"), "text", column).mapInArrow(run, kind)
