"""Ranked lexical search: posting lists with range-maximum sparse tables, searched best first.

Documents are indexed in shards. In a shard, every query term has a posting list in document order and a sparse table
that answers "which posting of this stretch has the greatest impact" with two lookups. An interval of documents is
bounded by the sum of its terms' range maxima. The search opens the intervals with the greatest bounds first: it scores
the document of the greatest impact, splits the interval there, and goes on until no bound can enter the item's best
``k``. The result is exact. A shard passes on at most ``k`` documents an item; Spark ranks those.

Scores are the integers of ``impacts``; equal scores are ranked by ascending doc_id, rows without one last.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.lineage import Scratch

#: The bytes between terms. Letters A-Z are lower-cased, all bytes from 0x80 on belong to terms.
_BREAKS = {*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)}
_FOLD = bytes(0x20 if b in _BREAKS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: Texts longer than this are read piece by piece, cut between terms.
_CHUNK = 1 << 20
#: Documents and postings of a shard; a shard is closed when it has either.
SHARD_DOCS, SHARD_POSTINGS = 1 << 14, 1 << 21
#: Items searched together in a shard, and intervals opened for each of them at a time.
_TOGETHER, _WAVE = 32, 16
#: Bytes of item texts that are searched in one pass over the index.
BLOCK_BYTES = 1 << 22
_RESULT = "item int, item_id long, doc_id long, score long"


def terms(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of bounded size."""
    text, at = text or b"", 0
    while at < len(text):
        end = at + _CHUNK
        while end < len(text) and _FOLD[text[end]] != 0x20:
            end += 1
        yield text[at:end].translate(_FOLD).split()
        at = end


def weight(n_docs: int, df: int) -> int:
    """Weight of a term that ``df`` of ``n_docs`` documents hold."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(weights: np.ndarray, tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What one occurrence of a term in an item adds to the score of a document of ``n`` terms that has it ``tf`` times."""
    wide = n.astype(object) if int(n.max(initial=0)) * 75 * n_docs >= 1 << 63 else n  # whole numbers of any size
    m = 25 + ((75 * wide * n_docs) // max(n_terms, 1)).astype(np.int64)
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


@dataclass
class Block:
    """Some items: their ids, the terms of each (number -> repeats), and the numbers of all terms."""

    ids: list[int | None] = field(default_factory=list)
    items: list[dict[int, int]] = field(default_factory=list)
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    size: int = 0

    def add(self, item_id: int | None, text: str | None) -> None:
        numbers: Counter[int] = Counter()
        for words in terms((text or "").encode()):
            numbers.update(self.vocabulary.setdefault(word, len(self.vocabulary)) for word in words)
        self.ids.append(item_id)
        self.items.append(dict(numbers))
        self.size += len(text or "")


class Shard:
    """Posting lists of one block of documents, numbered from 0, over term numbers."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, docs: int, terms: int):
        order = np.argsort(term.astype(np.int64) * docs + doc, kind="stable")
        self.docs = docs
        self.doc, self.impact = doc[order].astype(np.int32), impact[order]
        self.key = term[order].astype(np.int64) * docs + self.doc
        self.first = np.searchsorted(self.key, np.arange(terms + 1, dtype=np.int64) * docs)
        longest = int(np.diff(self.first).max(initial=1))
        self.level = np.frexp(np.arange(longest + 1))[1].astype(np.int8) - 1
        self.best = self._sparse_table(max(longest, 1).bit_length())

    def _sparse_table(self, levels: int) -> np.ndarray:
        """best[j][p]: place of the greatest impact in postings p to p + 2^j - 1, the first of equals."""
        size = len(self.doc)
        best = np.empty((levels, size), dtype=np.int32)
        best[0] = np.arange(size, dtype=np.int32)
        for j in range(1, levels):
            half, count = 1 << (j - 1), max(size - (1 << j) + 1, 0)
            near, far = best[j - 1, :count], best[j - 1, half: half + count]
            best[j, :count] = np.where(self.impact[near] >= self.impact[far], near, far)
        return best

    def greatest(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Place of the greatest impact in each stretch [start, end) of one posting list."""
        level = self.level[end - start]
        near, far = self.best[level, start], self.best[level, end - (1 << level.astype(np.int64))]
        return np.where(self.impact[near] >= self.impact[far], near, far)

    def search(self, items: list[dict[int, int]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, document, score) of the ``k`` best documents of each item (term number -> repeats)."""
        found = [Search(self, items[at: at + _TOGETHER], k).run() for at in range(0, len(items), _TOGETHER)]
        shift = np.repeat(np.arange(len(found)) * _TOGETHER, [len(f[0]) for f in found])
        item, doc, score = (np.concatenate([f[n] for f in found]) for n in range(3))
        return item + shift, doc, score


class Search:
    """Best-first search of some items in one shard.

    An interval owns a run of pairs (one for each term of its item with postings there): stretch, place of the greatest
    impact, term, repeats. Pairs are appended and never moved.
    """

    def __init__(self, shard: Shard, items: list[dict[int, int]], k: int):
        self.shard, self.k, self.items = shard, k, len(items)
        self.pairs = np.empty((5, 4096), dtype=np.int32)  # start, end, greatest, term, repeats
        self.used = 0
        self.open = np.empty((4, 0), dtype=np.int64)  # item, bound, first pair, end of pairs
        self.low = np.empty(0, dtype=np.int64)  # first document of the interval
        self.top = np.empty((3, 0), dtype=np.int64)  # item, document, score
        self.least = np.zeros(self.items, dtype=np.int64)  # score and document that a newcomer must beat
        self.least_doc = np.full(self.items, -1, dtype=np.int64)
        owner = np.repeat(np.arange(self.items), [len(x) for x in items])
        term = np.array([t for x in items for t in x], dtype=np.int64)
        repeats = np.array([r for x in items for r in x.values()], dtype=np.int64)
        start, end = shard.first[term], shard.first[term + 1]
        self._add(owner, np.zeros(self.items, dtype=np.int64), np.arange(self.items), start, end, term, repeats)

    def _add(self, owner: np.ndarray, low: np.ndarray, item: np.ndarray, start: np.ndarray, end: np.ndarray,
             term: np.ndarray, repeats: np.ndarray) -> None:
        """New intervals: pairs in order of their ``owner``, an index into ``low`` and ``item``."""
        some = start < end
        owner, start, end, term, repeats = owner[some], start[some], end[some], term[some], repeats[some]
        if not len(owner):
            return
        at = self.shard.greatest(start, end)
        value = self.shard.impact[at] * repeats
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        bound, whose = np.add.reduceat(value, first), owner[first]
        last = np.append(first[1:], len(owner))
        wanted = self._enters(item[whose], bound, low[whose])
        keep = np.repeat(wanted, last - first)
        count = (last - first)[wanted]
        ends = self.used + np.cumsum(count)
        size = int(count.sum())
        while self.used + size > self.pairs.shape[1]:
            self.pairs = np.concatenate([self.pairs, np.empty_like(self.pairs)], axis=1)
        self.pairs[:, self.used: self.used + size] = np.stack([x[keep] for x in (start, end, at, term, repeats)])
        self.used += size
        self.open = np.concatenate([self.open, np.stack([item[whose][wanted], bound[wanted], ends - count, ends])], axis=1)
        self.low = np.concatenate([self.low, low[whose][wanted]])

    def _enters(self, item: np.ndarray, bound: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Whether a document from ``low`` on with a score up to ``bound`` may be among the best of its item."""
        least = self.least[item]
        return (bound > least) | ((bound == least) & (low < self.least_doc[item]))

    def _next(self) -> np.ndarray:
        """The open intervals with the greatest bounds, up to ``_WAVE`` an item; those that can't enter any more go."""
        may = self._enters(self.open[0], self.open[1], self.low)
        self.open, self.low = self.open[:, may], self.low[may]
        order = np.lexsort((self.low, -self.open[1], self.open[0]))
        item = self.open[0][order]
        first = np.flatnonzero(np.diff(item, prepend=-1))
        place = np.arange(len(item)) - np.repeat(first, np.diff(np.append(first, len(item))))
        return order[place < _WAVE]

    def _score(self, item: np.ndarray, doc: np.ndarray, score: np.ndarray) -> None:
        """Keep the ``k`` best of each item."""
        top = np.concatenate([self.top, np.stack([item, doc, score])], axis=1)
        top = top[:, np.lexsort((top[1], -top[2], top[0]))]
        first = np.flatnonzero(np.diff(top[0], prepend=-1))
        size = np.diff(np.append(first, top.shape[1]))
        place = np.arange(top.shape[1]) - np.repeat(first, size)
        full = first[size >= self.k] + self.k - 1
        self.least[top[0][full]], self.least_doc[top[0][full]] = top[2][full], top[1][full]
        self.top = top[:, place < self.k]

    def run(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shard = self.shard
        while self.open.shape[1]:
            chosen = self._next()
            if not len(chosen):
                break
            item, _, begin, until = self.open[:, chosen]
            low = self.low[chosen]
            rest = np.ones(self.open.shape[1], dtype=bool)
            rest[chosen] = False
            self.open, self.low = self.open[:, rest], self.low[rest]
            count = until - begin
            first = np.cumsum(count) - count
            owner = np.repeat(np.arange(len(chosen)), count)
            pair = np.arange(len(owner)) - np.repeat(first, count) + np.repeat(begin, count)
            start, end, at, term, repeats = self.pairs[:, pair].astype(np.int64)
            value = shard.impact[at] * repeats
            greatest = np.maximum.reduceat(value, first)
            # the first of the pairs with the greatest value
            lead = np.flatnonzero(value == greatest[owner])
            lead = lead[np.flatnonzero(np.diff(owner[lead], prepend=-1))]
            doc = shard.doc[at[lead]].astype(np.int64)
            cut = np.searchsorted(shard.key, term * shard.docs + doc[owner])
            hit = cut < end
            hit[hit] = shard.doc[cut[hit]] == doc[owner[hit]]
            here = np.where(hit, shard.impact[np.minimum(cut, len(shard.impact) - 1)] * repeats, 0)
            self._score(item, doc, np.add.reduceat(here, first))
            self._add(owner, low, item, start, cut, term, repeats)
            self._add(owner, doc + 1, item, cut + hit, end, term, repeats)
        good = self.top[:, self.top[2] > 0]
        return good[0], good[1], good[2]


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, term, tf): each document with terms, how many, and those of the vocabulary with their occurrences."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            rows, sizes, ends, term, tf = [], [], [0], [], []
            for row, text in enumerate(batch.column(1).cast(pa.binary())):
                n, counts = 0, Counter()
                for words in terms(text.as_py()):
                    n += len(words)
                    counts.update(map(number, words))
                if n:
                    counts.pop(None, None)
                    rows.append(row)
                    sizes.append(n)
                    term += counts.keys()
                    tf += counts.values()
                    ends.append(len(term))
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(at, pa.array(term, pa.int32())), pa.ListArray.from_arrays(at, pa.array(tf, pa.int64()))],
                names=["doc_id", "n", "term", "tf"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n long, term array<int>, tf array<long>")


def best_of_shards(index: DataFrame, block: Block, weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, item_id, doc_id, score): the ``k`` best documents of every item in each shard of a task's rows."""
    shared = index.sparkSession.sparkContext.broadcast((block.ids, block.items, weights))

    def found(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        ids, items, weights = shared.value
        doc_id = pa.chunked_array([p[0] for p in parts]).combine_chunks()
        order = pa.compute.sort_indices(doc_id, null_placement="at_end")
        n, size = (np.concatenate([p[c] for p in parts]) for c in (1, 2))
        term, tf = (np.concatenate([p[c] for p in parts]) for c in (3, 4))
        place = np.empty(len(n), dtype=np.int64)
        place[order.to_numpy()] = np.arange(len(n))
        owner = np.repeat(np.arange(len(n)), size)
        impact = impacts(weights[term], tf, n[owner], n_docs, n_terms)
        item, doc, score = Shard(term, place[owner], impact, len(n), len(weights)).search(items, k)
        return pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), pa.array([ids[x] for x in item.tolist()], pa.int64()),
             doc_id.take(order).take(pa.array(doc, pa.int64())), pa.array(score, pa.int64())],
            names=["item", "item_id", "doc_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows, total = [], 0, 0
        for batch in batches:
            while batch.num_rows:
                size = pa.compute.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)
                room = np.searchsorted(np.cumsum(size), SHARD_POSTINGS - total, side="right")
                piece = batch.slice(0, min(max(int(room), 1 if not rows else 0), SHARD_DOCS - rows))
                batch = batch.slice(piece.num_rows)
                if piece.num_rows:
                    parts.append((piece.column(0), piece.column(1).to_numpy(), size[: piece.num_rows],
                                  piece.column(2).flatten().to_numpy().astype(np.int64), piece.column(3).flatten().to_numpy()))
                    rows, total = rows + piece.num_rows, total + int(size[: piece.num_rows].sum())
                if batch.num_rows or rows >= SHARD_DOCS:
                    yield found(parts)
                    parts, rows, total = [], 0, 0
        if parts:
            yield found(parts)

    return index.mapInArrow(run, _RESULT)


def _search_block(docs: DataFrame, block: Block, k: int, work: Scratch, name: str) -> DataFrame:
    index = work.write(postings(docs, block.vocabulary), f"{name}-index")
    n_docs, n_terms = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(block.vocabulary), dtype=np.int64)
    for term, count in index.select(F.explode("term").alias("term")).groupBy("term").count().toLocalIterator():
        df[term] = count
    weights = np.array([weight(n_docs, x) for x in df.tolist()], dtype=np.int64)
    shards = index.where(F.size("term") > 0).coalesce(max(1, -(-n_docs // SHARD_DOCS)))
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = (best_of_shards(shards, block, weights, n_docs, n_terms, k)
            .withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))
    best = work.write(best, f"{name}-best")
    work.drop(f"{name}-index")
    return best


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents with the highest scores above 0 of each row of ``items``.

    ``docs`` needs doc_id and text, ``items`` item_id and text; other columns are ignored. Terms are the maximal runs of
    digits, ASCII letters (A-Z lower-cased) and characters from U+0080 on. Null or blank texts have no terms: such a
    document is not counted, such an item finds nothing. Repeated rows, and rows without id, count one by one; a null
    doc_id comes last among equals. Empty tables give no rows.

    Items are taken in blocks of ``BLOCK_BYTES`` of text. Each block reads all documents once, keeps their postings of
    the block's terms in a written table, and broadcasts only the block's terms. Nothing that grows with the documents is
    shuffled but the ``k`` rows an item that each shard passes on.
    """
    work, best = Scratch(docs.sparkSession, "ranked-search"), []

    def close(block: Block) -> Block:
        if block.vocabulary:
            best.append(_search_block(docs, block, k, work, f"block-{len(best)}"))
        return Block()

    block = Block()
    for item_id, text in items.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        block.add(item_id, text)
        if block.size >= BLOCK_BYTES:
            block = close(block)
    close(block)
    empty = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionAll, best) if best else empty
