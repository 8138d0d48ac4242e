"""Fill-in-the-middle transformation over a learned rank index.

Cuts fall between units (a run of ASCII letters, or any other single character), so the k-th boundary's character offset
is needed for random k. ``RankIndex`` learns it: line segments are fitted greedily to all boundary offsets so that no
offset is further than ``ERROR`` characters from its line, and each boundary keeps the difference in one signed byte. A cut is the
segment's prediction corrected by the stored difference, which is exact. One index serves all texts of a block: their
boundaries follow each other, and a text is a range of ranks.

A document with control strings, an empty one, and those that the draw leaves out stay as they are (``plain``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The control strings, the shares (percent) of transformed texts and of suffix-first ones among them.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
TRANSFORMED, SUFFIX_FIRST = 90, 20
#: Greatest distance of a boundary offset from its line; the rounded difference fits a signed byte.
ERROR = 120
#: Characters indexed together; a longer text is a block of its own.
BLOCK = 1 << 20
_FIRST_REACH = 64


@dataclass
class RankIndex:
    """Offsets of boundaries by rank: segments (first rank, its offset, slope) and the differences from them."""

    first: np.ndarray
    offset: np.ndarray
    slope: np.ndarray
    difference: np.ndarray

    @classmethod
    def fit(cls, offsets: np.ndarray, error: int = ERROR) -> RankIndex:
        """The longest segments, one after another, whose line from the first offset keeps within ``error``."""
        first, slopes, at, size = [], [], 0, len(offsets)
        while at < size:
            low, high, end, reach = -np.inf, np.inf, at + 1, _FIRST_REACH
            while end < size:
                stop = min(end + reach, size)
                run = np.arange(end - at, stop - at, dtype=np.float64)
                rise = (offsets[end:stop] - offsets[at]).astype(np.float64)
                lows = np.maximum(np.maximum.accumulate((rise - error) / run), low)
                highs = np.minimum(np.minimum.accumulate((rise + error) / run), high)
                broken = lows > highs
                if broken.any():
                    last = int(np.argmax(broken))
                    if last:
                        low, high = lows[last - 1], highs[last - 1]
                    end += last
                    break
                low, high, end, reach = lows[-1], highs[-1], stop, reach * 2
            first.append(at)
            slopes.append((low + high) / 2 if end > at + 1 else 0.0)
            at = end
        starts = np.array(first, dtype=np.int64)
        index = cls(starts, offsets[starts], np.array(slopes), np.zeros(size, dtype=np.int8))
        index.difference = (offsets - index.predict(np.arange(size))).astype(np.int8)
        return index

    def predict(self, rank: np.ndarray) -> np.ndarray:
        segment = np.searchsorted(self.first, rank, side="right") - 1
        return self.offset[segment] + np.floor(self.slope[segment] * (rank - self.first[segment])).astype(np.int64)

    def __call__(self, rank: np.ndarray) -> np.ndarray:
        """Exact offsets of these ranks."""
        return self.predict(rank) + self.difference[rank]


def boundaries(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, start): where each unit of the joined texts starts, then their end; and the rank of each text's first unit.

    A text starts a unit of its own even between two letters, so ranks start[i] to start[i + 1] are text i.
    """
    joined = "".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    small = codes | np.uint32(0x20)
    letter = (small >= 0x61) & (small <= 0x7A)
    starts = np.ones(len(codes) + 1, dtype=bool)
    np.logical_not(letter[1:] & letter[:-1], out=starts[1:-1])
    ends = np.cumsum([0, *map(len, texts)])
    starts[ends] = True
    offsets = np.flatnonzero(starts)
    return offsets, np.searchsorted(offsets, ends)


def draws(doc_id: int | None) -> tuple[int, ...]:
    """Four reproducible numbers of a document: the first four 32-bit groups of the sha256 of ``1:`` and the id."""
    digest = sha256(f"1:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[at: at + 4], "big") for at in range(0, 16, 4))


def transform_block(ids: list[int | None], texts: list[str]) -> Iterator[tuple]:
    """(n, form, prefix_chars, middle_chars, output) of each text."""
    offsets, start = boundaries(texts)
    units = np.diff(start)
    drawn = np.array([draws(x) for x in ids], dtype=np.int64).reshape(-1, 4)
    cuts = np.sort(drawn[:, :2] % (units + 1)[:, None], axis=1)
    index = RankIndex.fit(offsets)
    places = index((cuts + start[:-1, None]).ravel()).reshape(-1, 2) - offsets[start[:-1], None]
    for text, n, (first, second), (_, _, change, order) in zip(texts, units.tolist(), places.tolist(), drawn.tolist(), strict=True):
        if not text or change % 100 >= TRANSFORMED or PREFIX in text or SUFFIX in text or MIDDLE in text:
            yield n, "plain", None, None, text
        elif order % 100 < SUFFIX_FIRST:
            yield n, "spm", first, second - first, f"{SUFFIX}{text[second:]}{PREFIX}{text[:first]}{MIDDLE}{text[first:second]}"
        else:
            yield n, "psm", first, second - first, f"{PREFIX}{text[:first]}{SUFFIX}{text[second:]}{MIDDLE}{text[first:second]}"


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): one row per row of ``docs`` (doc_id, text; others ignored).

    ``n`` counts the units of the text; ``prefix_chars`` and ``middle_chars`` count code points and are null for plain
    texts. A null text counts as empty, a null doc_id as the empty number in the draws. Rows with one doc_id get the same
    draws. An empty table gives no rows. Nothing is shuffled; a text of any length is indexed in one task.
    """
    kind = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
    names = [field.split()[0] for field in kind.split(", ")]

    def blocks(batch: pa.RecordBatch) -> Iterator[tuple[list, list]]:
        ids, texts, size = [], [], 0
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = text.as_py() or ""
            if texts and size + len(text) > BLOCK:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
        if texts:
            yield ids, texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in blocks(batch):
                columns = [ids, *zip(*transform_block(ids, texts), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, kind)


def restored(output: Column, form: Column) -> Column:
    """The text from its output and form. The parts hold no control string, so the first one found is the one put there."""
    middle = F.substring_index(output, MIDDLE, -1)

    def parts(first: str, second: str) -> tuple[Column, Column]:
        head = F.substring_index(output, MIDDLE, 1)
        return (F.substr(F.substring_index(head, second, 1), F.lit(len(first) + 1)), F.substring_index(head, second, -1))

    prefix, suffix = parts(PREFIX, SUFFIX)
    suffix_first, prefix_second = parts(SUFFIX, PREFIX)
    return (F.when(form == "psm", F.concat(prefix, middle, suffix))
            .when(form == "spm", F.concat(prefix_second, middle, suffix_first)).otherwise(output))


def digests(transformed: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of ``fill_in_middle``."""
    return transformed.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
