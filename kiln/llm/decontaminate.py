"""Benchmark decontamination: size-partitioned MinHash containment search.

A short test item inside a long document has a tiny Jaccard similarity, so documents are partitioned
by the size of their shingle set (powers of two) and each partition gets a signature that grows with its
bound: one-permutation MinHash with ``OVERSAMPLE`` bins per shingle of the bound, under ``TURNS``
permutations. An item is signed once for each partition. One equal bin minimum makes a candidate. Items of one or
two shingles are candidates of every document that has one of them. Shared shingles are counted for candidates
only, which are confirmed by exact containment of the item's shingles in the document's whole set.

A shared shingle is the minimum of its bin on both sides with probability about 0.78 a turn. Items of one or two
shingles are always found; one with three shared shingles is missed with probability about 1e-6 and one with eight
or more practically never.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.lineage import Scratch
from kiln.llm.names import fresh
from kiln.llm.shingles import shingle_set, signed, stream

TURNS, OVERSAMPLE_BITS = 3, 2
#: Items that need at most so many shared shingles become candidates by the document's whole set, not its signature.
EXACT = 2
#: Size partitions: up to 2^6 shingles, then by powers of two to 2^40.
LEAST_PART, MOST_PART = 6, 40
#: The filter of item shingles that every task gets has this fixed size: 2^23 bits, one megabyte.
FILTER_BITS = 23
_PROBES = 4


def size_part(n: int) -> int:
    """Number of the size partition: sets of at most 2^part shingles."""
    return min(max(LEAST_PART, int(n - 1).bit_length()), MOST_PART)


def bin_minima(shingles: np.ndarray, part: int) -> Iterator[tuple[int, np.ndarray]]:
    """(turn, the shingles that are the minimum of their bin) for each permutation."""
    shift = np.uint64(64 - part - OVERSAMPLE_BITS)
    for turn, factor in enumerate(stream(TURNS, 21)):
        turned = shingles * factor
        order = np.argsort(turned)
        bins = turned[order] >> shift
        yield turn, shingles[order[np.flatnonzero(np.diff(bins, prepend=bins[0] + np.uint64(1)))]]


def _probe(shingles: np.ndarray) -> list[np.ndarray]:
    return [(shingles * f) >> np.uint64(64 - FILTER_BITS) for f in stream(_PROBES, 22)]


def item_sets(items: DataFrame) -> DataFrame:
    """(item_id, n_item, shingles): one row per item with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(x) for x in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) for x in sets], pa.int64()),
                 pa.array([signed(x) for x in sets], pa.list_(pa.int64()))], names=["item_id", "n_item", "shingles"])

    return (items.select(F.col("item_id").cast("long"), "text")
            .mapInArrow(run, "item_id long, n_item long, shingles array<long>").where("n_item > 0"))


def _filter_bits(sets: DataFrame) -> np.ndarray:
    """The fixed-size Bloom filter of all item shingles; at most 2^FILTER_BITS positions reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            at = np.unique(np.concatenate(_probe(flat))) if len(flat) else flat
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64))], names=["at"])

    at = sets.select("shingles").mapInArrow(run, "at long").distinct().toArrow()["at"].to_numpy()
    bits = np.zeros(1 << FILTER_BITS, dtype=bool)
    bits[at] = True
    return np.packbits(bits)


def touched_documents(docs: DataFrame, packed: np.ndarray) -> DataFrame:
    """Documents with a signed shingle in the filter: (doc_id, text_hash, part, signed, touching).

    ``signed`` holds (turn, shingle) of the signature and ``touching`` all shingles of the whole set that
    the filter lets through.
    """
    shared = docs.sparkSession.sparkContext.broadcast(packed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shared.value).astype(bool)

        def within(values: np.ndarray) -> np.ndarray:
            for f in stream(_PROBES, 22):
                values = values[bits[(values * f) >> np.uint64(64 - FILTER_BITS)]]
            return values

        for batch in batches:
            at, parts, turns, signs, touching = [], [], [], [], []
            for k, text in enumerate(batch.column(2).cast(pa.binary()).to_pylist()):
                whole = shingle_set(text)
                near = within(whole)
                if not len(near):
                    continue
                part = size_part(len(whole))
                found = [(turn, np.intersect1d(minima, near)) for turn, minima in bin_minima(whole, part)]
                at.append(k)
                parts.append(part)
                turns.append(np.repeat([t for t, _ in found], [len(x) for _, x in found]).astype(np.int32))
                signs.append(signed(np.concatenate([x for _, x in found])))
                touching.append(signed(near))
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(parts, pa.int32()),
                 pa.array(turns, pa.list_(pa.int32())), pa.array(signs, pa.list_(pa.int64())),
                 pa.array(touching, pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "part", "turns", "signs", "touching"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
            .mapInArrow(run, "doc_id long, text_hash long, part int, turns array<int>, signs array<long>, "
                             "touching array<long>"))


def signed_items(sets: DataFrame) -> DataFrame:
    """(item_row, turn, sign, parts): the shingles that sign an item, with the size partitions (bits) they do so in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts: dict[tuple[int, int], int] = {}
                for part in range(LEAST_PART, MOST_PART + 1):
                    for turn, minima in bin_minima(np.array(values, dtype=np.int64).view(np.uint64), part):
                        for sign in signed(minima).tolist():
                            parts[turn, sign] = parts.get((turn, sign), 0) | 1 << part
                out += [(row, turn, sign, bits) for (turn, sign), bits in parts.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                names=["item_row", "turn", "sign", "parts"])

    return sets.select("item_row", "shingles").mapInArrow(run, "item_row long, turn int, sign long, parts long")


def contained_items(docs: DataFrame, items: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, text_hash, item_id, n_item, n_shared): each document row with each item it contains.

    An item is contained when 100 * shared >= ``percent`` * n_item over distinct five-word shingles of the
    whole texts (A-Z lower-cased). ``docs`` needs doc_id and text, ``items`` item_id and text; other
    columns are ignored. Null or blank texts on either side match nothing; an item of fewer than five
    words matches only a document that is that very sequence. Repeated rows, and rows without id, are
    reported one by one. Empty tables give no rows.

    The corpus is read once and not shuffled; what follows grows with the contaminated documents.
    """
    work = Scratch(docs.sparkSession, "decontaminate")
    # numbered before they are written: numbers given to a scan would change with the cores that read it
    sets = work.write(item_sets(items).withColumn("item_row", F.monotonically_increasing_id()), "items")
    touched = work.write(touched_documents(docs, _filter_bits(sets)).withColumn("doc_row", F.monotonically_increasing_id()), "touched")
    signs = touched.select("doc_row", "part", F.explode(F.arrays_zip("turns", "signs")).alias("s")) \
        .select("doc_row", "part", F.col("s.turns").alias("turn"), F.col("s.signs").alias("sign"))
    wanted = work.write(signed_items(sets), "signed-items")  # written, so that Spark joins it by its real size
    by_sign = (signs.join(wanted, ["turn", "sign"]).where("(parts & shiftleft(1L, part)) <> 0")
               .select("doc_row", "item_row"))
    by_set = (touched.select("doc_row", F.explode("touching").alias("x"))
              .join(sets.where(F.col("n_item") * percent <= EXACT * 100).select("item_row", F.explode("shingles").alias("x")), "x")
              .select("doc_row", "item_row"))
    candidates = work.write(by_sign.unionByName(by_set).distinct(), "candidates")
    work.drop("signed-items")
    return (candidates.join(sets, "item_row")
            .join(touched.select("doc_row", "doc_id", "text_hash", "touching"), "doc_row")
            .withColumn("n_shared", F.size(F.array_intersect("shingles", "touching")).cast("long"))
            .where(F.col("n_shared") * 100 >= F.col("n_item") * percent)
            .select("doc_id", "text_hash", "item_id", "n_item", "n_shared"))


def clean_documents(docs: DataFrame, items: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that contain no item, all columns unchanged.

    The contaminated rows are written before the join, so that their real size decides how it runs: while they are few,
    the texts are not shuffled.
    """
    bad_id, bad_hash = fresh(docs.columns, "_bad_id", "_bad_hash")
    bad = Scratch(docs.sparkSession, "contaminated").write(contained_items(docs, items, percent).select(
        F.col("doc_id").alias(bad_id), F.col("text_hash").alias(bad_hash)).distinct(), "rows")
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(F.col(bad_id))
                     & (F.xxhash64(docs["text"]) == F.col(bad_hash)), "left_anti")
