"""MinHash near-dedup with min-max hashing.

Each permutation of a document's shingle set keeps both its minimum and its maximum, so 63
multiplications give 125 signature values (25 bands of 5). Documents with equal sets collapse to one
class. Classes that share a band key are candidates; candidate groups are compared in tiles on their
full sets, and only confirmed links decide the components.

A pair at similarity s shares no band with probability (1 - s^5)^25: 4e-7 at 0.85, 5e-5 at 0.8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.lineage import Scratch
from kiln.llm.shingles import mix, shingle_set, signed, stream
from kiln.llm.sieve import sieve
from kiln.operators.components import connected_components

BANDS, ROWS = 25, 5
#: Classes per tile of a large candidate group; a task holds the sets of two tiles.
TILE = 256
_COLUMNS = 4096


def min_max_bands(shingles: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """Band keys of one set: minima and maxima of ceil(bands * rows / 2) permutations, interleaved."""
    factors = stream(-(-bands * rows // 2), 11)
    low = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    high = np.zeros(len(factors), dtype=np.uint64)
    for at in range(0, len(shingles), 2048):
        turned = np.multiply.outer(factors, shingles[at: at + 2048])
        np.minimum(low, turned.min(axis=1), out=low)
        np.maximum(high, turned.max(axis=1), out=high)
    values = np.stack([low, high], axis=1).ravel()[: bands * rows].reshape(bands, rows)
    key = (mix(values) * stream(rows, 12)).sum(axis=1, dtype=np.uint64)
    return mix(key ^ stream(bands, 13))


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, bands): one row per document; set_a and set_b name the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            sizes, names, keys = [], [], []
            for text in texts:
                shingles = shingle_set(text)
                sizes.append(len(shingles))
                names.append((shingles.sum(dtype=np.uint64), mix(shingles + np.uint64(1)).sum(dtype=np.uint64)))
                keys.append(signed(min_max_bands(shingles, bands, rows)) if len(shingles) else None)
            names = signed(np.array(names, dtype=np.uint64).reshape(-1, 2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(names[:, 0]), pa.array(names[:, 1]),
                 pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_a", "set_b", "bands"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of every left set with every right set, as matrix products over shared shingles."""
    a, b = np.concatenate(left), np.concatenate(right)
    of_a = np.repeat(np.arange(len(left)), [len(x) for x in left])
    of_b = np.repeat(np.arange(len(right)), [len(x) for x in right])
    common = np.intersect1d(a, b)
    out = np.zeros((len(left), len(right)), dtype=np.float64)

    def places(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(common, values), len(common) - 1)
        hit = common[at] == values if len(common) else np.zeros(len(values), dtype=bool)
        order = np.argsort(at[hit], kind="stable")
        return at[hit][order], owner[hit][order]

    if not len(common):
        return out
    (col_a, row_a), (col_b, row_b) = places(a, of_a), places(b, of_b)
    for start in range(0, len(common), _COLUMNS):
        sides = []
        for col, row, n in ((col_a, row_a, len(left)), (col_b, row_b, len(right))):
            lo, hi = np.searchsorted(col, [start, start + _COLUMNS])
            side = np.zeros((n, min(_COLUMNS, len(common) - start)), dtype=np.float32)
            side[row[lo:hi], col[lo:hi] - start] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out


def _spanning(link: np.ndarray) -> list[tuple[int, int]]:
    """(member, root) for each component of a symmetric boolean matrix, roots left out."""
    todo, out = np.ones(len(link), dtype=bool), []
    for root in range(len(link)):
        if not todo[root]:
            continue
        todo[root] = False
        front = [root]
        while front:
            reached = np.flatnonzero(link[front].any(axis=0) & todo)
            todo[reached] = False
            out += [(int(x), root) for x in reached]
            front = list(reached)
    return out


def _confirmed(unit: tuple, ids: list[int], tiles: list[int], texts: list[bytes], percent: int) -> list[tuple]:
    """Spanning links of one work unit: all pairs of one tile, or of one tile with another."""
    sets = [shingle_set(x) for x in texts]
    keep = [k for k, x in enumerate(sets) if len(x)]
    if len(keep) < 2:
        return []
    _, first, second = unit
    left = [k for k in keep if tiles[k] == first]
    right = left if first == second else [k for k in keep if tiles[k] == second]
    if not left or not right:
        return []
    shared = overlaps([sets[k] for k in left], [sets[k] for k in right])
    sizes = np.array([len(x) for x in sets], dtype=np.float64)
    union = sizes[left][:, None] + sizes[right][None, :] - shared
    link = np.zeros((len(ids), len(ids)), dtype=bool)
    link[np.ix_(left, right)] = 100 * shared >= percent * union
    return [(ids[a], ids[b]) for a, b in _spanning(link | link.T)]


def confirmed_links(units: DataFrame, percent: int) -> DataFrame:
    """(a, b): spanning links of each unit (grp, first, second) over its rows (node, tile, text).

    Rows arrive sorted by unit and are read as a stream: a task holds one unit at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, rows = None, ([], [], [])

        def closed() -> pa.RecordBatch:
            links = _confirmed(unit, *rows, percent) if unit else []
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)],
                                              names=["a", "b"])

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(5)]
            for grp, first, second, node, tile, text in zip(
                    *columns, batch.column(5).cast(pa.binary()).to_pylist(), strict=True):
                if unit != (grp, first, second):
                    yield closed()
                    unit, rows = (grp, first, second), ([], [], [])
                for values, value in zip(rows, (node, tile, text), strict=True):
                    values.append(value)
        yield closed()

    keys = ["grp", "first", "second"]
    return (units.select(*keys, "node", "tile", "text").repartition(*keys).sortWithinPartitions(*keys)
            .mapInArrow(run, "a long, b long"))


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row per row of ``docs`` (doc_id, text; others ignored).

    Documents are linked when 100 * intersection >= ``percent`` * union of their shingle sets;
    component_id is the smallest doc_id reachable and kept marks that document. A null or blank text has
    an empty set and links with nothing. Rows with one doc_id share a component. A row without doc_id
    links with nothing: its component_id is null and it is kept. An empty table gives no rows.

    Shuffles: one row per class and band, the texts of candidate documents, and edges. Which documents those are is
    written, and a filter of fixed size keeps most other texts from the join. Equal sets, hot or not, are reduced map-side to one class; groups larger than ``TILE`` are
    dealt as tile pairs, and only tiles that share a band key meet.
    """
    work = Scratch(docs.sparkSession, "near-dup")
    sig = work.write(signatures(docs), "signatures")
    classes = work.write(
        sig.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_a", "set_b")
        .agg(F.min(F.struct("doc_id", "bands")).alias("m"))
        .select("set_a", "set_b", F.col("m.doc_id").alias("node"), "m.bands"), "classes")
    slots = classes.select("node", F.explode("bands").alias("slot"))
    # heads and counts are written, so that their joins read two plain scans and a hot key can be split
    heads = work.write(slots.groupBy("slot").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n"))
                       .where("n > 1").select("slot", "head"), "heads")
    stars = slots.join(heads, "slot").where("node <> head").selectExpr("node AS a", "head AS b")
    groups = work.write(connected_components(stars, work, "candidates"), "groups")
    counts = work.write(groups.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles")), "counts")
    member = work.write(
        groups.join(counts, "component")
        .select("node", F.col("component").alias("grp"), "tiles",
                F.expr("CAST(pmod(xxhash64(node), tiles) AS INT)").alias("tile")), "members")
    big = member.where("tiles > 1")
    held = (big.join(classes.select("node", "bands"), "node")
            .select("grp", "tile", F.explode("bands").alias("slot")).distinct())
    pairs = work.write(
        held.withColumnRenamed("tile", "first")
        .join(held.selectExpr("slot", "grp", "tile AS second"), ["slot", "grp"]).where("first <= second")
        .select("grp", "first", "second").distinct(), "tile-pairs")
    whole = member.where("tiles = 1").selectExpr("node", "grp", "tile", "0 AS first", "0 AS second")
    tiled = big.select("node", "grp", "tile").join(
        pairs.select("grp", "first", "second",
                     F.explode(F.array_distinct(F.array("first", "second"))).alias("tile")), ["grp", "tile"])
    wanted = work.write(whole.unionByName(tiled), "units")
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text")
    units = sieve(texts, "node", wanted).join(wanted, "node")
    labels = connected_components(confirmed_links(units, percent), work, "links")
    for name in ("heads", "groups", "counts", "members", "tile-pairs", "units"):
        work.drop(name)
    named = (classes.select("set_a", "set_b", "node").join(labels, "node", "left")
             .select("set_a", "set_b", F.coalesce("component", "node").alias("component_id")))
    return (sig.select("doc_id", "n_shingles", "set_a", "set_b").join(named, ["set_a", "set_b"], "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("c"))
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.col("c")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
