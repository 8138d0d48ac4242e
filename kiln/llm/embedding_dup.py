"""Embedding near-dedup by collision counting over one-dimensional projections.

Two unit vectors at cosine c have Gaussian projections that differ by a standard deviation of sqrt(2 - 2c).
A pair collides on a projection when each lies in the window centred on the other; a pair at the threshold
collides on most projections, an unrelated one on a third. Pairs whose number of collisions reaches a count
calibrated for recall are verified by their cosine in double precision.

Vectors are sorted by label and first projection into tiles. Tiles of a label meet when their ranges lie
within a wide window of each other; a task counts the collisions of two tiles with vector arithmetic, so no
pair becomes a row: it returns link counts per vector and a spanning forest of the links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.lineage import Scratch
from kiln.operators.components import connected_components

PROJECTIONS = 32
#: Half widths of the windows in standard deviations of a pair at the threshold.
WINDOW, WIDE = 1.6, 4.0
#: Chance that a pair at the threshold passes the count.
RECALL = 0.9999
#: A block product and the sum of one pair differ by less, so that a pair is judged alike in every tile.
_ROUNDING = 1e-9
#: Vectors in a tile, at most 65,535; a task holds two tiles and a few matrices of this side.
TILE = 1024


def least_collisions(recall: float = RECALL) -> int:
    """Largest count that a pair at the threshold reaches with probability ``recall``."""
    hit = math.erf(WINDOW / math.sqrt(2))
    reached = 0.0
    for count in range(PROJECTIONS, 0, -1):
        reached += math.comb(PROJECTIONS, count) * hit**count * (1 - hit) ** (PROJECTIONS - count)
        if reached >= recall:
            return count
    return 0


def directions(size: int) -> np.ndarray:
    """The fixed random directions for vectors of a length; the first one sorts them into tiles."""
    return np.random.default_rng(20_000 + size).standard_normal((size, PROJECTIONS + 1))


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision, without overflow."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def links_between(a: np.ndarray, b: np.ndarray, cosine: float) -> np.ndarray:
    """Boolean matrix of the pairs that pass the collision count and have at least this cosine."""
    ways = directions(a.shape[1])[:, 1:]
    width = np.float32(WINDOW * math.sqrt(2 - 2 * cosine))
    one, two = (a @ ways).astype(np.float32).T, (b @ ways).astype(np.float32).T
    count = np.zeros((len(a), len(b)), dtype=np.uint8)
    rank = np.empty(len(b), dtype=np.uint16)
    for p in range(PROJECTIONS):
        order = np.argsort(two[p], kind="stable")  # the sorted projection, and each query's window in it
        lo = np.searchsorted(two[p], one[p] - width, side="left", sorter=order).astype(np.uint16)
        hi = np.searchsorted(two[p], one[p] + width, side="right", sorter=order).astype(np.uint16)
        rank[order] = np.arange(len(b), dtype=np.uint16)
        # lo <= rank < hi in one unsigned comparison: below lo the difference wraps around
        count += (rank - lo[:, None]) < (hi - lo)[:, None]
    passed = count >= least_collisions()
    if passed.mean() > 0.02:  # a block product decides what rounding can't; the sum of one pair decides all others
        dots = a @ b.T
        doubtful = passed & (np.abs(dots - cosine) <= _ROUNDING)
        passed &= dots >= cosine
    else:
        doubtful = passed
    rows, cols = np.nonzero(doubtful)
    passed[rows, cols] = np.einsum("ij,ij->i", a[rows], b[cols]) >= cosine
    return passed


def _linked(unit: tuple, nodes: np.ndarray, tiles: np.ndarray, groups: np.ndarray, weights: np.ndarray,
            vectors: np.ndarray, cosine: float) -> list[tuple]:
    """(node, other, links) rows of one unit: link counts have no other, spanning links have no count."""
    _, first, second = unit
    left = np.flatnonzero(tiles == first)
    right = left if first == second else np.flatnonzero(tiles == second)
    if not len(left) or not len(right):
        return []
    vectors = unit_rows(vectors)
    link = links_between(vectors[left], vectors[right], cosine) & (groups[left][:, None] == groups[right][None, :])
    if first == second:
        np.fill_diagonal(link, False)
    gain = np.zeros(len(nodes), dtype=np.int64)
    gain[left] += link @ weights[right]
    if first != second:
        gain[right] += link.T @ weights[left]
    out = [(int(nodes[k]), None, int(gain[k])) for k in np.flatnonzero(gain)]
    todo = gain > 0
    whole = np.zeros((len(nodes), len(nodes)), dtype=bool)
    whole[np.ix_(left, right)] = link
    whole |= whole.T
    for root in range(len(nodes)):
        if not todo[root]:
            continue
        todo[root], front = False, np.array([root])
        while len(front):
            front = np.flatnonzero(whole[front].any(axis=0) & todo)
            todo[front] = False
            out += [(int(nodes[k]), int(nodes[root]), None) for k in front]
    return out


def tile_links(units: DataFrame, cosine: float) -> DataFrame:
    """(node, other, links) over work units (size, first, second) of rows (node, tile, label, weight, embedding)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, rows = None, []

        def closed() -> pa.RecordBatch:
            out = []
            if rows:
                node, tile, label, weight, vector = zip(*rows, strict=True)
                out = _linked(unit, np.array(node), np.array(tile), np.array(label), np.array(weight),
                              np.array(vector, dtype=np.float64), cosine)
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(3)],
                                              names=["node", "other", "links"])

        for batch in batches:
            keys = zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)
            columns = [batch.column(k).to_pylist() for k in range(3, 7)]
            vectors = batch.column(7)
            for at, (key, node, tile, label, weight) in enumerate(zip(keys, *columns, strict=True)):
                if key != unit:
                    yield closed()
                    unit, rows = key, []
                rows.append((node, tile, label, weight, vectors[at].values.to_numpy(zero_copy_only=False)))
        yield closed()

    keys = ["size", "first", "second"]
    return (units.select(*keys, "node", "tile", "label", "weight", "embedding").repartition(*keys)
            .sortWithinPartitions(*keys).mapInArrow(run, "node long, other long, links long"))


def sort_keys(classes: DataFrame) -> DataFrame:
    """``classes`` with ``key``, the first projection of the unit vector."""
    names = classes.columns
    at = names.index("embedding")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [float((unit_rows(x.values.to_numpy(zero_copy_only=False).astype(np.float64)[None]) @ directions(len(x))[:, :1])[0, 0])
                    for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.float64())], names=[*names, "key"])

    return classes.mapInArrow(run, classes.withColumn("key", F.lit(0.0)).schema)


def near_duplicates(vectors: DataFrame, cosine: float = 0.93) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per row of ``vectors`` (vec_id, label, embedding).

    Vectors of one label and length are linked when their cosine is at least ``cosine``; a pair at the threshold is
    found with probability 0.9998, closer ones more surely. Null, empty, zero and non-finite vectors and vectors
    with a null label or vec_id link with nothing: n_links 0, component_id their own vec_id, kept. Rows that
    repeat a vec_id count as vectors of their own. Other columns are ignored; an empty table gives no rows.

    Equal vectors are one class with a weight, reduced map-side. Work grows with the pairs of tiles of a label.
    """
    work = Scratch(vectors.sparkSession, "embedding-dup")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = (F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
              & F.coalesce(~bad, F.lit(False)) & F.exists("embedding", lambda x: x != 0))
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding",
                          F.coalesce(usable, F.lit(False)).alias("usable"))
    rows = rows.withColumn("a", F.xxhash64("label", "embedding")).withColumn("b", F.xxhash64(F.lit(7), "embedding", "label"))
    classes = (rows.where("usable").groupBy("label", "a", "b")
               .agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("weight"), F.first("embedding").alias("embedding"))
               .withColumn("size", F.size("embedding")))
    keyed = work.write(sort_keys(classes), "keyed")  # the sort samples its input before it reads it
    placed = work.write(
        keyed.orderBy("size", "label", "key", "node").withColumn("mid", F.monotonically_increasing_id()),
        "sorted")
    work.drop("keyed")
    # positions from the partition sizes: a table with one row per partition of the sort
    parts = placed.groupBy(F.shiftright("mid", 33).alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = parts.select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    tiled = (placed.join(F.broadcast(before), F.shiftright("mid", 33) == F.col("part"))
             .withColumn("tile", F.floor((F.col("before") + F.col("mid").bitwiseAND((1 << 33) - 1)) / TILE).cast("long"))
             .select("size", "label", "node", "weight", "a", "b", "key", "tile", "embedding"))
    spans = work.write(tiled.groupBy("size", "label", "tile").agg(F.min("key").alias("lo"), F.max("key").alias("hi")), "spans")
    reach = WIDE * math.sqrt(2 - 2 * cosine)
    pairs = (spans.selectExpr("size", "label", "tile AS first", "hi AS top")
             .join(spans.selectExpr("size", "label", "tile AS second", "lo AS low"), ["size", "label"])
             .where((F.col("second") >= F.col("first")) & (F.col("low") <= F.col("top") + reach))
             .select("size", "first", "second").distinct())
    units = tiled.select("size", "label", "node", "weight", "tile", "embedding").join(
        pairs.select("size", "first", "second", F.explode(F.array_distinct(F.array("first", "second"))).alias("tile")),
        ["size", "tile"])
    found = work.write(tile_links(units, cosine), "links")
    work.drop("spans")
    sums = found.where("other IS NULL").groupBy("node").agg(F.sum("links").alias("others"))
    labels = connected_components(found.where("other IS NOT NULL").selectExpr("node AS a", "other AS b"), work, "components")
    named = (placed.select("label", "a", "b", "node", "weight").join(sums, "node", "left").join(labels, "node", "left")
             .select("label", "a", "b", (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n"),
                     F.coalesce("component", "node").alias("c")))
    return (rows.select("vec_id", F.when(F.col("usable"), F.col("label")).alias("label"), "a", "b")
            .join(named, ["label", "a", "b"], "left")
            .select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("c", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
