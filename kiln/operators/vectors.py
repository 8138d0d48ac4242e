"""Vector analytics (V1, V4-V7, A20-A21, A23, X5-X7, M11 features).

* Centroids are a map-side-combined aggregation per (label, dimension).
* RBF features and nearest centroid attach the centre set (as many centres as
  the caller asks for, or one per class) as one row and evaluate per vector
  with array expressions.
* The cosine similarity join is exact: vectors are dealt to tiles within the
  cells of a metric partition, tiles that the triangle inequality does not
  part are multiplied with numpy, and only pairs at or above the threshold
  become rows. No task ever holds more than two tiles. Tiles grow until a
  vector goes to a fixed number of them, so the shuffle grows with the rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.functions.hashing import hash32
from kiln.lineage import Scratch


def as_double_array(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("array<double>")


def row_mean(c: Column | str) -> Column:
    """Mean of the elements of an array; NULL for an empty one."""
    a = as_double_array(c)
    return F.try_divide(F.aggregate(a, F.lit(0.0), lambda s, x: s + x), F.size(a))


def sq_dist(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def centroids_long(df: DataFrame, vec_col: str, label_col: str) -> DataFrame:
    """(label, dim, mean) — partial aggregation before the shuffle."""
    return (df.select(F.col(label_col).alias("label"), F.posexplode(as_double_array(vec_col)).alias("dim", "v"))
            .groupBy("label", "dim").agg(F.avg("v").alias("mean")))


def centroid_vectors(df: DataFrame, vec_col: str, label_col: str) -> DataFrame:
    """(label, centre ARRAY<DOUBLE>) ordered by dimension."""
    long = centroids_long(df, vec_col, label_col)
    return long.groupBy("label").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("dim", "mean"))), lambda x: x["mean"]).alias("centre"))


def centre_row(centres: DataFrame) -> DataFrame:
    """All centres as one row ``_centres ARRAY<STRUCT<label, centre>>``, ordered by label."""
    return centres.agg(F.array_sort(F.collect_list(F.struct("label", "centre"))).alias("_centres"))


def dmax_sigma(centres: DataFrame) -> DataFrame:
    """Largest distance between two centres and sigma = dmax / sqrt(2 m)."""
    row = centre_row(centres)
    pairs = row.select(F.explode("_centres").alias("a"), "_centres").select(
        "a", F.explode("_centres").alias("b"))
    d = pairs.select(F.sqrt(sq_dist(F.col("a.centre"), F.col("b.centre"))).alias("d"))
    m = row.select(F.size("_centres").alias("m"))
    return d.agg(F.max("d").alias("dmax")).crossJoin(m).select(
        "dmax", (F.col("dmax") / F.sqrt(2 * F.col("m"))).alias("sigma"), F.col("m").alias("n_centres"))


def rbf_features(df: DataFrame, id_col: str, vec_col: str, centres: DataFrame,
                 sigma: DataFrame) -> DataFrame:
    """V6 + X5 in long form: (id, centre_label, phi = exp(-d^2 / (2 sigma^2)))."""
    j = df.select(id_col, as_double_array(vec_col).alias("_x")) \
        .crossJoin(centre_row(centres)).crossJoin(sigma.select("sigma"))
    phis = F.transform("_centres", lambda c: F.struct(
        c["label"].alias("centre_label"),
        F.exp(-sq_dist(F.col("_x"), c["centre"]) / (2 * F.col("sigma") * F.col("sigma"))).alias("phi")))
    return j.select(id_col, F.explode(phis).alias("f")).select(id_col, "f.centre_label", "f.phi")


def nearest_centre(df: DataFrame, id_col: str, vec_col: str, centres: DataFrame,
                   out: str = "predicted") -> DataFrame:
    """V7: label of the closest centre (ties: smallest label)."""
    j = df.crossJoin(centre_row(centres)).withColumn("_x", as_double_array(vec_col))
    best = F.array_min(F.transform("_centres", lambda c: F.struct(
        sq_dist(F.col("_x"), c["centre"]).alias("d"), c["label"].alias("label"))))
    return j.withColumn(out, best["label"]).drop("_centres", "_x")


# ------------------------------------------------------------ similarity join
#: Vectors of a tile on average at least, pivots at most, and vectors drawn (by hash) to choose the pivots from.
TILE_ROWS, MOST_PIVOTS, PIVOT_SAMPLE = 512, 1024, 4096
#: Tiles that a vector goes to, bytes of a tile, and products that a task holds at a time.
MOST_COPIES, TILE_BYTES, BLOCK = 24, 64 << 20, 1 << 21
#: Angles are rounded; the bounds of the triangle inequality are widened by this much.
_SLACK = 1e-6
_PAIRS = "i long, j long, sim double"


def _angles(vectors: np.ndarray, pivots: np.ndarray, absolute: bool) -> np.ndarray:
    """Angles between vectors and unit pivots; of the lines they span with ``absolute``. Both are metrics."""
    cos = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)) @ pivots.T
    return np.arccos(np.clip(np.abs(cos) if absolute else cos, -1, 1))


def spread_pivots(vectors: np.ndarray, count: int, absolute: bool) -> np.ndarray:
    """``count`` unit vectors, each the one furthest from those before it, until all others coincide with one."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    chosen, far = [0], _angles(unit, unit[:1], absolute)[:, 0]
    while len(chosen) < count and far.max() > 1e-7:
        chosen.append(int(np.argmax(far)))
        far = np.minimum(far, _angles(unit, unit[chosen[-1:]], absolute)[:, 0])
    return unit[chosen]


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def _layout(drawn: np.ndarray, n: int, reach: float, absolute: bool) -> tuple[int, np.ndarray]:
    """(vectors of a tile, pivots) for ``n`` vectors: the smallest tiles for which one of the ``drawn`` vectors goes to at most
    ``MOST_COPIES`` of them, as far as the drawn ones tell; if the cells part nothing, an equal share of all vectors."""
    all_pivots = spread_pivots(drawn, min(MOST_PIVOTS, -(-n // TILE_ROWS)), absolute)
    angles, most = _angles(drawn, all_pivots, absolute), max(TILE_ROWS, TILE_BYTES // (8 * drawn.shape[1]))
    rows, least_rows = TILE_ROWS, min(most, -(-n // MOST_COPIES))
    while rows < least_rows:
        part = angles[:, :min(len(all_pivots), -(-n // rows))]
        cell, least = part.argmin(axis=1), part.min(axis=1)
        low, high, held = np.full(part.shape[1], np.inf), np.full(part.shape[1], -np.inf), np.bincount(cell, minlength=part.shape[1])
        np.minimum.at(low, cell, least)
        np.maximum.at(high, cell, least)
        tiles = np.ceil(held * (n / len(drawn)) / rows)
        if (((part <= high + reach) & (part >= low - reach)) @ tiles).mean() <= MOST_COPIES:
            return rows, all_pivots[:-(-n // rows)]
        rows *= 2
    if TILE_ROWS < least_rows < most:
        return least_rows, all_pivots[:1]
    return min(rows, most), all_pivots[:-(-n // min(rows, most))]


def _tile_units(df: DataFrame, id_col: str, vec_col: str, threshold: float, absolute: bool, tile_rows: int | None, work: Scratch):
    """(units, tiles by cell): rows (id, v, tile, first, second) of the tile pairs that may hold a pair at the threshold."""
    v = as_double_array(vec_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = work.write(df.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
                      .where(F.col("id").isNotNull() & F.coalesce(~bad, F.lit(False)) & F.exists(v, lambda x: x != 0)), "vectors")
    n = rows.count()
    drawn = rows.select("v").orderBy(hash32(F.col("id"), "pivots"), "id").limit(PIVOT_SAMPLE).toArrow()["v"]
    shared = rows.sparkSession.sparkContext.broadcast
    if n == 0:
        return rows.select("id", "v", *(F.lit(0).cast("long").alias(c) for c in ("tile", "first", "second"))), []
    reach = math.acos(min(1.0, max(-1.0, threshold))) + _SLACK
    if tile_rows is None:
        tile_rows, chosen = _layout(_matrix(drawn), n, reach, absolute)
    else:
        chosen = spread_pivots(_matrix(drawn), min(MOST_PIVOTS, -(-n // tile_rows)), absolute)
    pivots = shared(chosen)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            angles = _angles(_matrix(batch.column(1)), pivots.value, absolute)
            cell = angles.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()), pa.array(angles.min(axis=1))],
                                             names=["id", "v", "cell", "angle"])

    cells = work.write(rows.mapInArrow(assign, "id long, v array<double>, cell int, angle double"), "cells")
    work.drop("vectors")
    found = sorted(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("angle").alias("low"), F.max("angle").alias("high"))
                   .toLocalIterator())  # a row per pivot
    number, tiles = np.array([c.cell for c in found]), np.array([-(-c.n // tile_rows) for c in found])
    low, high = np.array([c.low for c in found]), np.array([c.high for c in found])
    base = np.cumsum(tiles) - tiles
    layout = shared((number, tiles, base, low, high))
    total = int(tiles.sum())

    def partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, tiles, base, low, high = layout.value
        owner = np.repeat(np.arange(len(number)), tiles)  # the cell of each tile
        for batch in batches:
            angles = _angles(_matrix(batch.column(1)), pivots.value[number], absolute)
            near = (angles <= high + reach) & (angles >= low - reach)
            at = np.searchsorted(number, batch.column(2).to_numpy())
            near[np.arange(len(at)), at] = True
            tile = base[at] + batch.column(4).to_numpy() % tiles[at]
            row, other = np.nonzero(near[:, owner])
            unit = np.minimum(tile[row], other) * total + np.maximum(tile[row], other)
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(tile)))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(tile, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(unit, pa.int64()))], names=["id", "v", "tile", "units"])

    dealt = (cells.withColumn("deal", hash32(F.col("id"), "tile").cast("long"))
             .mapInArrow(partners, "id long, v array<double>, tile long, units array<long>")
             .select("id", "v", "tile", F.explode("units").alias("unit"))
             .select("id", "v", "tile", F.floor(F.col("unit") / total).alias("first"), (F.col("unit") % total).alias("second")))
    return dealt, tiles.tolist()


def cosine_pairs(df: DataFrame, id_col: str, vec_col: str, threshold: float,
                 absolute: bool = True, tile_rows: int | None = None) -> DataFrame:
    """V1 + J7 + X7: (i, j, sim), all pairs i < j with (|)cos(|) >= threshold, exactly, for vectors of one length.

    Vectors belong to the cell of their nearest pivot. A vector meets another cell only if its angle to that cell's pivot is
    within the cell's range of angles, widened by the angle of the threshold: by the triangle inequality no other vector can
    have a partner there. Cells are dealt into tiles of ``tile_rows`` on average, and a task multiplies two tiles, some rows at a
    time. Without ``tile_rows`` tiles are as large as it takes for a vector to go to about ``MOST_COPIES`` of them (``_layout``): the
    shuffle then grows with the rows, up to tiles of ``TILE_BYTES``. Products follow the clusters in the data; where nothing can be
    pruned they are those of all pairs, n^2 / 2. Null, zero and non-finite vectors and rows without id are in no pair; a vector
    twice in the input is in two rows.
    """
    units, _ = _tile_units(df, id_col, vec_col, threshold, absolute, tile_rows, Scratch(df.sparkSession, "cosine-pairs"))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = pa.Table.from_batches(batches)
        tile, first, second = (unit[c].to_numpy() for c in ("tile", "first", "second"))
        ids, vectors = unit["id"].to_numpy(), _matrix(unit["v"])
        other = np.flatnonzero(tile == second[0])
        width, same = max(1, BLOCK // max(1, len(other))), first[0] == second[0]
        right, lengths = np.ascontiguousarray(vectors[other].T), np.einsum("ij,ij->i", vectors, vectors)
        whole = np.flatnonzero(tile == first[0])
        for at in range(0, len(whole), width):
            a = whole[at:at + width]
            sim = vectors[a] @ right
            sim /= np.sqrt(np.outer(lengths[a], lengths[other]))
            if absolute:
                np.abs(sim, out=sim)
            row, col = np.nonzero(sim >= threshold)
            i, j, w = ids[a[row]], ids[other[col]], sim[row, col]
            found = i < j if same else i != j
            i, j, w = i[found], j[found], w[found]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(i, j)), pa.array(np.maximum(i, j)), pa.array(w)], names=["i", "j", "sim"])

    return units.groupBy("first", "second").applyInArrow(pairs, _PAIRS)


def cosine_join_report(df: DataFrame, id_col: str, vec_col: str, threshold: float,
                       absolute: bool = True, tile_rows: int | None = None) -> DataFrame:
    """One row: vectors, tile pairs and products of all pairs, and how many of both ``cosine_pairs`` looks at."""
    units, tiles = _tile_units(df, id_col, vec_col, threshold, absolute, tile_rows, Scratch(df.sparkSession, "cosine-report"))
    own, other = F.col("tile") == F.col("first"), F.col("tile") == F.col("second")
    sizes = units.groupBy("first", "second").agg(F.sum(own.cast("long")).alias("a"), F.sum(other.cast("long")).alias("b"))
    same = F.col("first") == F.col("second")
    met = sizes.where((F.col("a") > 0) & (F.col("b") > 0))
    n, count = F.sum(F.when(same, F.col("a"))), sum(tiles)
    return met.agg(
        F.coalesce(n, F.lit(0)).alias("vectors"), F.lit(len(tiles)).alias("cells"), F.lit(count * (count + 1) // 2).alias("tile_pairs"),
        F.count(F.lit(1)).alias("tile_pairs_met"), F.coalesce(n * (n - 1) / 2, F.lit(0)).cast("long").alias("products"),
        F.coalesce(F.sum(F.when(same, F.col("a") * (F.col("a") - 1) / 2).otherwise(F.col("a") * F.col("b"))), F.lit(0))
        .cast("long").alias("products_met"))
