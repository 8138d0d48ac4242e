"""Models from additive sums (M4, M9-M12): one pass over the rows gives Gram matrices, everything else is arithmetic on those.

``gram`` adds up the products of all columns of a row, by fold. Each task adds its own rows and sends one vector for each
column and fold; those are added by an aggregation. A fit with other penalties, or without one of the folds, needs the sums
only. Kernel features are made inside the task that adds them up, so they are never columns or rows of a table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A column whose standard deviation is smaller in relation to its mean is constant up to rounding.
CONSTANT = 1e-9
_SWEEPS, _SETTLED = 100_000, 1e-13


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def gram(df: DataFrame, values: Column, fold: Column, expand: Callable[[np.ndarray], np.ndarray] = lambda x: x) -> dict[int, np.ndarray]:
    """{fold: sum over its rows of z zᵀ} with z = ``expand`` of the row's ``values`` (array<double>).

    Rows with a null, NaN or infinite value, or without a fold, are left out. A task holds one matrix a fold; the size of the result is
    set by the number of columns and folds, not by the rows.
    """
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = df.select(fold.cast("int").alias("fold"), values.cast("array<double>").alias("x")) \
        .where(F.col("fold").isNotNull() & F.coalesce(~bad, F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            folds, z = batch.column(0).to_numpy(), expand(_matrix(batch.column(1)))
            for k in np.unique(folds).tolist():
                part = z[folds == k]
                sums[k] = sums.get(k, 0) + part.T @ part
        for k, total in sums.items():
            size = len(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] * size, pa.int32()), pa.array(range(size), pa.int32()),
                 pa.ListArray.from_arrays(pa.array(np.arange(size + 1) * size, pa.int32()), pa.array(total.ravel()))],
                names=["fold", "line", "sums"])

    lines = rows.mapInArrow(run, "fold int, line int, sums array<double>")
    total = lines.groupBy("fold", "line").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums"))
    out: dict[int, list] = {}
    for k, line, sums in total.toLocalIterator():
        out.setdefault(k, []).append((line, sums))
    return {k: np.array([sums for _, sums in sorted(found)]) for k, found in out.items()}


def elastic_net(sums: np.ndarray, reg: float, elastic: float) -> tuple[float, np.ndarray]:
    """(intercept, coefficients) from the sums of z = (1, features, target).

    Least of mean squared error / 2 + reg * (elastic * sum |b| + (1 - elastic) / 2 * sum b²) over coefficients b of features scaled
    to standard deviation 1. Constant features have coefficient 0. Coordinate descent, which ends when no coefficient moves.
    """
    n = sums[0, 0]
    mean = sums[0] / n
    cov = sums / n - np.outer(mean, mean)
    std = np.sqrt(np.maximum(np.diag(cov), 0))[1:-1]
    used = std > CONSTANT * np.maximum(1, np.abs(mean[1:-1]))
    scale = np.where(used, std, 1)
    a, c = cov[1:-1, 1:-1] / np.outer(scale, scale), cov[1:-1, -1] / scale
    b = np.zeros(len(c))
    for _ in range(_SWEEPS):
        moved = 0.0
        for j in np.flatnonzero(used):
            pull = c[j] - a[j] @ b + a[j, j] * b[j]
            new = np.sign(pull) * max(abs(pull) - reg * elastic, 0) / (a[j, j] + reg * (1 - elastic))
            moved, b[j] = max(moved, abs(new - b[j])), new
        if moved <= _SETTLED * max(1.0, np.abs(b).max(initial=0)):
            break
    b = b / scale
    return float(mean[-1] - b @ mean[1:-1]), b


def squared_error(sums: np.ndarray, intercept: float, b: np.ndarray) -> float:
    """Sum of squared errors on the rows behind ``sums``."""
    w = np.concatenate([[intercept], b, [-1.0]])
    return max(0.0, float(w @ sums @ w))


def kfold_losses(df: DataFrame, features: list[str], label: str, fold_col: str, trials: list[dict]) -> DataFrame:
    """M9: (trial, reg, elastic, fold, rmse): the loss of each trial on each fold, fitted on the other folds.

    One pass over ``df`` for all trials and folds; the fits run side by side in one further job over the trials.
    """
    spark = df.sparkSession
    sums = gram(df, F.array(F.lit(1.0), *(F.col(f).cast("double") for f in features), F.col(label).cast("double")), F.col(fold_col))
    shared = spark.sparkContext.broadcast(sums)
    kind = "trial int, reg double, elastic double, fold int, rmse double"
    table = spark.createDataFrame([(n, float(t["reg"]), float(t["elastic"])) for n, t in enumerate(trials)],
                                  "trial int, reg double, elastic double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = shared.value
        for batch in batches:
            out = []
            for trial, reg, elastic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for fold in sorted(sums):
                    rest = sum((s for k, s in sums.items() if k != fold), np.zeros_like(sums[fold]))
                    if rest[0, 0]:
                        error = squared_error(sums[fold], *elastic_net(rest, reg, elastic))
                        out.append((trial, reg, elastic, fold, (error / sums[fold][0, 0]) ** 0.5))
            columns = zip(*out, strict=True) if out else ([],) * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.float64()), strict=True)],
                names=["trial", "reg", "elastic", "fold", "rmse"])

    return table.mapInArrow(run, kind)


def median_pruning(losses: DataFrame) -> DataFrame:
    """``losses`` (trial, ..., fold, rmse) with ``pruned``, without the folds behind a trial's first pruned one.

    Trials run in order, each fold by fold; a trial is pruned on a fold when its loss is above the median of what earlier trials
    had there. The table has a row per trial and fold, as many as were asked for, and is walked by one task.
    """
    names = losses.columns
    trial, fold, rmse = (names.index(c) for c in ("trial", "fold", "rmse"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        schema_out = table.schema.append(pa.field("pruned", pa.bool_()))
        seen: dict[int, list[float]] = {}
        kept, over = [], set()
        for row in sorted(zip(*(c.to_pylist() for c in table.columns), strict=True), key=lambda r: (r[trial], r[fold])):
            if row[trial] in over:
                continue
            before = seen.setdefault(row[fold], [])
            pruned = bool(before) and row[rmse] > float(np.median(before))
            before.append(row[rmse])
            kept.append((*row, pruned))
            if pruned:
                over.add(row[trial])
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*kept, strict=True), schema_out, strict=True)], schema=schema_out)

    return losses.coalesce(1).mapInArrow(run, losses.withColumn("pruned", F.lit(False)).schema)


# ------------------------------------------------------------ kernel models
def radial(vectors: np.ndarray, centres: np.ndarray, gamma: float) -> np.ndarray:
    """exp(-gamma * squared distance) of every vector to every centre."""
    square = (vectors * vectors).sum(1)[:, None] + (centres * centres).sum(1)[None, :] - 2 * vectors @ centres.T
    return np.exp(-gamma * np.maximum(square, 0))


def _score(df: DataFrame, id_cols: list[str], vec_col: str, score: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``df`` (id columns, ..., vector) with ``score`` of each vector."""
    kept = df.select(*id_cols, F.col(vec_col).cast("array<double>").alias("_v"))
    schema = kept.drop("_v").withColumn("score", F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = score(_matrix(batch.column(len(id_cols))))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found)], names=[*id_cols, "score"])

    return kept.mapInArrow(run, schema)


def radial_network(train: DataFrame, vec_col: str, label: str, centres: np.ndarray, gamma: float, ridge: float = 1e-9) -> np.ndarray:
    """Weights of the radial features of ``centres`` by least squares, without intercept.

    The normal equations are added up by the tasks and solved by Cholesky on the driver, with ``ridge`` times the rows on the
    diagonal (tenfold until the matrix is positive definite). The centres are as many as the caller asks for; thousands are fine.
    """
    shared = train.sparkSession.sparkContext.broadcast(centres)
    sums = gram(train, F.concat(F.col(vec_col).cast("array<double>"), F.array(F.col(label).cast("double"))), F.lit(0),
                lambda z: np.hstack([radial(z[:, :-1], shared.value, gamma), z[:, -1:]]))
    if not sums:
        return np.zeros(len(centres))
    n = train.count()
    a, c = sums[0][:-1, :-1], sums[0][:-1, -1]
    while True:
        try:
            lower = np.linalg.cholesky(a + ridge * n * np.eye(len(a)))
            break
        except np.linalg.LinAlgError:
            ridge *= 10
    return np.linalg.solve(lower.T, np.linalg.solve(lower, c))


def radial_scores(df: DataFrame, id_cols: list[str], vec_col: str, centres: np.ndarray, gamma: float, weights: np.ndarray) -> DataFrame:
    """(id columns, score) of the radial network."""
    shared = df.sparkSession.sparkContext.broadcast((centres, weights))
    return _score(df, id_cols, vec_col, lambda v: radial(v, shared.value[0], gamma) @ shared.value[1])


def scale_gamma(df: DataFrame, vec_col: str) -> float:
    """1 / (length of the vectors * variance of all their components)."""
    flat = df.select(F.size(vec_col).alias("d"), F.explode(F.col(vec_col).cast("array<double>")).alias("v"))
    d, variance = flat.agg(F.max("d"), F.var_pop("v")).first()
    return 1.0 / (d * variance) if variance else 1.0


class Nystroem:
    """Features whose dot products approximate the radial kernel: its values at landmarks times their kernel matrix to the power
    -1/2. As many features as the kernel matrix has eigenvalues that rounding does not hide."""

    def __init__(self, landmarks: np.ndarray, gamma: float):
        self.landmarks, self.gamma = landmarks, gamma
        values, vectors = np.linalg.eigh(radial(landmarks, landmarks, gamma))
        good = values > len(landmarks) * np.finfo(float).eps * max(values.max(initial=0), 1e-300)
        self.map = vectors[:, good] / np.sqrt(values[good])

    def __call__(self, vectors: np.ndarray) -> np.ndarray:
        return radial(vectors, self.landmarks, self.gamma) @ self.map

    def transform(self, spark: SparkSession, df: DataFrame, keep: list[str], vec_col: str, out: str = "_x") -> DataFrame:
        """(keep, out): the features as an ML vector."""
        shared = spark.sparkContext.broadcast(self)
        kept = df.select(*keep, F.col(vec_col).cast("array<double>").alias(out))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    z = shared.value(_matrix(batch.column(len(keep))))
                    ends = pa.array(np.arange(len(z) + 1) * z.shape[1], pa.int32())
                    yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.ListArray.from_arrays(ends, pa.array(z.ravel()))],
                                                     names=[*keep, out])

        return kept.mapInArrow(run, kept.schema).withColumn(out, array_to_vector(out))
