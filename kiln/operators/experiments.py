"""Experiment-grid reporting.

Result tables are small (one row per configuration or epoch); the heavy
work is the Spark jobs that produce each row.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.operators.naive_bayes import cell_predictions, cleaned_tokens


def size_label(c) -> F.Column:
    """'10%' style label of a fraction (A25 row label)."""
    return F.concat((F.col(c) * 100).cast("int").cast("string"), F.lit("%"))


def pivot_metric(results: DataFrame, index: str, columns: str, value: str, values: list) -> DataFrame:
    """One row per index value, one column per known column value."""
    return results.groupBy(index).pivot(columns, values).agg(F.first(value))


def baseline_delta(results: DataFrame, keys: list[str], variant: str, metric: str,
                   baseline: str = "baseline") -> DataFrame:
    """Metric minus the baseline's metric for the same keys."""
    w = Window.partitionBy(*keys)
    base = F.max(F.when(F.col(variant) == baseline, F.col(metric))).over(w)
    return results.withColumn(f"{metric}_delta", F.col(metric) - base)


def group_mean(results: DataFrame, keys: list[str], metric: str) -> DataFrame:
    """Mean metric per key group (what the bar charts plot)."""
    return results.groupBy(*keys).agg(F.avg(metric).alias(f"mean_{metric}"))


def best_trial(trials: DataFrame, group: list[str], trial_col: str, metric: str, params: list[str]) -> DataFrame:
    """The best trial per group; the earliest wins ties."""
    best = F.max_by(F.struct(*params, F.col(trial_col)), F.struct(F.col(metric), -F.col(trial_col)))
    return trials.groupBy(*group).agg(best.alias("_b"), F.max(metric).alias(f"best_{metric}")) \
        .select(*group, "_b.*", f"best_{metric}")


def early_stop(history: DataFrame, run_col: str, epoch_col: str, metric: str, patience: int = 3,
               higher_is_better: bool = True) -> DataFrame:
    """Running best, epochs since strict improvement, and the stop
    epoch (first epoch whose counter reaches ``patience``; else the last)."""
    w = Window.partitionBy(run_col).orderBy(epoch_col)
    prev_best = (F.max if higher_is_better else F.min)(metric).over(
        w.rowsBetween(Window.unboundedPreceding, -1))
    improved = F.when(prev_best.isNull(), True).otherwise(
        (F.col(metric) > prev_best) if higher_is_better else (F.col(metric) < prev_best))
    h = history.withColumn("improved", improved)
    # gaps and islands: epochs since the last improvement
    h = h.withColumn("_grp", F.sum(F.col("improved").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    h = h.withColumn("since_best", F.row_number().over(Window.partitionBy(run_col, "_grp").orderBy(epoch_col)) - 1)
    h = h.withColumn("running_best", (F.max if higher_is_better else F.min)(metric).over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    stop = F.min(F.when(F.col("since_best") >= patience, F.col(epoch_col))).over(Window.partitionBy(run_col))
    last = F.max(epoch_col).over(Window.partitionBy(run_col))
    return h.withColumn("stop_epoch", F.coalesce(stop, last)).drop("_grp")


def pad_last(history: DataFrame, run_col: str, epoch_col: str, cols: list[str]) -> DataFrame:
    """Fill missing values with the last seen value of the run."""
    w = Window.partitionBy(run_col).orderBy(epoch_col).rowsBetween(Window.unboundedPreceding, 0)
    for c in cols:
        history = history.withColumn(c, F.last(c, ignorenulls=True).over(w))
    return history


def block_means(history: DataFrame, iter_col: str, value: str, every: int) -> DataFrame:
    """(block, mean) over consecutive blocks of ``every`` iterations (numbered from 1), full blocks only."""
    block = F.floor((F.col(iter_col) - 1) / every).cast("int").alias("block")
    return (history.groupBy(block).agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") == every).drop("_n"))


def model_comparison(results: DataFrame, model_col: str, metrics: list[str]) -> DataFrame:
    """One row per model with every metric, a missing one as 0, ordered by model."""
    return results.select(model_col, *[F.coalesce(F.col(m), F.lit(0.0)).alias(m) for m in metrics]).orderBy(model_col)


def statistics_document(one_row: DataFrame, out: str = "stats") -> DataFrame:
    """A row of statistics as one JSON document."""
    return one_row.select(F.to_json(F.struct(*one_row.columns)).alias(out))


def round_down(c, multiple) -> F.Column:
    """The largest multiple not above a value (e.g. an embedding size that the heads divide)."""
    c, m = (F.col(c) if isinstance(c, str) else c), (F.col(multiple) if isinstance(multiple, str) else F.lit(multiple))
    return (F.floor(c / m) * m).cast("long")


def timed(df: DataFrame) -> tuple[float, float]:
    """(seconds, seconds per row) to compute every row of ``df``, counted in the same run."""
    _, took, each = _timed(df)
    return took, each


def _timed(df: DataFrame) -> tuple[int, float, float]:
    # a sum of hashes needs every column of every row; maps, which have no hash, are taken as their entries
    values = [F.map_entries(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`") for f in df.schema]
    began = time.perf_counter()
    rows, _ = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*values) % 1024)).first()
    took = time.perf_counter() - began
    return rows, took, took / max(1, rows)


def timing_report(models: dict[str, DataFrame]) -> DataFrame:
    """(model, n_rows, seconds, seconds_per_row): wall-clock and per-sample time of each model's predictions."""
    spark = next(iter(models.values())).sparkSession
    return spark.createDataFrame([(name, *_timed(df)) for name, df in models.items()],
                                 "model string, n_rows long, seconds double, seconds_per_row double")


def naive_bayes_grid(texts: DataFrame, val: DataFrame, configs: DataFrame, cells: int, alpha: float) -> DataFrame:
    """Predictions (config, doc_id, label, prediction) of one Naive Bayes fit per configuration, in one set of jobs.

    ``texts`` (cell, label, text) are the training texts, each in one of ``cells`` disjoint cells (e.g. text variant by size
    band); ``configs`` (config, members array<int>) says which cells a configuration trains on; ``val`` is
    (doc_id, label, text). Counts are kept per term and cell, and added up per configuration only where a validation text
    has the term. Variants of a text that follow each other are counted together.
    """
    return cell_predictions(texts, val, configs, cells, "doc_id", "text", "label", cleaned_tokens("text"), alpha) \
        .select("config", "doc_id", "label", "prediction")
