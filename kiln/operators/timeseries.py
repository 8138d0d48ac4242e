"""Time-series operators.

Series that are aggregated to calendar steps (days, 5-minute slots of one
day) are bounded by the time span, not by the data volume, so ordering them
with a plain window is fine. Per-entity series (users, vehicles) are always
partitioned by the entity.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.lineage import Scratch
from kiln.operators.common import attach_row, global_index

#: Positions of a series that one window of ``lag_windows`` holds.
BLOCK_ROWS = 65536


def floor_minutes(ts: Column | str, minutes: int) -> Column:
    """Epoch-aligned bucket start (UTC)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    step = minutes * 60
    return F.timestamp_seconds(F.floor(F.unix_seconds(c) / step) * step)


def regular_grid(start: Column, end: Column, minutes: int = 5) -> Column:
    """Every ``minutes`` from start to end inclusive (an array)."""
    return F.sequence(start, end, F.expr(f"INTERVAL {minutes} MINUTES"))


def zero_filled(counts: DataFrame, ts_col: str, minutes: int, value_cols: list[str]) -> DataFrame:
    """N5 + A1: dense grid from min to max slot, left-joined with the slot
    aggregates; empty slots get 0."""
    bounds = counts.agg(F.min(ts_col).alias("_a"), F.max(ts_col).alias("_b"))
    grid = bounds.select(F.explode(regular_grid(F.col("_a"), F.col("_b"), minutes)).alias(ts_col))
    out = grid.join(counts, ts_col, "left")
    return out.na.fill(0, value_cols)


def last_window(df: DataFrame, ts_col: str, hours: int = 24) -> DataFrame:
    """Rows within ``hours`` before the maximum time (inclusive). The
    maximum is read first, so the bound is a literal that prunes the scan."""
    last = df.agg(F.unix_micros(F.max(ts_col)).alias("us")).first().us
    if last is None:
        return df.limit(0)
    return df.filter(F.col(ts_col) >= F.timestamp_micros(F.lit(last - hours * 3_600_000_000)))


def chrono_split(series: DataFrame, ts_col: str, train_frac: float = 0.8,
                 out: str = "split") -> DataFrame:
    """First floor(n * train_frac) rows in time order are 'train'."""
    ranked = global_index(series, [ts_col], out="_rn")
    n = ranked.agg(F.count(F.lit(1)).alias("_n"))
    return (attach_row(ranked, n)
            .withColumn(out, F.when(F.col("_rn") <= F.floor(F.col("_n") * F.lit(train_frac)), "train")
                        .otherwise("test"))
            .drop("_rn", "_n"))


def minmax_fit(df: DataFrame, col: str) -> DataFrame:
    """A8 fit: one row (min, max)."""
    return df.agg(F.min(col).alias("_min"), F.max(col).alias("_max"))


def minmax_apply(df: DataFrame, col: str, fit: DataFrame, out: str = "scaled") -> DataFrame:
    """A8 transform; a zero range maps to 0 (scale 1, as scikit-learn)."""
    rng = F.col("_max") - F.col("_min")
    scaled = (F.col(col) - F.col("_min")) / F.when(rng == 0, F.lit(1.0)).otherwise(rng)
    return attach_row(df, fit).withColumn(out, scaled).drop("_min", "_max")


def minmax_inverse(df: DataFrame, col: str, fit: DataFrame, out: str = "unscaled") -> DataFrame:
    rng = F.col("_max") - F.col("_min")
    return (attach_row(df, fit).withColumn(out, F.col(col) * F.when(rng == 0, 1.0).otherwise(rng)
                                           + F.col("_min")).drop("_min", "_max"))


def lag_windows(series: DataFrame, part_cols: list[str], ts_col: str, value_col: str,
                look_back: int = 25, drop_last: bool = True) -> DataFrame:
    """N3 in long form: (*part, ts (target time), target, lag, value).
    ``part_cols`` must be non-empty (use a constant column for one series).

    Sample i uses values i..i+look_back-1 as features and i+look_back as the
    target. With ``drop_last`` the final possible sample is left out, as the
    reference does (len - look_back - 1 samples). Positions come from one
    distributed order, not from a window per series. A series is cut into
    blocks of positions, each with the ``look_back`` rows before it, so that
    a long series is many windows and its rows are shuffled about once. Part
    columns must not be NULL.
    """
    written = Scratch(series.sparkSession, "lag-windows").write(series.select(*part_cols, ts_col, value_col), "series")
    ranked = global_index(written, [*part_cols, ts_col], out="_idx")
    parts = ranked.groupBy(*part_cols).agg(F.min("_idx").alias("_first"), F.count(F.lit(1)).alias("_n"))
    pos = ranked.join(parts, part_cols).withColumn("_pos", F.col("_idx") - F.col("_first")).drop("_idx", "_first")
    rows = max(BLOCK_ROWS, look_back)
    own = F.floor(F.col("_pos") / rows)
    blocks = pos.withColumn("_own", own).withColumn("_block", F.explode(
        F.when(F.col("_pos") % rows >= rows - look_back, F.array(own, own + 1)).otherwise(F.array(own))))
    before = Window.partitionBy(*part_cols, "_block").orderBy("_pos").rowsBetween(-look_back, -1)
    last = F.col("_n") - (1 if drop_last else 0)
    samples = (blocks.withColumn("_past", F.reverse(F.collect_list(F.struct(F.col(value_col).alias("value"))).over(before)))
               .where((F.col("_own") == F.col("_block")) & (F.col("_pos") >= look_back) & (F.col("_pos") < last)))
    return samples.select(*part_cols, ts_col, F.col(value_col).alias("target"), F.posexplode("_past").alias("_k", "_f")) \
        .select(*part_cols, ts_col, "target", (F.col("_k") + 1).alias("lag"), "_f.value")


def rolling_mean_sparse(df: DataFrame, key_cols: list[str], ts_col: str, value_col: str,
                        grid_start: Column, grid_end: Column, step_minutes: int = 5, rows: int = 3,
                        out: str = "smoothed") -> DataFrame:
    """N1 on a dense regular grid without building the dense grid.

    rolling(rows, min_periods=1).mean() over a grid from ``grid_start`` to
    ``grid_end`` (literals) where absent points are 0: each observed value
    contributes to its own point and the next ``rows - 1`` points; the
    divisor is min(rows, index + 1), index being the position on the grid.
    Only points with a contribution are returned (all others are 0). The
    exact window sum and row count are kept next to the mean.
    """
    step = step_minutes * 60
    shifted = df.select(*key_cols, F.col(value_col).alias("_v"),
                        F.explode(F.sequence(F.lit(0), F.lit(rows - 1))).alias("_k"),
                        F.col(ts_col).alias("_t0"))
    shifted = shifted.select(*key_cols, "_v", F.timestamp_seconds(
        F.unix_seconds("_t0") + F.col("_k") * step).alias(ts_col))
    inside = shifted.filter(F.col(ts_col) <= grid_end)
    summed = inside.groupBy(*key_cols, ts_col).agg(F.sum("_v").alias("_s"))
    idx = F.floor((F.unix_seconds(F.col(ts_col)) - F.unix_seconds(grid_start)) / step)
    return (summed
            .withColumn("window_rows", F.least(F.lit(rows), idx + 1).cast("int"))
            .select(*key_cols, ts_col, F.col("_s").alias("window_sum"), "window_rows",
                    (F.col("_s").cast("double") / F.col("window_rows")).alias(out)))


def rate_of_change(series: DataFrame, ts_col: str, value_col: str, part_cols=(),
                   out: str = "per_hour") -> DataFrame:
    """Diff / elapsed hours; first row NULL."""
    w = Window.partitionBy(*part_cols).orderBy(ts_col)
    dv = F.col(value_col) - F.lag(value_col).over(w)
    dt = (F.unix_micros(F.col(ts_col)) - F.unix_micros(F.lag(ts_col).over(w))) / F.lit(3.6e9)
    return series.withColumn(out, F.try_divide(dv, dt))


def cyclic_features(df: DataFrame, date_col: str) -> DataFrame:
    """D2 + D3: day of year, weekday (Monday = 0), month and their sin/cos
    on periods 365, 7 and 12 (365 also in leap years)."""
    d = F.to_date(F.col(date_col))
    two_pi = 2 * math.pi
    out = (df.withColumn("day_of_year", F.dayofyear(d))
           .withColumn("day_of_week", F.weekday(d))
           .withColumn("month", F.month(d)))
    for name, period in (("day_of_year", 365), ("day_of_week", 7), ("month", 12)):
        ang = F.lit(two_pi) * F.col(name) / F.lit(float(period))
        out = out.withColumn(f"{name}_sin", F.sin(ang)).withColumn(f"{name}_cos", F.cos(ang))
    return out


def hour_of_clock_string(c: Column | str, pattern: str = "h:mm a") -> Column:
    """D4: '8:05 PM' -> 20; unparsable -> NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.hour(F.try_to_timestamp(c, F.lit(pattern)))
