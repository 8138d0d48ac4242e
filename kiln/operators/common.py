"""Shared physical helpers: cuts, lookups and positions without a hot task.

* A side is broadcast only when its size is bounded by construction (a global aggregate, the heavy keys
  of a count table); otherwise Spark's byte statistics and adaptive execution decide.
* Rows that grow with the data are never ranked in an un-partitioned window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.lineage import Scratch

HASH_BITS = 32
#: A key is heavy when it holds at least this part of all occurrences, so at most as many keys are heavy.
HEAVY_KEYS = 1000
#: As many keys at most, the commonest, go to every task where only the rows of the others are shuffled.
BROADCAST_KEYS = 1 << 17


def hash_cut(df: DataFrame, group_cols: list[str], hash_col: str, id_col: str, frac: float, rounding=F.round) -> DataFrame:
    """(*group, _cut_hash, _cut_id): the last row of the first ``rounding(frac * n)`` in order of (hash, id), per group.

    ``hash_col`` must be a uniform unsigned 32-bit hash. Rows are counted per (group, bucket of the top hash bits); only
    the ids of the bucket that the cut falls in are put in order, about one in ``buckets``. A group whose cut is 0 has
    no row here. Ids and hashes are all that is shuffled; the rows themselves are then filtered where they lie.
    """
    g, shift = list(group_cols), HASH_BITS - 12
    keyed = df.select(*g, hash_col, id_col).withColumn("_bkt", F.shiftright(F.col(hash_col), shift))
    counts = keyed.groupBy(*g, "_bkt").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(*g) if g else Window.partitionBy(F.lit(0))
    before = w.orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    edge = (counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
            .withColumn("_k", rounding(F.sum("_cnt").over(w) * F.lit(float(frac))).cast("long") - F.col("_off"))
            .where((F.col("_k") > 0) & (F.col("_k") <= F.col("_cnt"))).select(*g, "_bkt", "_k"))
    names = {c: f"_e{c}" for c in [*g, "_bkt"]}  # a null group matches itself
    inside = keyed.join(edge.withColumnsRenamed(names), [F.col(c).eqNullSafe(F.col(e)) for c, e in names.items()])
    order = Window.partitionBy(*g, "_bkt").orderBy(hash_col, id_col)
    return (inside.withColumn("_r", F.row_number().over(order)).where("_r = _k")
            .select(*g, F.col(hash_col).alias("_cut_hash"), F.col(id_col).alias("_cut_id")))


def small_side(df: DataFrame, most_bytes: int = 32 << 20) -> DataFrame:
    """``df`` written once and read back; a broadcast side if its rows, 64 bytes and more each, are few enough."""
    table = Scratch(df.sparkSession, "side").write(df, "rows")
    width = 64 + 16 * len(df.columns)
    return F.broadcast(table) if table.count() * width <= most_bytes else table


def lookup(rows: DataFrame, key: str, table: DataFrame, value: str, count_col: str, spread_by: list[str]) -> DataFrame:
    """``rows`` with ``value`` of the row of ``table`` (key, value, count_col) that has the same key, or NULL.

    Word frequencies are Zipf-like: the commonest keys would fill one task. ``count_col`` says how often a key occurs;
    the at most ``HEAVY_KEYS`` keys with a thousandth of all occurrences are broadcast. Rows that have found theirs,
    and rows without a key, go on under a hash of ``spread_by`` and a NULL key, which matches nothing.
    ``table`` is read three times: pass one that is written.
    """
    total = table.agg((F.sum(count_col) / HEAVY_KEYS).alias("_least"))
    heavy = (table.join(F.broadcast(total), F.col(count_col) >= F.col("_least"))
             .select(F.col(key).alias("_hk"), F.col(value).alias("_hv")))
    light = table.select(F.xxhash64(key).alias("_lh"), F.col(key).alias("_lk"), F.col(value).alias("_lv"))
    found = rows.join(F.broadcast(heavy), F.col(key) == F.col("_hk"), "left")
    search = F.col("_hk").isNull() & F.col(key).isNotNull()
    found = found.withColumn("_jh", F.when(search, F.xxhash64(key)).otherwise(F.xxhash64(*spread_by))) \
        .withColumn("_jk", F.when(search, F.col(key)))
    return (found.join(light, (F.col("_jh") == F.col("_lh")) & (F.col("_jk") == F.col("_lk")), "left")
            .withColumn(value, F.coalesce("_hv", "_lv")).drop("_hk", "_hv", "_lh", "_lk", "_lv", "_jh", "_jk"))


def lookup_apart(rows: DataFrame, key: str, table: DataFrame, value: str, count_col: str) -> DataFrame:
    """As ``lookup``, but only rows that need it are shuffled: those with one of the ``BROADCAST_KEYS`` commonest keys, and
    those without a key, get their value where they lie. ``rows`` and ``table`` are read more than once: pass rows that are
    written or cheap to make."""
    # a row per count, so many keys have it or a greater one
    steps = table.groupBy(F.col(count_col).alias("_c")).agg(F.count(F.lit(1)).alias("_n")).withColumn("_n", F.sum("_n").over(Window.orderBy(F.desc("_c"))))
    least = steps.agg(F.min(F.when(F.col("_n") <= BROADCAST_KEYS, F.col("_c"))).alias("_least"))
    near = F.broadcast(table.join(F.broadcast(least), F.col(count_col) >= F.col("_least"))
                       .select(F.col(key).alias("_hk"), F.col(value).alias("_hv")))
    marked = rows.join(near, F.col(key) == F.col("_hk"), "left")
    found = marked.where(F.col("_hk").isNotNull() | F.col(key).isNull()).withColumn(value, F.col("_hv")).drop("_hk", "_hv")
    rest = rows.where(F.col(key).isNotNull()).join(near.select("_hk"), F.col(key) == F.col("_hk"), "left_anti")
    far = table.select(F.col(key).alias("_lk"), F.col(value))
    return found.unionByName(rest.join(far, F.col(key) == F.col("_lk"), "left").drop("_lk"))


def global_index(df: DataFrame, order_cols: list, out: str = "idx") -> DataFrame:
    """1-based position of each row in the total order ``order_cols``.

    Range-partitioned sort, then per-partition offsets from a table with one
    row per partition. The sorted frame is written once with its partition
    numbers, so they stay fixed if an executor is lost.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    ordered = Scratch(df.sparkSession, "positions").write(
        df.orderBy(*cols).withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id()), "rows")
    parts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"),
                                        F.min("_mid").alias("_m0"))
    w_prev = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = parts.withColumn("_off", F.coalesce(F.sum("_n").over(w_prev), F.lit(0)))
    return (ordered.join(F.broadcast(offs), "_pid")
            .withColumn(out, F.col("_off") + F.col("_mid") - F.col("_m0") + 1)
            .drop("_pid", "_mid", "_n", "_m0", "_off"))


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row frame to every row.

    ``one_row`` must be a global aggregate (``df.agg(...)`` without grouping,
    or a projection of one), which has exactly one row by construction, so
    it is broadcast without a count."""
    return df.crossJoin(F.broadcast(one_row))


def rounded(c: Column | str, digits: int = 6) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), digits)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a scan that arrived in fewer partitions than the cluster
    has cores (one large row group). Per-row CPU work (regexes, folds) then
    uses every core. A no-op for normal multi-file inputs. Only for plain
    scans: counting the partitions of a frame with shuffles would run them."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= target else df.repartition(target)
