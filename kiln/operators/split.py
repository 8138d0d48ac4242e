"""Splits and samples (M1-M3, P15-P17, O5), all hash-deterministic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions.hashing import hash32, unit_hash
from kiln.operators.common import hash_cut, small_side


def stratified_split(df: DataFrame, label_col: str, id_col: str, frac: float = 0.1,
                     seed: int = 42, out: str = "split", held_out: str = "val",
                     kept: str = "train") -> DataFrame:
    """M1: per label, the first round(n_label * frac) rows in hash order
    are held out. Only labels, ids and hashes are shuffled, to find one cut
    per label; the rows are then compared with it where they lie."""
    h = hash32(F.col(id_col), seed, "split")
    cuts = hash_cut(df.select(label_col, id_col, h.alias("_h")), [label_col], "_h", id_col, frac) \
        .withColumnRenamed(label_col, "_label")
    held = F.struct(h.alias("h"), F.col(id_col).alias("i")) <= F.struct(F.col("_cut_hash").alias("h"), F.col("_cut_id").alias("i"))
    return (df.join(small_side(cuts), F.col(label_col).eqNullSafe(F.col("_label")), "left")
            .withColumn(out, F.when(F.col("_cut_hash").isNotNull() & held, held_out).otherwise(kept))
            .drop("_label", "_cut_hash", "_cut_id"))


def hash_split(df: DataFrame, id_col: str, test_frac: float = 0.2, seed: int = 42,
               out: str = "split") -> DataFrame:
    """M2: row goes to test iff its uniform hash is below ``test_frac``."""
    u = unit_hash(F.col(id_col), seed, "holdout")
    return df.withColumn(out, F.when(u < F.lit(float(test_frac)), "test").otherwise("train"))


def kfold(df: DataFrame, id_col: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """M3: fold number in [0, k) from the hash."""
    return df.withColumn(out, (hash32(F.col(id_col), seed, "kfold") % F.lit(k)).cast("int"))


def exact_sample(df: DataFrame, id_col: str, frac: float, seed: int = 42,
                 purpose: str = "sample") -> DataFrame:
    """Exactly floor(frac * n) rows, the smallest by hash order; found
    by one cut (see ``stratified_split``), which is a single row."""
    h = hash32(F.col(id_col), seed, purpose)
    cut = hash_cut(df.select(id_col, h.alias("_h")), [], "_h", id_col, frac, F.floor)
    inside = F.struct(h.alias("h"), F.col(id_col).alias("i")) <= F.struct(F.col("_cut_hash").alias("h"), F.col("_cut_id").alias("i"))
    return df.join(F.broadcast(cut), inside).drop("_cut_hash", "_cut_id")


def pick_k(df: DataFrame, id_col: str, k: int, seed: int = 42, purpose: str = "pick") -> DataFrame:
    """K rows without replacement (top-k by hash; a sampling operator)."""
    return (df.withColumn("_h", hash32(F.col(id_col), seed, purpose))
            .orderBy("_h", id_col).limit(k).drop("_h"))


def shuffle_order(df: DataFrame, id_col: str, seed: int = 42) -> DataFrame:
    """A reproducible shuffled order key."""
    return df.withColumn("shuffle_key", hash32(F.col(id_col), seed, "shuffle"))
