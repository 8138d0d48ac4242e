"""Set operations (U1-U5): unions with missing columns, de-duplication,
(chained) symmetric difference."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: list[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Stack frames by column name; absent columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def symmetric_difference(frames: list[DataFrame], key: str) -> DataFrame:
    """Values in an odd number of the (de-duplicated) inputs; for two
    inputs that is (A EXCEPT B) UNION (B EXCEPT A). One shuffle on the key:
    each input is de-duplicated map-side, tagged, and counted per key."""
    tagged = [f.select(F.col(key)).distinct().withColumn("_src", F.lit(i)) for i, f in enumerate(frames)]
    return (union_all(tagged).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") % 2 == 1).select(key))


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """The distinct values of a column in order."""
    return df.select(col).distinct().orderBy(col)


def flatten_index(nested, wanted):
    """(flattened array, 1-based position of a value in it or 0, whether it holds the value)."""
    flat = F.flatten(nested)
    return flat, F.coalesce(F.array_position(flat, wanted), F.lit(0)), F.array_contains(flat, wanted)
