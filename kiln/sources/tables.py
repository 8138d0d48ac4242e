"""Loader for the parquet tables under one scale-factor folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.session import prepare

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """Read one table; zone-less timestamps become UTC instants.

    Column pruning and filters applied later still reach the parquet scan,
    because the cast is a plain projection over the scan.
    """
    prepare(spark)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    casts = [
        F.col(f.name).cast("timestamp").alias(f.name)
        if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name)
        for f in df.schema.fields
    ]
    df = df.select(*casts)
    if spread:
        from kiln.operators.common import spread as _spread
        df = _spread(df)
    return df
