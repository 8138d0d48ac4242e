"""Tables written between the steps of an operator.

Lineage is cut with Parquet under the session's checkpoint folder, which every executor shares: a lost
executor re-reads the table instead of recomputing the steps above it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from kiln.session import ensure_checkpoint_dir


class Scratch:
    """One folder per operator call below ``spark.checkpoint.dir``."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
        """Write ``df`` once and return a scan of what was written. ``compression`` names a Parquet codec (none: the session's),
        for large tables of texts or ids."""
        path = f"{self.base}/{name}"
        df.write.mode("overwrite").parquet(path, compression=compression)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Remove a table that later steps no longer read."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
