from pyspark.sql import functions as F

from kiln.llm import sieve


def test_no_row_with_a_key_goes_missing(spark):
    rows = spark.range(200_000).select((F.col("id") * 7 - 350_000).alias("k"), F.lit("x").alias("_bits"))
    keys = spark.range(3000).select((F.col("id") * 700 - 350_000).alias("k"))
    out = sieve.sieve(rows, "k", keys)
    assert out.columns == ["k", "_bits"]
    kept = {r.k for r in out.collect()}
    want = {k * 700 - 350_000 for k in range(2000)}
    assert want <= kept and len(kept) < len(want) + 200
    assert sieve.sieve(rows, "k", keys.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None,), (5,)], "k long")
    assert [r.k for r in sieve.sieve(nulls, "k", nulls.where("k = 5")).collect()] == [5]
