"""Streaming jobs agree with their batch forms."""

import os
import tempfile

from pyspark.sql import functions as F

from kiln.plans import series_queries as sq
from kiln.plans import weather_queries as wq
from kiln.sources.tables import load
from kiln.streaming import jobs
from tests.conftest import SMOKE


def test_load_totals_stream_matches_batch(spark):
    schema = spark.read.parquet(f"{SMOKE}/events.parquet").schema
    stream = jobs.event_stream(spark, SMOKE, schema, "events.parquet")
    got = {}

    def collect(batch, _id):
        for r in batch.collect():
            got[r.window_start] = (r.n_events, r.value_sum)

    ck = tempfile.mkdtemp(prefix="kiln-test-ck-")
    jobs.run_available_now(jobs.load_totals(stream), ck, sink=collect, mode="update")
    ev = load(spark, SMOKE, "events")
    batch = (ev.groupBy(F.window("ts", "5 minutes"))
             .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("s"))
             .collect())
    want = {r.window.start: (r.n, r.s) for r in batch}
    assert got == want


def test_forecast_stream_matches_batch(spark):
    landing = tempfile.mkdtemp(prefix="kiln-test-landing-")
    wq.forecast_json(spark, SMOKE).write.mode("overwrite").text(os.path.join(landing, "docs"))
    pred = wq.persistence(spark, SMOKE)
    stats = sq.target_stats(spark, SMOKE)
    got = {}

    def collect(batch, _id):
        for r in batch.collect():
            got[r.date] = (r.temperature, r.wind)

    ck = tempfile.mkdtemp(prefix="kiln-test-ck-")
    jobs.run_available_now(jobs.forecast_verdicts(spark, os.path.join(landing, "docs"), pred, stats),
                           ck, sink=collect)
    batch = {r.date: (r.temperature, r.wind)
             for r in wq.q_forecast_verdict(spark, SMOKE).collect() if r.temperature != "api_fetch_failed"}
    assert got == batch and len(got) > 0
