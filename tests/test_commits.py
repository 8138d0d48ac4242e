"""Committed tables, configuration chains, timings and polled forecasts."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from kiln.operators import experiments as ex
from kiln.sources import files
from kiln.streaming import jobs


def folder():
    return tempfile.mkdtemp(prefix="kiln-test-commit-")


def test_a_killed_writer_leaves_nothing_that_is_read(spark):
    path = os.path.join(folder(), "t")

    def killed():
        raise KeyboardInterrupt

    def partial():  # some files of a version are there, the commit is not
        spark.range(5).write.parquet(f"{path}/v-dead")
        os.remove(next(e.path for e in os.scandir(f"{path}/v-dead") if e.name == "_SUCCESS"))
        raise KeyboardInterrupt

    for build in (killed, partial):
        with pytest.raises(KeyboardInterrupt):
            files.materialised(spark, path, build)
    assert files.materialised(spark, path, lambda: spark.range(3)).count() == 3
    assert files.materialised(spark, path, killed).count() == 3


def test_of_two_writers_the_first_to_commit_wins(spark):
    path = os.path.join(folder(), "t")

    def overtaken():
        assert files.materialised(spark, path, lambda: spark.range(7)).count() == 7
        return spark.range(100)

    assert files.materialised(spark, path, overtaken).count() == 7
    assert len([n for n in os.listdir(path) if n.startswith("v-")]) == 1 and not [n for n in os.listdir(path) if n.startswith("_draft")]


def test_a_finished_plain_table_is_read(spark):
    path = os.path.join(folder(), "t")
    spark.range(4).write.parquet(path)
    assert files.materialised(spark, path, lambda: spark.range(9)).count() == 4
    os.remove(os.path.join(path, "_SUCCESS"))
    with pytest.raises(FileExistsError):
        files.materialised(spark, path, lambda: spark.range(9))


def test_configuration_chain(spark):
    d = folder()
    tuned, plain, broken = (os.path.join(d, n) for n in ("tuned.json", "plain.json", "broken.json"))
    for path, text in ((tuned, '{"alpha": 0.1, "stop": null}'), (plain, '{"alpha": 1.0, "stop": "english",\n "range": [1, 2]}'), (broken, "alpha: 1")):
        with open(path, "w") as f:
            f.write(text)
    defaults = {"alpha": "2.0", "max_features": "10000", "stop": "none"}
    rows = files.load_or_default(spark, [os.path.join(d, "absent.json"), broken, tuned, plain], defaults).collect()
    assert {r.key: (r.value, r.source) for r in rows} == {
        "alpha": ("0.1", 3), "stop": ("english", 4), "range": ("[1,2]", 4), "max_features": ("10000", 0)}
    assert {r.key: r.value for r in files.load_or_default(spark, [], defaults).collect()} == defaults


def test_timings_count_rows_in_the_same_run(spark):
    runs = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    df = spark.range(50).select("id", F.create_map(F.lit("a"), "id").alias("m")).mapInArrow(seen, "id long, m map<string,long>")
    rows = ex.timing_report({"x": df, "none": spark.range(0)}).collect()
    assert [(r.model, r.n_rows) for r in rows] == [("x", 50), ("none", 0)] and runs.value == 50
    assert all(r.seconds > 0 and r.seconds_per_row == pytest.approx(r.seconds / max(1, r.n_rows)) for r in rows)


def test_polled_forecasts_keep_the_newest(spark):
    """Repeated, late, overtaken and updated documents, and a restart from the checkpoint."""
    landing, check, out = folder(), folder(), folder()
    predictions = spark.createDataFrame([(f"2024-05-{d:02d}", 30.0, 20.0, 10.0) for d in (1, 2, 3, 20)],
                                        "date string, p_max double, p_min double, p_wind double").withColumn("date", F.col("date").cast("date"))
    stats = spark.range(1).select(*[F.lit(25.0).alias(f"mean_{c}") for c in ("max", "min", "wind")],
                                  *[F.lit(5.0).alias(f"std_{c}") for c in ("max", "min", "wind")])

    def poll(n, *docs):
        with open(os.path.join(landing, f"p{n}.json"), "w") as f:
            f.writelines(json.dumps({"date": f"2024-05-{day:02d}", "updatedTimestamp": updated, "general": {
                "temperature": {"low": 20, "high": high}, "wind": {"speed": {"low": 1, "high": 9}}}}) + "\n" for day, updated, high in docs)
        query = jobs.polled_verdicts(spark, landing, predictions, stats)  # a new query each time: restarted from the checkpoint
        jobs.run_available_now(query, check, path=out)
        return {r.date.day: (r.updated.isoformat(), r.api_temp_z) for r in jobs.latest_verdicts(spark, out).collect()}, spark.read.parquet(out).count()

    z = lambda high: abs((20 + high) / 2 - 25) / (5 + 1e-8)
    got, rows = poll(1, (1, "2024-05-01T06:00:00Z", 30), (1, "2024-05-01T06:00:00Z", 30), (2, "2024-05-01T06:00:00Z", 40))
    assert rows == 2 and got == {1: ("2024-05-01T06:00:00", z(30)), 2: ("2024-05-01T06:00:00", z(40))}
    # polled again, one updated; then an older version that arrives after the newer one
    got, rows = poll(2, (1, "2024-05-01T06:00:00Z", 30), (2, "2024-05-01T12:00:00Z", 50))
    assert rows == 3 and got[2] == ("2024-05-01T12:00:00", z(50)) and got[1][1] == z(30)
    got, rows = poll(3, (2, "2024-05-01T09:00:00Z", 90), (3, "2024-05-01T13:00:00Z", 10), ("x" and 1, None, 10))
    assert rows == 4 and got[2] == ("2024-05-01T12:00:00", z(50)) and got[3][1] == z(10)
    # far ahead: the watermark passes, so a document of the first days is late now
    got, rows = poll(4, (20, "2024-05-20T06:00:00Z", 30))
    got, rows = poll(5, (1, "2024-05-02T06:00:00Z", 99))
    assert rows == 5 and got[1] == ("2024-05-01T06:00:00", z(30)) and got[20][1] == z(30)
