"""File scans and sinks round-trip through a scratch folder."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from kiln import session
from kiln.operators import augment, models, weather
from kiln.sources import files


def test_csv_lines_and_sentinels(spark):
    d = tempfile.mkdtemp(prefix="kiln-test-src-")
    p = os.path.join(d, "w.csv")
    with open(p, "w") as f:
        f.write("date,tmax,note\n2024-01-01,31.5,ok\n2024-01-02,na,na\n2024-01-03,x,bad\n"
                "2024-01-04,1.5\n2024-01-05,2.5,long,extra\n2024-01-06,3.5,longer,,\n")
    schema = "date DATE, tmax DOUBLE, note STRING"
    df = files.read_csv(spark, p, schema, long_lines="skip")
    rows = {r.date.isoformat()[-2:]: (r.tmax, r.note) for r in df.collect()}
    assert rows == {"01": (31.5, "ok"), "02": (None, None), "03": (None, "bad"), "04": (1.5, None)}
    assert files.skipped_lines(spark, p, schema).collect()[0].skipped == 2
    cut = {r.date.isoformat()[-2:]: (r.tmax, r.note) for r in files.read_csv(spark, p, schema).collect()}
    assert cut == rows | {"05": (2.5, "long"), "06": (3.5, "longer")}
    kept, dropped = files.drop_null_rows(df, ["tmax"])
    assert kept.count() == 2 and dropped.collect()[0].dropped == 2
    assert files.read_csv(spark, p, schema, long_lines="skip").select("note").count() == 4


def test_materialised_never_overwrites(spark):
    d = tempfile.mkdtemp(prefix="kiln-test-src-")
    made = []

    def build():
        made.append(1)
        return spark.range(3)

    good = os.path.join(d, "t")
    assert files.materialised(spark, good, build).count() == 3 == files.materialised(spark, good, build).count()
    assert len(made) == 1
    bad = os.path.join(d, "broken")
    os.mkdir(bad)
    with open(os.path.join(bad, "part-0.parquet"), "w") as f:
        f.write("this is no parquet file")
    with pytest.raises(Exception):
        files.materialised(spark, bad, build).count()
    assert os.listdir(bad) == ["part-0.parquet"] and len(made) == 1


def test_json_documents_and_models(spark):
    d = tempfile.mkdtemp(prefix="kiln-test-src-")
    with open(os.path.join(d, "stats.json"), "w") as f:
        f.write('{\n "mean": 1.5,\n "names": ["a", "b"]\n}')
    row = files.read_json_doc(spark, os.path.join(d, "stats.json"), "mean DOUBLE, names ARRAY<STRING>", multi_line=True).collect()
    assert [(r.mean, r.names) for r in row] == [(1.5, ["a", "b"])]
    data = spark.range(20).selectExpr("CAST(id AS DOUBLE) AS x", "2.0D * id + 1 AS y")
    files.save_model(models.regression(["x"], "y").fit(data), os.path.join(d, "model"))
    out = files.load_model(os.path.join(d, "model")).transform(data).selectExpr("max(abs(prediction - y)) AS e").collect()
    assert out[0].e < 1e-6


def test_news_and_pairs(spark):
    d = tempfile.mkdtemp(prefix="kiln-test-src-")
    with open(os.path.join(d, "n.csv"), "w") as f:
        f.write('3,"Title one","Desc, with comma"\n1,"Only title",\n')
    df = files.read_news_csv(spark, os.path.join(d, "n.csv")).orderBy("label").collect()
    assert [(r.label, r.text) for r in df] == [(0, "Only title"), (2, "Title one Desc, with comma")]
    with open(os.path.join(d, "p.txt"), "w") as f:
        f.write("go .\tva !\textra\n")
    p = files.read_pairs_tsv(spark, os.path.join(d, "p.txt"), reverse=True).collect()[0]
    assert (p.src, p.tgt) == ("va !", "go .")


def test_export_profile_metadata(spark):
    d = tempfile.mkdtemp(prefix="kiln-test-src-")
    df = spark.createDataFrame([(1, [1.0, 2.0], "a"), (2, [3.0], "b")], "id int, v array<double>, s string")
    out = files.export_results(df, os.path.join(d, "out"), "csv")
    assert out.columns == ["id", "s"]
    back = spark.read.option("header", True).csv(os.path.join(d, "out"))
    assert back.count() == 2
    meta = {r.name: r.type for r in files.column_metadata(df).collect()}
    assert meta == {"id": "int", "v": "array<double>", "s": "string"}
    assert files.profile(df.select("id")).filter(F.col("summary") == "count").collect()[0].id == "2"
    ok, rest = files.coerce_timestamps(spark.createDataFrame([("2024-01-01 10:00:00",), ("Total",)], "t string"), "t")
    assert ok.count() == 1 and rest.collect()[0].t == "Total"


def test_required_columns_and_records(spark):
    df = spark.range(1).selectExpr("id", "1 AS a")
    assert files.require_columns(df, ["id", "a"]) is df
    with pytest.raises(ValueError, match="missing columns: .'b'."):
        files.require_columns(df, ["a", "b"])
    d = tempfile.mkdtemp(prefix="kiln-test-src-")
    with open(os.path.join(d, "r.json"), "w") as f:
        f.write('{"date": "2024-05-01", "general": {"temperature": {"low": 1, "high": 3}}}\n{"date": "2024-05-02"}\n')
    rows = weather.flatten(weather.read_records(spark, d)).orderBy("date").collect()
    assert [(r.temp_low, r.temp_high, r.forecast_text) for r in rows] == [(1.0, 3.0, None), (None, None, None)]


def test_augment_and_save(spark):
    """An augmented table is written and read back."""
    d = os.path.join(tempfile.mkdtemp(prefix="kiln-test-src-"), "aug")
    docs = spark.createDataFrame([(1, "one two three four")], "doc_id long, text string")
    files.write_table(augment.augment(docs, "doc_id", "text", ["deletion", "swap"], 2), d, partition_by=["technique"])
    back = spark.read.parquet(d)
    assert back.count() == 5 and {r.technique for r in back.collect()} == {"original", "deletion", "swap"}


def test_checkpoint_folder_is_shared_or_local(monkeypatch):
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: {})

    class Session:
        sparkContext = Context
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session)
