"""Model jobs beat the mean, the majority or chance on held-out rows."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from kiln.operators import models as ml
from tests.conftest import MEDIUM, SMOKE


def run(spark, name, sf_dir=MEDIUM):
    return entry.queries()[name](spark, sf_dir)


def r2(df, y, yhat):
    rows = [(float(r[y]), float(r[yhat])) for r in df.collect()]
    mean = sum(a for a, _ in rows) / len(rows)
    return 1 - sum((a - b) ** 2 for a, b in rows) / sum((a - mean) ** 2 for a, _ in rows)


def accuracy(df, y, yhat):
    rows = [(r[y], r[yhat]) for r in df.collect()]
    majority = max(sum(a == c for a, _ in rows) for c in {a for a, _ in rows}) / len(rows)
    return sum(a == b for a, b in rows) / len(rows), majority


def test_text_pipeline_beats_the_majority(spark):
    got, majority = accuracy(run(spark, "nb_pipeline", SMOKE), "label", "prediction")
    assert got > majority


def test_search_rows(spark):
    rows = run(spark, "param_search", SMOKE).collect()
    assert len(rows) == 5 and all(5_000 <= r.max_features <= 50_000 and 0 <= r.accuracy <= 1 for r in rows)


def test_cost_model_beats_the_mean(spark):
    assert r2(run(spark, "cost_gbt"), "final_cost", "prediction") > 0.3
    report = run(spark, "cost_gbt_report").collect()
    assert [r.rank for r in report] == [1, 2, 3, 4] and abs(sum(r.importance for r in report) - 1) < 1e-6
    assert [r.importance for r in report] == sorted((r.importance for r in report), reverse=True) and report[0].r2 > 0.3


def test_load_forecast_is_in_the_unit_of_the_series(spark):
    rows = run(spark, "load_forecast").collect()
    errors = run(spark, "load_forecast_errors").first()
    mae = sum(abs(r.revenue - r.forecast) for r in rows) / len(rows)
    assert abs(errors.mae - mae) < 1e-6 * mae and errors.rmse >= errors.mae and errors.mape_pct > 0


def test_kernel_classifiers_beat_chance(spark):
    """One class of ten against the rest: more of the class is found than among the others."""
    for name in ("rbf_classifier", "kernel_svc"):
        rows = run(spark, name).collect()
        assert rows and {r.predicted for r in rows} <= {-1, 1}
    rows = run(spark, "rbf_classifier").collect()
    rate = lambda y: sum(r.predicted == 1 for r in rows if r.y == y) / max(1, sum(r.y == y for r in rows))
    assert rate(1) > rate(-1)


def test_weather_model_and_its_verdicts(spark):
    assert run(spark, "weather_regression", SMOKE).groupBy("target").count().count() == 3
    rows = run(spark, "forecast_model_verdict", SMOKE).collect()
    assert rows and {r.temperature for r in rows} <= {"model", "api", "equal", "error", "api_data_missing", "api_fetch_failed"}


def test_kfold_search_prunes_above_the_median(spark):
    rows = run(spark, "kfold_search", SMOKE).collect()
    assert {r.trial for r in rows} == set(range(10)) and not any(r.pruned for r in rows if r.trial == 0)
    assert sum(r.trial == 0 for r in rows) == 5
    for t in range(1, 10):
        mine = [r for r in rows if r.trial == t]
        assert not any(r.pruned for r in mine[:-1])
        for r in mine:
            before = sorted(x.rmse for x in rows if x.trial < t and x.fold == r.fold)
            median = (before[(len(before) - 1) // 2] + before[len(before) // 2]) / 2 if before else None
            assert r.pruned == (median is not None and r.rmse > median)


def test_kfold_search_finds_the_better_penalty(spark):
    d = spark.range(60).select((F.col("id") / 10).alias("x"), (F.col("id") % 3).cast("int").alias("fold"),
                               (F.col("id") * 0.3 + 1).alias("y"))
    rows = ml.kfold_search(d, ["x"], "y", "fold", 3, [{"reg": 5.0, "elastic": 0.0}, {"reg": 1e-6, "elastic": 0.0}])
    loss = {t: sum(r[4] for r in rows if r[0] == t) for t in (0, 1)}
    assert loss[1] < loss[0]


@pytest.mark.parametrize("spec,ok", [([1, 2, 3], lambda v: v in (1, 2, 3)), ((2, 5), lambda v: v in (2, 3, 4, 5)),
                                     ((0.5, 1.5), lambda v: 0.5 <= v < 1.5), (("log", 1e-4, 1e-1), lambda v: 1e-4 <= v <= 1e-1)])
def test_sampled_space(spec, ok):
    rows = ml.sample_space({"p": spec}, 200)
    assert all(ok(r["p"]) for r in rows) and rows == ml.sample_space({"p": spec}, 200) != ml.sample_space({"p": spec}, 200, 7)
    if spec == (2, 5):
        assert {r["p"] for r in rows} == {2, 3, 4, 5}


def test_models_score_after_components_in_one_session(spark):
    """Clusters must leave nothing in the session that a margin classifier can't serialise."""
    assert run(spark, "fuzzy_clusters", SMOKE).count() > 0
    assert run(spark, "kernel_svc", SMOKE).count() > 0


def test_text_pipeline_leaves_its_vocabulary_in_the_tasks(spark):
    """The same predictions as MLlib's matrix over all terms, for repeated ids too, without a fitted vocabulary."""
    words = ["alpha beta gamma", "beta beta delta", "Gamma delta the epsilon", "epsilon zeta alpha", "zeta eta", "unseen words only"]
    rows = spark.createDataFrame([(k % 20, f"{words[k % 6]} {words[k * k % 5]}", "xyz"[k % 3]) for k in range(60)], "id long, text string, label string")
    model = ml.nb_text_pipeline("text", "label", alpha=0.1).fit(rows.where("id < 12"))
    assert not any(hasattr(s, "vocabulary") for s in getattr(model, "stages", []))
    whole = ml.nb_text_pipeline("text", "label", alpha=0.1, max_features=10_000).fit(rows.where("id < 12"))
    got, want = (sorted(map(tuple, ml.nb_predict(m, rows, "label").select("id", "text", "label", "prediction").collect())) for m in (model, whole))
    assert got == want and len({r[3] for r in got}) > 1
