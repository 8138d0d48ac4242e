"""Models from sums against numpy on the rows themselves."""

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.sql import functions as F

from kiln.operators import gram


def frame(spark, x, *more, names="v array<double>, y double"):
    return spark.createDataFrame([(v.tolist(), *(float(m[k]) for m in more)) for k, v in enumerate(x)], names).repartition(3)


def test_sums_by_fold(spark):
    rng = np.random.default_rng(1)
    x, fold = rng.standard_normal((200, 5)), rng.integers(0, 3, 200)
    rows = [(int(f), v.tolist()) for f, v in zip(fold, x, strict=True)]
    rows += [(None, [1.0] * 5), (1, [None] + [1.0] * 4), (1, [float("nan")] * 5), (2, None)]
    got = gram.gram(spark.createDataFrame(rows, "fold int, v array<double>").repartition(4), F.col("v"), F.col("fold"))
    for k in range(3):
        assert np.allclose(got[k], x[fold == k].T @ x[fold == k])
    assert gram.gram(spark.createDataFrame([], "fold int, v array<double>"), F.col("v"), F.col("fold")) == {}


@pytest.mark.parametrize("reg,elastic", [(0.5, 0.0), (1e-3, 0.0), (0.3, 1.0), (0.2, 0.5), (0.0, 0.0)])
def test_elastic_net_is_the_least(reg, elastic):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((80, 4)) * [1, 5, 0.2, 0]  # the last is constant
    y = 3 + x @ [2.0, -0.4, 1.0, 7.0] + 0.3 * rng.standard_normal(80)
    z = np.hstack([np.ones((80, 1)), x, y[:, None]])
    intercept, b = gram.elastic_net(z.T @ z, reg, elastic)
    std = x.std(axis=0)

    def cost(c, b):
        return ((y - c - x @ b) ** 2).mean() / 2 + reg * (elastic * np.abs(b * std).sum() + (1 - elastic) / 2 * ((b * std) ** 2).sum())

    best = cost(intercept, b)
    assert b[3] == 0
    for _ in range(300):
        assert cost(intercept + 1e-3 * rng.standard_normal(), b + 1e-3 * rng.standard_normal(4) * [1, 1, 1, 0]) >= best - 1e-12
    assert np.isclose(gram.squared_error(z.T @ z, intercept, b), ((y - intercept - x @ b) ** 2).sum())
    if reg == 0:
        assert np.allclose(b[:3], np.linalg.lstsq(z[:, :4], y, rcond=None)[0][1:], atol=1e-8)


def test_kfold_losses_in_one_pass(spark):
    rng = np.random.default_rng(3)
    x, fold = rng.standard_normal((120, 2)), rng.integers(0, 4, 120)
    y = x @ [1.0, -2.0] + rng.standard_normal(120)
    df = spark.createDataFrame([(*map(float, v), float(t), int(f)) for v, t, f in zip(x, y, fold, strict=True)], "a double, b double, y double, f int")
    rows = gram.kfold_losses(df, ["a", "b"], "y", "f", [{"reg": 0.1, "elastic": 0.0}, {"reg": 1.0, "elastic": 0.5}]).collect()
    assert len(rows) == 8
    for r in rows:
        z = np.hstack([np.ones((120, 1)), x, y[:, None]])[fold != r.fold]
        c, b = gram.elastic_net(z.T @ z, r.reg, r.elastic)
        held = fold == r.fold
        assert np.isclose(r.rmse, np.sqrt(((y[held] - c - x[held] @ b) ** 2).mean()))


def rings(n, seed):
    """Two classes that no plane parts: a ball and the ring around it."""
    rng = np.random.default_rng(seed)
    radius = np.where(rng.random(n) < 0.6, rng.uniform(0, 1, n), rng.uniform(1.6, 2.4, n))
    way = rng.standard_normal((n, 2))
    return way / np.linalg.norm(way, axis=1, keepdims=True) * radius[:, None], np.where(radius < 1.3, 1.0, -1.0)


@pytest.mark.parametrize("count", [12, 1500])
def test_radial_network_parts_a_ball_from_its_ring(spark, count):
    x, y = rings(1800, 4)
    held, want = rings(500, 5)
    centres = x[:count]
    weights = gram.radial_network(frame(spark, x, y), "v", "y", centres, 1.0, 1e-9)
    scores = gram.radial_scores(frame(spark, held, want), ["y"], "v", centres, 1.0, weights).collect()
    right = np.mean([(r.score > 0) == (r.y > 0) for r in scores])
    assert right > 0.97 > 0.65 > np.mean(want > 0)
    if count == 12:  # the same weights as a least squares solver on the rows
        phi = gram.radial(x, centres, 1.0)
        exact = np.linalg.solve(phi.T @ phi + 1e-9 * len(x) * np.eye(count), phi.T @ y)
        assert np.allclose(phi @ weights, phi @ exact, atol=1e-6)


def test_kernel_map_and_margin_classifier_beat_the_majority(spark):
    x, y = rings(1500, 6)
    train = frame(spark, x, y)
    gamma = gram.scale_gamma(train, "v")
    assert np.isclose(gamma, 1 / (2 * x.var()))
    full = gram.Nystroem(x[:60], gamma)
    assert np.allclose(full(x[:60]) @ full(x[:60]).T, gram.radial(x[:60], x[:60], gamma), atol=1e-6)  # exact at the landmarks
    features = gram.Nystroem(x[:100], gamma)
    model = LinearSVC(featuresCol="_x", labelCol="l", maxIter=50, regParam=0.001).fit(
        features.transform(spark, train, ["y"], "v").withColumn("l", (F.col("y") + 1) / 2))
    held, want = rings(400, 7)
    out = model.transform(features.transform(spark, frame(spark, held, want), ["y"], "v")).collect()
    right = np.mean([(r.prediction > 0) == (r.y > 0) for r in out])
    assert right > 0.97 and right > max(np.mean(want > 0), np.mean(want < 0)) + 0.2
