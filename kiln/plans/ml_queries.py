"""Registered model jobs. Models that follow from sums have a SQL twin, the others are checked on held-out rows."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LinearSVC
from pyspark.sql import Window
from pyspark.sql import functions as F

from kiln.functions import text as tx
from kiln.functions.hashing import sql_hash32, sql_unit_hash, unit_hash
from kiln.lineage import Scratch
from kiln.operators import experiments as ex
from kiln.operators import gram, metrics
from kiln.operators import models as ml
from kiln.operators import naive_bayes as nb
from kiln.operators import timeseries as ts
from kiln.operators import vectors as vx
from kiln.operators import weather as wx
from kiln.operators.common import attach_row
from kiln.operators.split import hash_split, kfold, pick_k
from kiln.plans import query
from kiln.plans.ev_queries import q_price_features
from kiln.plans.series_queries import LOOK_BACK, SQL_TARGETS, daily_targets, scaled_series, target_stats
from kiln.plans.text_queries import SQL_SPLIT, nb_predictions, split_documents
from kiln.plans.vector_queries import CENTRES, SQL_SAMPLED, embeddings, sampled_centres
from kiln.plans.weather_queries import records


@query("nb_pipeline")
def q_nb_pipeline(spark, sf_dir):
    s = split_documents(spark, sf_dir)
    train = s.filter(F.col("split") == "train")
    model = ml.nb_text_pipeline("text", "label", alpha=0.1).fit(train)
    val = s.filter(F.col("split") == "val")
    return ml.nb_predict(model, val, "label").select("doc_id", "label", "prediction")


#: The ranges of the search (a choice and an integer range).
NB_SPACE = {"alpha": [0.01, 0.1, 0.5, 1.0], "max_features": (5_000, 50_000)}


NB_TRIALS = ml.sample_space(NB_SPACE, 5)


def _sql_param_search() -> str:
    trials = ", ".join(f"({n}, {t['alpha']!r}::DOUBLE, {t['max_features']})" for n, t in enumerate(NB_TRIALS))
    return f"""WITH {SQL_SPLIT},
tr AS (SELECT doc_id, text, label, {sql_unit_hash('doc_id', "'42'", "'holdout'")} < 0.1::DOUBLE AS held
       FROM s WHERE split = 'train' AND label IS NOT NULL),
tok AS (SELECT doc_id, label, held, list_filter(string_split({tx.sql_clean_text('text')}, ' '), lambda x: x <> '') AS t FROM tr),
tf AS (SELECT doc_id, label, held, term, count(*) AS tf FROM (
         SELECT doc_id, label, held, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: array_to_string(t[i:i+1], ' ')))) AS term
         FROM tok) GROUP BY ALL),
tc AS (SELECT term, label, sum(tf) AS n FROM tf WHERE NOT held GROUP BY ALL),
rk AS (SELECT term, row_number() OVER (ORDER BY sum(n) DESC, term) AS place FROM tc GROUP BY term),
trials AS (SELECT * FROM (VALUES {trials}) v(trial, alpha, max_features)),
vs AS (SELECT trial, count(*) AS v FROM rk JOIN trials ON place <= max_features GROUP BY trial),
ms AS (SELECT trial, label, sum(n) AS mass FROM tc JOIN rk USING (term) JOIN trials ON place <= max_features GROUP BY ALL),
pr AS (SELECT label, count(*)::DOUBLE / sum(count(*)) OVER () AS prior FROM tr WHERE NOT held GROUP BY label),
md AS (SELECT trials.trial, pr.label, ln(prior) AS prior, ln(alpha / (coalesce(mass, 0) + alpha * vs.v)) AS miss
       FROM trials CROSS JOIN pr JOIN vs USING (trial) LEFT JOIN ms ON ms.trial = trials.trial AND ms.label = pr.label),
ht AS (SELECT trial, alpha, doc_id, term, tf FROM tf JOIN rk USING (term) JOIN trials ON place <= max_features WHERE held),
td AS (SELECT trial, doc_id, sum(tf) AS t FROM ht GROUP BY ALL),
sd AS (SELECT trial, doc_id, tc.label, sum(tf * ln((tc.n + alpha) / alpha)) AS s FROM ht JOIN tc USING (term) GROUP BY ALL),
sc AS (SELECT md.trial, tr.doc_id, tr.label AS truth, md.label AS cls, md.prior + coalesce(td.t, 0) * md.miss + coalesce(sd.s, 0) AS score
       FROM tr CROSS JOIN md LEFT JOIN td ON td.trial = md.trial AND td.doc_id = tr.doc_id
       LEFT JOIN sd ON sd.trial = md.trial AND sd.doc_id = tr.doc_id AND sd.label = md.label WHERE tr.held),
bs AS (SELECT trial, doc_id, truth, first(cls ORDER BY score DESC, cls) AS cls FROM sc GROUP BY ALL)
SELECT trial, alpha, max_features, avg((cls = truth)::INTEGER) AS accuracy FROM trials JOIN bs USING (trial) GROUP BY ALL"""


@query("param_search", _sql_param_search())
def q_param_search(spark, sf_dir):
    """M8: five trials of smoothing and vocabulary size from one tokenisation."""
    train = split_documents(spark, sf_dir).where("split = 'train'")
    held = unit_hash(F.col("doc_id"), 42, "holdout") < F.lit(0.1)
    return nb.parameter_search(train, "doc_id", "text", "label", held, NB_TRIALS)


GBT_FEATURES = ["hours", "soc_start_pct", "capacity_kwh", "start_hour"]


def _cost_gbt(spark, sf_dir):
    d = Scratch(spark, "cost-gbt").write(hash_split(q_price_features(spark, sf_dir), "user", 0.2, 42), "features")
    pipe = ml.regression(GBT_FEATURES, "final_cost", "gbt", maxIter=100, stepSize=0.1, maxDepth=5, seed=42)
    model = pipe.fit(d.filter(F.col("split") == "train"))
    return model, model.transform(d.filter(F.col("split") == "test"))


@query("cost_gbt")
def q_cost_gbt(spark, sf_dir):
    return _cost_gbt(spark, sf_dir)[1].select("user", "final_cost", "prediction")


def _errors(df, y, yhat, eps=1e-8):
    """A9-A11 in one pass: MAE, RMSE, R2 from sums, percent MAPE without zero targets."""
    e = F.col(yhat) - F.col(y)
    agg = df.agg(F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.sum(e * e).alias("_sse"),
                 F.var_pop(y).alias("_v"), F.count(F.lit(1)).alias("_n"), F.avg(F.abs(F.try_divide(e, F.col(y))) * 100).alias("mape_pct"))
    return agg.select("mae", "rmse", "mape_pct", (1 - F.try_divide(F.col("_sse"), F.col("_v") * F.col("_n"))).alias("r2"))


@query("cost_gbt_report")
def q_cost_gbt_report(spark, sf_dir):
    """M6: importances, largest first, next to the errors on the held-out users."""
    model, out = _cost_gbt(spark, sf_dir)
    rows = [(n + 1, *x) for n, x in enumerate(ml.feature_importances(model, GBT_FEATURES))]
    ranked = spark.createDataFrame(rows, "rank int, feature string, importance double")
    return attach_row(ranked, _errors(out, "final_cost", "prediction"))


def _load_forecast(spark, sf_dir):
    """Lagged values as columns; the prediction is turned back to the unit of the series."""
    w = Window.partitionBy("split").orderBy("ds")
    s = scaled_series(spark, sf_dir)
    feats = [f"lag{k}" for k in range(1, LOOK_BACK + 1)]
    wide = s.select("split", "ds", "revenue", F.col("scaled").alias("target"),
                    *[F.lag("scaled", k).over(w).alias(f) for k, f in enumerate(feats, 1)]).where(F.col(feats[-1]).isNotNull())
    wide = Scratch(spark, "load-forecast").write(wide, "windows")
    model = ml.regression(feats, "target").fit(wide.filter(F.col("split") == "train"))
    out = model.transform(wide.filter(F.col("split") == "test"))
    fit = ts.minmax_fit(s.filter(F.col("split") == "train"), "revenue")
    return ts.minmax_inverse(out, "prediction", fit, out="forecast").select("ds", "target", "prediction", "revenue", "forecast")


@query("load_forecast")
def q_load_forecast(spark, sf_dir):
    return _load_forecast(spark, sf_dir)


@query("load_forecast_errors")
def q_load_forecast_errors(spark, sf_dir):
    """M5: errors of the forecast in the unit of the series."""
    return _errors(_load_forecast(spark, sf_dir), "revenue", "forecast")


WEATHER_FEATURES = [f"{c}_{f}" for c in ("day_of_year", "day_of_week", "month") for f in ("sin", "cos")]


KFOLD_TRIALS = ml.sample_space({"reg": ("log", 1e-3, 10.0), "elastic": [0.0, 0.5, 1.0]}, 10)


def _sql_descent(d: int, sweeps: int = 400) -> str:
    """Coordinate descent as a recursive relation: one sweep over the coefficients b1 to bd per step."""
    step = f"SELECT t, fold, reg, elastic, a, c, {', '.join(f'b{j}' for j in range(1, d + 1))}, s + 1 AS s FROM cd WHERE s < {sweeps}"
    for j in range(1, d + 1):
        pull = f"c[{j}] - ({' + '.join(f'a[{(j - 1) * d + k}] * b{k}' for k in range(1, d + 1) if k != j)})"
        new = f"CASE WHEN a[{(j - 1) * d + j}] = 0 THEN 0 ELSE sign({pull}) * greatest(abs({pull}) - reg * elastic, 0) / (1 + reg * (1 - elastic)) END"
        step = f"SELECT * REPLACE ({new} AS b{j}) FROM ({step})"
    zero = ", ".join(f"0::DOUBLE AS b{j}" for j in range(1, d + 1))
    return f"cd AS (SELECT t, fold, reg, elastic, a, c, {zero}, 0 AS s FROM trials CROSS JOIN fits UNION ALL ({step}))"


def _sql_kfold() -> str:
    d, names = len(WEATHER_FEATURES), WEATHER_FEATURES
    periods = {"day_of_year": "dayofyear(ds) / 365.0::DOUBLE", "day_of_week": "(isodow(ds) - 1) / 7.0::DOUBLE", "month": "month(ds) / 12.0::DOUBLE"}
    cols = ", ".join(f"{f[-3:]}(2 * pi() * {periods[f[:-4]]}) AS {f}" for f in names)
    std = {f: f"(CASE WHEN stddev_pop(f.{f}) > 1e-9 * greatest(1, abs(avg(f.{f}))) THEN stddev_pop(f.{f}) END)" for f in names}
    a = ", ".join(f"coalesce(covar_pop(f.{x}, f.{y}) / ({std[x]} * {std[y]}), 0)" if x != y else f"CASE WHEN {std[x]} IS NULL THEN 0 ELSE 1 END"
                  for x in names for y in names)
    c = ", ".join(f"coalesce(covar_pop(f.{x}, f.t_max) / {std[x]}, 0)" for x in names)
    trials = ", ".join(f"({n}, {t['reg']!r}::DOUBLE, {t['elastic']!r}::DOUBLE)" for n, t in enumerate(KFOLD_TRIALS))
    guess = " + ".join(f"coalesce(cd.b{j} / fits.std[{j}], 0) * (f.{x} - fits.mean[{j}])" for j, x in enumerate(names, 1))
    return f"""WITH RECURSIVE {SQL_TARGETS},
f AS (SELECT t_max, ({sql_hash32('ds', "'42'", "'kfold'")} % 5)::INTEGER AS fold, {cols} FROM dt),
trials AS (SELECT * FROM (VALUES {trials}) v(t, reg, elastic)),
fits AS (SELECT k.fold, [{a}] AS a, [{c}] AS c, avg(f.t_max) AS my, [{', '.join(f'avg(f.{x})' for x in names)}] AS mean,
                [{', '.join(std[x] for x in names)}] AS std
         FROM (SELECT DISTINCT fold FROM f) k JOIN f ON f.fold <> k.fold GROUP BY k.fold),
{_sql_descent(d)},
loss AS (SELECT t, reg, elastic, cd.fold, round(sqrt(avg((f.t_max - fits.my - ({guess})) ** 2)), 6) AS rmse
         FROM cd JOIN fits USING (fold) JOIN f USING (fold) WHERE s = (SELECT max(s) FROM cd) GROUP BY ALL),
l AS (SELECT *, row_number() OVER (ORDER BY t, fold) AS k FROM loss),
walk AS (
  SELECT 0::BIGINT AS k, []::STRUCT(t INTEGER, reg DOUBLE, elastic DOUBLE, fold INTEGER, rmse DOUBLE, pruned BOOLEAN)[] AS kept
  UNION ALL
  SELECT l.k, CASE WHEN len(list_filter(kept, lambda x: x.t = l.t AND x.pruned)) > 0 THEN kept ELSE list_append(kept, {{
    't': l.t, 'reg': l.reg, 'elastic': l.elastic, 'fold': l.fold, 'rmse': l.rmse, 'pruned': coalesce(l.rmse > list_aggregate(
      list_transform(list_filter(kept, lambda x: x.fold = l.fold AND x.t < l.t), lambda x: x.rmse), 'median'), false)}}) END
  FROM walk JOIN l ON l.k = walk.k + 1)
SELECT x.t AS trial, round(x.reg, 9) AS reg, x.elastic, x.fold, x.rmse, x.pruned
FROM (SELECT unnest(kept) AS x FROM walk WHERE k = (SELECT max(k) FROM walk))"""


@query("kfold_search", _sql_kfold())
def q_kfold_search(spark, sf_dir):
    """M9 on the daily maximum: ten trials, five folds by hash, all fitted from one pass of sums."""
    d = kfold(ts.cyclic_features(daily_targets(spark, sf_dir), "ds"), "ds", 5, 42)
    losses = gram.kfold_losses(d, WEATHER_FEATURES, "t_max", "fold", KFOLD_TRIALS)
    kept = gram.median_pruning(losses.withColumn("rmse", F.round("rmse", 6)))
    return kept.select("trial", F.round("reg", 9).alias("reg"), "elastic", "fold", "rmse", "pruned")


@query("forecast_model_verdict")
def q_forecast_model_verdict(spark, sf_dir):
    """F1: the fitted weather model scored for the held-out dates and compared with their forecasts."""
    p = q_weather_regression(spark, sf_dir).groupBy(F.col("ds").alias("date")).pivot("target", ["t_max", "t_min", "t_wind"]) \
        .agg(F.first("prediction"))
    preds = p.select("date", F.col("t_max").alias("p_max"), F.col("t_min").alias("p_min"), F.col("t_wind").alias("p_wind"))
    return wx.compare(preds, records(spark, sf_dir), target_stats(spark, sf_dir))


@query("weather_regression")
def q_weather_regression(spark, sf_dir):
    d = ts.cyclic_features(daily_targets(spark, sf_dir), "ds")
    feats = WEATHER_FEATURES
    d = hash_split(d, "ds", 0.2, 42)
    train = d.filter(F.col("split") == "train")
    out = None
    for t in ("t_max", "t_min", "t_wind"):
        st = train.agg(F.avg(t).alias("m"), F.stddev_samp(t).alias("s"))
        w = d.crossJoin(F.broadcast(st)).withColumn("_w", ml.extreme_weight(t, F.col("m"), F.col("s")))
        model = ml.regression(feats, t, weight="_w", regParam=0.01, solver="normal").fit(w.filter(F.col("split") == "train"))
        p = model.transform(w.filter(F.col("split") == "test")).select(
            "ds", F.lit(t).alias("target"), F.col(t).alias("actual"), "prediction")
        out = p if out is None else out.unionByName(p)
    return out


SQL_KERNEL = f"""
WITH RECURSIVE {SQL_SAMPLED},
e AS (SELECT vec_id, CASE WHEN label = 0 THEN 1 ELSE -1 END AS y, embedding::DOUBLE[] AS v,
             {sql_unit_hash('vec_id', "'42'", "'holdout'")} < 0.2::DOUBLE AS test FROM embeddings),
cn AS (SELECT label, centre, row_number() OVER (ORDER BY label) AS k FROM cv),
ph AS (SELECT e.vec_id, e.y, e.test, cn.k, exp(-list_sum(list_transform(list_zip(e.v, cn.centre), lambda p: (p[1] - p[2]) * (p[1] - p[2])))
              / (2 * sg.sigma * sg.sigma)) AS phi FROM e, cn, sg),
nt AS (SELECT count(*)::DOUBLE AS n, avg(y) AS my FROM e WHERE NOT test),
ga AS (SELECT a.k AS i, b.k AS j, sum(a.phi * b.phi) + CASE WHEN a.k = b.k THEN any_value(nt.n) * 1e-9::DOUBLE ELSE 0 END AS v
       FROM ph a JOIN ph b USING (vec_id) CROSS JOIN nt WHERE NOT a.test GROUP BY a.k, b.k
       UNION ALL SELECT k, {CENTRES} + 1, sum(phi * y) FROM ph WHERE NOT test GROUP BY k),
m0 AS (SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(v ORDER BY j) AS r FROM ga GROUP BY i)),
-- elimination without row exchange: the matrix is positive definite
el AS (SELECT 0 AS k, m FROM m0 UNION ALL
       SELECT k + 1, list_transform(m, lambda r, i: list_transform(r, lambda x, j:
                CASE WHEN i = k + 1 THEN x / r[k + 1] ELSE x - r[k + 1] * m[k + 1][j] / m[k + 1][k + 1] END)) FROM el WHERE k < {CENTRES}),
w AS (SELECT list_transform(m, lambda r: r[{CENTRES} + 1]) AS w FROM el WHERE k = {CENTRES}),
pr AS (SELECT vec_id, y, CASE WHEN sum(phi * w.w[k]) > any_value(nt.my) THEN 1 ELSE -1 END AS predicted
       FROM ph CROSS JOIN w CROSS JOIN nt WHERE test GROUP BY vec_id, y)"""


def _kernel_frame(spark, sf_dir):
    """Vectors with y = 1 for one class and -1 for the others, held out by hash, and the centres drawn from all vectors."""
    e = embeddings(spark, sf_dir).select("vec_id", F.col("embedding").cast("array<double>").alias("v"),
                                         F.when(F.col("label") == 0, 1).otherwise(-1).alias("y"))
    return hash_split(e, "vec_id", 0.2, 42), sampled_centres(spark, sf_dir)


def _rbf_predictions(spark, sf_dir):
    d, c = _kernel_frame(spark, sf_dir)
    sigma = vx.dmax_sigma(c).first().sigma
    centres = np.array([r.centre for r in c.orderBy("label").toLocalIterator()])  # CENTRES rows
    train, gamma = d.where("split = 'train'"), 1 / (2 * sigma * sigma)
    weights = gram.radial_network(train, "v", "y", centres, gamma)
    out = gram.radial_scores(d.where("split = 'test'"), ["vec_id", "y"], "v", centres, gamma, weights)
    # the threshold is the mean of the training labels
    mean = train.agg(F.avg("y").alias("_m"))
    return attach_row(out, mean).select("vec_id", "y", F.when(F.col("score") > F.col("_m"), 1).otherwise(-1).alias("predicted"))


@query("rbf_classifier", f"{SQL_KERNEL} SELECT vec_id, y, predicted FROM pr")
def q_rbf_classifier(spark, sf_dir):
    return _rbf_predictions(spark, sf_dir)


@query("rbf_confusion", f"{SQL_KERNEL} SELECT y AS label, predicted AS prediction, count(*) AS n FROM pr GROUP BY ALL")
def q_rbf_confusion(spark, sf_dir):
    return metrics.confusion(_rbf_predictions(spark, sf_dir), "y", "predicted")


#: Landmarks of the kernel map, drawn by hash.
LANDMARKS = 128


def _svc_predictions(spark, sf_dir):
    d, _ = _kernel_frame(spark, sf_dir)
    train = d.where("split = 'train'")
    drawn = pick_k(train, "vec_id", LANDMARKS, 42, "landmarks").select("v").toLocalIterator()  # LANDMARKS rows
    features = gram.Nystroem(np.array([r.v for r in drawn]), gram.scale_gamma(train, "v"))
    mapped = features.transform(spark, d, ["vec_id", "y", "split"], "v").withColumn("y01", ((F.col("y") + 1) / 2).cast("double"))
    model = LinearSVC(featuresCol="_x", labelCol="y01", maxIter=50, regParam=0.01).fit(mapped.where("split = 'train'"))
    out = model.transform(mapped.where("split = 'test'"))
    return out.select("vec_id", "y", F.when(F.col("prediction") > 0, 1).otherwise(-1).alias("predicted"))


@query("kernel_svc")
def q_kernel_svc(spark, sf_dir):
    return _svc_predictions(spark, sf_dir)


@query("kernel_svc_report")
def q_kernel_svc_report(spark, sf_dir):
    """Precision, recall and F1 of the margin classifier on the held-out vectors."""
    return metrics.class_report(_svc_predictions(spark, sf_dir), "y", "predicted")


@query("model_timings")
def q_model_timings(spark, sf_dir):
    """Wall-clock and per-sample seconds of predicting the held-out documents and vectors."""
    return ex.timing_report({"naive_bayes": nb_predictions(spark, sf_dir), "radial_network": _rbf_predictions(spark, sf_dir)})
