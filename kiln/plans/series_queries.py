"""Registered series and regression-metric queries over lineitem, events and
orders (W3/W4 shapes on the driver tables)."""

from __future__ import annotations



from pyspark.sql import Window
from pyspark.sql import functions as F

from kiln.functions.hashing import hash32, sql_hash32, sql_unit_hash, unit_hash
from kiln.operators import experiments as ex
from kiln.operators import metrics
from kiln.operators import timeseries as ts
from kiln.plans import query
from kiln.sources.tables import load

LOOK_BACK = 25


def daily_revenue(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    rev = F.col("l_extendedprice").cast("decimal(15,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    return (li.groupBy(F.to_date("l_shipdate").alias("ds"))
            .agg(F.sum(rev).cast("double").alias("revenue")))


SQL_DAILY = """
daily AS (SELECT l_shipdate::DATE AS ds,
                 sum(l_extendedprice::DECIMAL(15,2) * (1 - l_discount::DECIMAL(4,2)))::DOUBLE AS revenue
          FROM lineitem GROUP BY 1),
cs AS (SELECT ds, revenue, CASE WHEN row_number() OVER (ORDER BY ds) <= floor(count(*) OVER () * 0.8::DOUBLE)
                           THEN 'train' ELSE 'test' END AS split FROM daily),
mm AS (SELECT min(revenue) AS lo, max(revenue) AS hi FROM cs WHERE split = 'train'),
sc AS (SELECT ds, split, revenue,
              (revenue - lo) / CASE WHEN hi - lo = 0 THEN 1.0::DOUBLE ELSE hi - lo END AS scaled FROM cs, mm)"""


@query("load_daily", f"WITH {SQL_DAILY} SELECT ds, revenue FROM daily")
def q_load_daily(spark, sf_dir):
    return daily_revenue(spark, sf_dir)


@query("chrono_split", f"WITH {SQL_DAILY} SELECT ds, split FROM cs")
def q_chrono_split(spark, sf_dir):
    return ts.chrono_split(daily_revenue(spark, sf_dir), "ds").select("ds", "split")


def scaled_series(spark, sf_dir):
    s = ts.chrono_split(daily_revenue(spark, sf_dir), "ds")
    fit = ts.minmax_fit(s.filter(F.col("split") == "train"), "revenue")
    return ts.minmax_apply(s, "revenue", fit, out="scaled")


@query("minmax_scale", f"WITH {SQL_DAILY} SELECT ds, revenue, round(scaled, 6) AS scaled FROM sc")
def q_minmax_scale(spark, sf_dir):
    s = scaled_series(spark, sf_dir)
    return s.select("ds", "revenue", F.round("scaled", 6).alias("scaled"))


@query("minmax_inverse", f"WITH {SQL_DAILY} SELECT ds, round(scaled, 9) AS scaled, round(revenue, 4) AS unscaled FROM sc")
def q_minmax_inverse(spark, sf_dir):
    """Scaled by the training part's range and back."""
    s = scaled_series(spark, sf_dir)
    fit = ts.minmax_fit(s.filter(F.col("split") == "train"), "revenue")
    back = ts.minmax_inverse(s, "scaled", fit)
    return back.select("ds", F.round("scaled", 9).alias("scaled"), F.round("unscaled", 4).alias("unscaled"))


@query("lag_windows", f"""WITH {SQL_DAILY},
p AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY ds) AS pos,
             count(*) OVER (PARTITION BY split) AS n FROM sc),
t AS (SELECT split, ds, scaled AS target, pos, unnest(range(1, {LOOK_BACK + 1})) AS lag FROM p
      WHERE pos > {LOOK_BACK} AND pos <= n - 1)
SELECT t.split, t.ds, round(t.target, 6) AS target, t.lag::INTEGER AS lag, round(f.scaled, 6) AS value
FROM t JOIN p f ON f.split = t.split AND f.pos = t.pos - t.lag""")
def q_lag_windows(spark, sf_dir):
    s = scaled_series(spark, sf_dir)
    lw = ts.lag_windows(s, ["split"], "ds", "scaled", LOOK_BACK, drop_last=True)
    return lw.select("split", "ds", F.round("target", 6).alias("target"), "lag",
                     F.round("value", 6).alias("value"))


@query("grid_5min", """
WITH s AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS slot, count(*) AS n_events,
                  sum(value::DECIMAL(18,2)) AS value_sum FROM events GROUP BY 1),
g AS (SELECT unnest(generate_series(min(slot), max(slot), INTERVAL 5 MINUTE)) AS slot FROM s)
SELECT g.slot, coalesce(s.n_events, 0) AS n_events, coalesce(s.value_sum, 0)::DOUBLE AS value_sum
FROM g LEFT JOIN s USING (slot)""")
def q_grid_5min(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    slots = (ev.groupBy(ts.floor_minutes("ts", 5).alias("slot"))
             .agg(F.count(F.lit(1)).alias("n_events"),
                  F.sum(F.col("value").cast("decimal(18,2)")).alias("value_sum")))
    z = ts.zero_filled(slots, "slot", 5, ["n_events", "value_sum"])
    return z.select(F.col("slot").cast("timestamp_ntz").alias("slot"), "n_events",
                    F.col("value_sum").cast("double").alias("value_sum"))


@query("last_window_filter", """
SELECT event_id, ts, value FROM events
WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOUR AND ts <= (SELECT max(ts) FROM events)""")
def q_last_window_filter(spark, sf_dir):
    ev = load(spark, sf_dir, "events").select("event_id", "ts", "value")
    return ts.last_window(ev, "ts", 24).select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "value")


CYC = ", ".join(
    f"round(sin(2 * pi() * {c} / {p}), 9) AS {c}_sin, round(cos(2 * pi() * {c} / {p}), 9) AS {c}_cos"
    for c, p in (("day_of_year", 365), ("day_of_week", 7), ("month", 12)))


@query("cyclic_features", f"""
SELECT o_orderkey, day_of_year, day_of_week, month, {CYC} FROM (
  SELECT o_orderkey, dayofyear(o_orderdate)::INTEGER AS day_of_year,
         (isodow(o_orderdate) - 1)::INTEGER AS day_of_week, month(o_orderdate)::INTEGER AS month FROM orders)""")
def q_cyclic_features(spark, sf_dir):
    o = ts.cyclic_features(load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate")
    cols = ["o_orderkey", "day_of_year", "day_of_week", "month"]
    for c in ("day_of_year", "day_of_week", "month"):
        cols += [F.round(f"{c}_sin", 9).alias(f"{c}_sin"), F.round(f"{c}_cos", 9).alias(f"{c}_cos")]
    return o.select(*cols)


# ------------------------------------------------------------ daily targets
def daily_targets(spark, sf_dir):
    """Weather-like daily targets from events: max, min and mean value."""
    ev = load(spark, sf_dir, "events")
    return (ev.groupBy(F.to_date("ts").alias("ds"))
            .agg(F.max("value").alias("t_max"), F.min("value").alias("t_min"),
                 (F.sum(F.col("value").cast("decimal(18,2)")) / F.count(F.lit(1))).cast("double").alias("t_wind")))


SQL_TARGETS = f"""
dt AS (SELECT ts::DATE AS ds, max(value) AS t_max, min(value) AS t_min,
              (sum(value::DECIMAL(18,2)) / count(*))::DOUBLE AS t_wind FROM events GROUP BY 1),
tr AS (SELECT * FROM dt WHERE {sql_unit_hash('ds', "'42'", "'holdout'")} >= 0.2::DOUBLE),
st AS (SELECT avg(t_max) AS mean_max, avg(t_min) AS mean_min, avg(t_wind) AS mean_wind,
              stddev_samp(t_max) AS std_max, stddev_samp(t_min) AS std_min, stddev_samp(t_wind) AS std_wind
       FROM tr)"""


def target_stats(spark, sf_dir):
    d = daily_targets(spark, sf_dir)
    train = d.filter(unit_hash(F.col("ds"), 42, "holdout") >= F.lit(0.2))
    return train.agg(F.avg("t_max").alias("mean_max"), F.avg("t_min").alias("mean_min"),
                     F.avg("t_wind").alias("mean_wind"), F.stddev_samp("t_max").alias("std_max"),
                     F.stddev_samp("t_min").alias("std_min"), F.stddev_samp("t_wind").alias("std_wind"))


STATS = ["mean_max", "mean_min", "mean_wind", "std_max", "std_min", "std_wind"]


@query("target_stats", f"WITH {SQL_TARGETS} SELECT {', '.join(f'round({c}, 6) AS {c}' for c in STATS)} FROM st")
def q_target_stats(spark, sf_dir):
    s = target_stats(spark, sf_dir)
    return s.select(*[F.round(c, 6).alias(c) for c in STATS])


@query("kfold_assign", f"""WITH {SQL_TARGETS}
SELECT ds, ({sql_hash32('ds', "'42'", "'kfold'")} % 5)::INTEGER AS fold FROM dt""")
def q_kfold_assign(spark, sf_dir):
    d = daily_targets(spark, sf_dir)
    return d.select("ds", (hash32(F.col("ds"), 42, "kfold") % 5).cast("int").alias("fold"))


@query("cv_summary", f"""WITH {SQL_TARGETS},
f AS (SELECT ds, t_max, (isodow(ds) - 1) AS dow, {sql_hash32('ds', "'42'", "'kfold'")} % 5 AS fold FROM dt),
folds AS (SELECT DISTINCT fold FROM f),
gm AS (SELECT k.fold, avg(f.t_max) AS m FROM folds k JOIN f ON f.fold <> k.fold GROUP BY k.fold),
dm AS (SELECT k.fold, f.dow, avg(f.t_max) AS m FROM folds k JOIN f ON f.fold <> k.fold GROUP BY k.fold, f.dow),
l AS (SELECT 'mean' AS model, v.fold, avg((v.t_max - gm.m) * (v.t_max - gm.m)) AS mse
      FROM f v JOIN gm ON gm.fold = v.fold GROUP BY v.fold
      UNION ALL
      SELECT 'weekday', v.fold, avg((v.t_max - coalesce(dm.m, gm.m)) * (v.t_max - coalesce(dm.m, gm.m)))
      FROM f v JOIN gm ON gm.fold = v.fold LEFT JOIN dm ON dm.fold = v.fold AND dm.dow = v.dow GROUP BY v.fold)
SELECT model, round(avg(mse), 6) AS cv_mse, count(*) AS n_folds FROM l GROUP BY model""")
def q_cv_summary(spark, sf_dir):
    d = daily_targets(spark, sf_dir).select(
        "ds", "t_max", F.weekday("ds").alias("dow"), (hash32(F.col("ds"), 42, "kfold") % 5).alias("fold"))
    # train mean for fold k = (total - fold k) / (n - n_k): no fold x fold join
    tot = d.agg(F.sum("t_max").alias("s"), F.count(F.lit(1)).alias("n"))
    per_fold = d.groupBy("fold").agg(F.sum("t_max").alias("sk"), F.count(F.lit(1)).alias("nk"))
    gm = per_fold.crossJoin(F.broadcast(tot)).select(
        "fold", ((F.col("s") - F.col("sk")) / (F.col("n") - F.col("nk"))).alias("gm"))
    dtot = d.groupBy("dow").agg(F.sum("t_max").alias("s"), F.count(F.lit(1)).alias("n"))
    dfold = d.groupBy("fold", "dow").agg(F.sum("t_max").alias("sk"), F.count(F.lit(1)).alias("nk"))
    dm = dfold.join(dtot, "dow").select(
        "fold", "dow", F.try_divide(F.col("s") - F.col("sk"), F.col("n") - F.col("nk")).alias("dm"))
    # folds with no training rows for a weekday fall back to the fold's mean
    full = d.join(F.broadcast(gm), "fold").join(F.broadcast(dm), ["fold", "dow"], "left")
    e1 = F.col("t_max") - F.col("gm")
    e2 = F.col("t_max") - F.coalesce("dm", "gm")
    per = full.groupBy("fold").agg(F.avg(e1 * e1).alias("mean"), F.avg(e2 * e2).alias("weekday"))
    long = per.select("fold", F.explode(F.array(
        F.struct(F.lit("mean").alias("model"), F.col("mean").alias("mse")),
        F.struct(F.lit("weekday").alias("model"), F.col("weekday").alias("mse")))).alias("x"))
    return (long.groupBy(F.col("x.model").alias("model"))
            .agg(F.round(F.avg("x.mse"), 6).alias("cv_mse"), F.count(F.lit(1)).alias("n_folds")))


@query("combined_loss", f"""WITH {SQL_TARGETS},
p AS (SELECT ds, t_max, t_min, t_wind, lag(t_max) OVER w AS p_max, lag(t_min) OVER w AS p_min,
             lag(t_wind) OVER w AS p_wind FROM dt WINDOW w AS (ORDER BY ds))
SELECT round(sum(
   (p_max - t_max) * (p_max - t_max) * (1 + CASE WHEN abs(t_max - mean_max) > std_max THEN 1.0 ELSE 0.0 END)
 + (p_min - t_min) * (p_min - t_min) * (1 + CASE WHEN abs(t_min - mean_min) > std_min THEN 1.0 ELSE 0.0 END)
 + (p_wind - t_wind) * (p_wind - t_wind) * (1 + CASE WHEN abs(t_wind - mean_wind) > std_wind THEN 1.0 ELSE 0.0 END)
 ) / (count(*) * 3), 6) AS combined_loss
FROM p, st WHERE p_max IS NOT NULL""")
def q_combined_loss(spark, sf_dir):
    d = daily_targets(spark, sf_dir)
    w = Window.orderBy("ds")  # one row per day: bounded by the calendar
    p = (d.withColumn("p_max", F.lag("t_max").over(w)).withColumn("p_min", F.lag("t_min").over(w))
         .withColumn("p_wind", F.lag("t_wind").over(w)).filter(F.col("p_max").isNotNull()))
    p = p.crossJoin(F.broadcast(target_stats(spark, sf_dir)))
    r = metrics.combined_loss(p, ["t_max", "t_min", "t_wind"], ["p_max", "p_min", "p_wind"],
                              [F.col("mean_max"), F.col("mean_min"), F.col("mean_wind")],
                              [F.col("std_max"), F.col("std_min"), F.col("std_wind")],
                              penalty_factor=2.0, alpha=0.5)
    return r.select(F.round("combined_loss", 6).alias("combined_loss"))


# ------------------------------------------------------------ regression metrics
def price_predictions(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity", "l_extendedprice")
    part = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    j = li.join(part, "l_partkey")
    return j.select(F.col("l_extendedprice").cast("decimal(15,2)").alias("y"),
                    (F.col("l_quantity").cast("decimal(15,2)") * F.col("p_retailprice").cast("decimal(15,2)"))
                    .alias("yhat"), "l_quantity", "l_extendedprice")


SQL_PRICE = """
pp AS (SELECT l_extendedprice::DECIMAL(15,2) AS y,
              l_quantity::DECIMAL(15,2) * p_retailprice::DECIMAL(15,2) AS yhat, l_quantity, l_extendedprice
       FROM lineitem JOIN part ON p_partkey = l_partkey)"""


@query("regression_metrics", f"""WITH {SQL_PRICE},
a AS (SELECT sum(abs(yhat - y)) AS sae, sum((yhat - y) * (yhat - y)) AS sse, count(*) AS n,
             sum(y) AS sy, sum(y * y) AS syy FROM pp)
SELECT sae::DOUBLE / n AS mae, sse::DOUBLE / n AS mse, sqrt(sse::DOUBLE / n) AS rmse,
       1 - sse::DOUBLE / (syy::DOUBLE - sy::DOUBLE * sy::DOUBLE / n) AS r2 FROM a""")
def q_regression_metrics(spark, sf_dir):
    p = price_predictions(spark, sf_dir)
    e = F.col("yhat") - F.col("y")
    a = p.agg(F.sum(F.abs(e)).alias("sae"), F.sum(e * e).alias("sse"), F.count(F.lit(1)).alias("n"),
              F.sum("y").alias("sy"), F.sum(F.col("y") * F.col("y")).alias("syy"))
    sse = F.col("sse").cast("double")
    sst = F.col("syy").cast("double") - F.col("sy").cast("double") * F.col("sy").cast("double") / F.col("n")
    return a.select((F.col("sae").cast("double") / F.col("n")).alias("mae"), (sse / F.col("n")).alias("mse"),
                    F.sqrt(sse / F.col("n")).alias("rmse"), (F.lit(1) - F.try_divide(sse, sst)).alias("r2"))


@query("mape", f"""WITH {SQL_PRICE}
SELECT round(avg(abs((y - yhat)::DOUBLE / y::DOUBLE)) * 100, 6) AS mape_pct,
       round(avg(abs((yhat - y)::DOUBLE / (y::DOUBLE + 1e-8))), 6) AS mape_eps FROM pp WHERE y <> 0""")
def q_mape(spark, sf_dir):
    p = price_predictions(spark, sf_dir).filter(F.col("y") != 0)
    p = p.select(F.col("y").cast("double").alias("y"), F.col("yhat").cast("double").alias("yhat"),
                 (F.col("y") - F.col("yhat")).cast("double").alias("d"))
    r = p.agg((F.avg(F.abs(F.col("d") / F.col("y"))) * 100).alias("mape_pct"),
              F.avg(F.abs(-F.col("d") / (F.col("y") + F.lit(1e-8)))).alias("mape_eps"))
    return r.select(F.round("mape_pct", 6).alias("mape_pct"), F.round("mape_eps", 6).alias("mape_eps"))


@query("linreg_simple", """
SELECT round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept,
       round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem""")
def q_linreg_simple(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    return li.agg(F.round(F.regr_slope("l_extendedprice", "l_quantity"), 6).alias("slope"),
                  F.round(F.regr_intercept("l_extendedprice", "l_quantity"), 6).alias("intercept"),
                  F.round(F.regr_r2("l_extendedprice", "l_quantity"), 6).alias("r2"))


@query("block_means", """
SELECT (l_orderkey // 50)::INTEGER AS block, round(avg(q), 6) AS mean
FROM (SELECT l_orderkey, sum(l_quantity)::DOUBLE AS q FROM lineitem GROUP BY l_orderkey) GROUP BY 1 HAVING count(*) = 50""")
def q_block_means(spark, sf_dir):
    """Mean quantity over blocks of fifty orders, full blocks only."""
    history = load(spark, sf_dir, "lineitem").groupBy((F.col("l_orderkey") + 1).alias("n")).agg(F.sum("l_quantity").cast("double").alias("q"))
    return ex.block_means(history, "n", "q", 50).select("block", F.round("mean", 6).alias("mean"))


@query("statistics_document", f"""WITH {SQL_DAILY}
SELECT json_object('first', min(ds)::VARCHAR, 'last', max(ds)::VARCHAR, 'days', count(*), 'train', count(*) FILTER (WHERE split = 'train'))::VARCHAR AS stats
FROM cs""")
def q_statistics_document(spark, sf_dir):
    """What a run was fitted on, as one document."""
    s = ts.chrono_split(daily_revenue(spark, sf_dir), "ds")
    return ex.statistics_document(s.agg(
        F.min("ds").cast("string").alias("first"), F.max("ds").cast("string").alias("last"), F.count(F.lit(1)).alias("days"),
        F.count(F.when(F.col("split") == "train", 1)).alias("train")))


@query("round_down", "SELECT l_orderkey, l_linenumber, ((l_orderkey // 8) * 8)::BIGINT AS size FROM lineitem")
def q_round_down(spark, sf_dir):
    """The largest multiple of eight not above a value."""
    return load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", ex.round_down("l_orderkey", 8).alias("size"))
