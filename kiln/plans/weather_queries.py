"""Registered forecast-record queries (W4): records are built per day from
``events`` (to_json), parsed back with the explicit schema (from_json),
flattened, exploded and compared with a persistence model.

The documents have gaps, as live ones do: by day of the year modulo 11, 3 has
no general section, 5 no temperature, 7 no wind and 9 no forecast text. Wind
takes the values of one event type so that it differs from temperature."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from kiln.operators import weather as wx
from kiln.plans import query
from kiln.plans.series_queries import SQL_TARGETS, daily_targets, target_stats
from kiln.sources.tables import load


def forecast_json(spark, sf_dir):
    """One JSON forecast document per day of events."""
    ev = load(spark, sf_dir, "events").select(
        "ts", "event_type", "value", F.get_json_object("props", "$.k").cast("int").alias("k"))
    ev = ev.withColumn("date", F.to_date("ts")).withColumn("period", (F.hour("ts") / 6).cast("int"))
    day = ev.groupBy("date").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.min("k").alias("hlo"),
        F.max("k").alias("hhi"), F.count(F.lit(1)).alias("n"),
        F.min(F.when(F.col("event_type") == "view", F.col("value"))).alias("wlo"),
        F.max(F.when(F.col("event_type") == "view", F.col("value"))).alias("whi"))
    reg = (ev.groupBy("date", "period", "event_type").agg(F.count(F.lit(1)).alias("c"))
           .groupBy("date", "period").agg(F.map_from_entries(F.collect_list(F.struct(
               "event_type", F.struct(F.upper(F.substring("event_type", 1, 2)).alias("code"),
                                      F.format_string("%d events", "c").alias("text"))))).alias("regions")))
    start = F.col("date").cast("timestamp") + F.make_dt_interval(F.lit(0), F.col("period") * 6)
    per = reg.select("date", F.struct(
        "period", F.struct(start.alias("start"), (start + F.expr("INTERVAL 6 HOURS")).alias("end"),
                           F.format_string("period %d", "period").alias("text")).alias("timePeriod"),
        "regions").alias("p"))
    periods = per.groupBy("date").agg(F.array_sort(
        F.collect_list("p"), lambda a, b: a["period"] - b["period"]).alias("ps"))
    gap = F.dayofyear("date") % 11

    def unless(n, section):
        return F.when(gap != n, section)

    rec = day.join(periods, "date").select(
        "date", F.col("date").cast("timestamp").alias("updatedTimestamp"),
        F.col("date").cast("timestamp").alias("timestamp"),
        unless(3, F.struct(
            unless(5, F.struct(F.col("lo").alias("low"), F.col("hi").alias("high"),
                               F.lit("Degrees Celsius").alias("unit"))).alias("temperature"),
            F.struct(F.col("hlo").cast("double").alias("low"), F.col("hhi").cast("double").alias("high"),
                     F.lit("Percentage").alias("unit")).alias("relativeHumidity"),
            unless(9, F.struct(F.lit("EV").alias("code"), F.format_string("%d events", "n").alias("text"))).alias("forecast"),
            F.struct(F.col("date").cast("timestamp").alias("start"),
                     (F.col("date").cast("timestamp") + F.expr("INTERVAL 1 DAY")).alias("end"),
                     F.lit("day").alias("text")).alias("validPeriod"),
            unless(7, F.struct(F.struct(F.col("wlo").alias("low"), F.col("whi").alias("high")).alias("speed"),
                               F.lit("VAR").alias("direction"))).alias("wind"))).alias("general"),
        F.transform("ps", lambda x: F.struct(x["timePeriod"].alias("timePeriod"),
                                             x["regions"].alias("regions"))).alias("periods"))
    return rec.select(F.to_json(F.struct(*rec.columns)).alias("record"))


def records(spark, sf_dir):
    return wx.parse_records(forecast_json(spark, sf_dir))


SQL_DAY = """
ev AS (SELECT ts, event_type, value, json_extract(props, '$.k')::INTEGER AS k, ts::DATE AS date,
              (hour(ts) // 6)::INTEGER AS period FROM events),
d0 AS (SELECT date, dayofyear(date) % 11 AS gap, min(value) AS lo, max(value) AS hi, min(k)::DOUBLE AS hlo,
              max(k)::DOUBLE AS hhi, count(*) AS n, min(CASE WHEN event_type = 'view' THEN value END) AS wlo,
              max(CASE WHEN event_type = 'view' THEN value END) AS whi FROM ev GROUP BY date),
day AS (SELECT date, gap <> 3 AS general, CASE WHEN gap NOT IN (3, 5) THEN lo END AS lo,
               CASE WHEN gap NOT IN (3, 5) THEN hi END AS hi, CASE WHEN gap <> 3 THEN hlo END AS hlo,
               CASE WHEN gap <> 3 THEN hhi END AS hhi, CASE WHEN gap NOT IN (3, 7) THEN wlo END AS wlo,
               CASE WHEN gap NOT IN (3, 7) THEN whi END AS whi,
               CASE WHEN gap NOT IN (3, 9) THEN format('{} events', n) END AS txt FROM d0)"""


@query("forecast_flatten", f"""WITH {SQL_DAY}
SELECT date, lo AS temp_low, hi AS temp_high, hlo AS humidity_low, hhi AS humidity_high,
       wlo AS wind_low, whi AS wind_high, txt AS forecast_text FROM day""")
def q_forecast_flatten(spark, sf_dir):
    return wx.flatten(records(spark, sf_dir))


@query("forecast_region", f"""WITH {SQL_DAY},
c AS (SELECT date, period, event_type, count(*) AS c FROM ev GROUP BY ALL),
p AS (SELECT DISTINCT date, period FROM ev),
r AS (SELECT DISTINCT event_type AS region FROM events)
SELECT p.date, p.period, r.region, coalesce(format('{{}} events', c.c), 'N/A') AS text
FROM p CROSS JOIN r LEFT JOIN c ON c.date = p.date AND c.period = p.period AND c.event_type = r.region""")
def q_forecast_region(spark, sf_dir):
    regions = load(spark, sf_dir, "events").select(F.col("event_type").alias("region"))
    return wx.region_texts(records(spark, sf_dir), regions)


def persistence(spark, sf_dir, lag_days=1):
    """a model's prediction for date d is the target row of d - lag."""
    d = daily_targets(spark, sf_dir)
    return d.select(F.date_add("ds", lag_days).alias("date"), F.col("t_max").alias("p_max"),
                    F.col("t_min").alias("p_min"), F.col("t_wind").alias("p_wind"))


Z = ["model_temp_z", "api_temp_z", "model_wind_z", "api_wind_z"]


VERDICT_SQL = f"""WITH {SQL_DAY}, {SQL_TARGETS},
pr AS (SELECT ds + INTERVAL 1 DAY AS date, t_max AS p_max, t_min AS p_min, t_wind AS p_wind FROM dt),
j AS (SELECT pr.date::DATE AS date, pr.*, day.date IS NOT NULL AS fetched, day.general, day.lo, day.hi, day.whi,
             (mean_max + mean_min) / 2.0 AS tm, (std_max + std_min) / 2.0 AS tsd, mean_wind, std_wind
      FROM pr LEFT JOIN day ON day.date = pr.date::DATE CROSS JOIN st),
z AS (SELECT date, fetched, general, lo, whi,
             abs((p_max + p_min) / 2.0 - tm) / (tsd + 1e-8) AS model_temp_z,
             abs((lo + hi) / 2.0 - tm) / (tsd + 1e-8) AS api_temp_z,
             abs(p_wind - mean_wind) / (std_wind + 1e-8) AS model_wind_z,
             abs(whi - mean_wind) / (std_wind + 1e-8) AS api_wind_z FROM j)
SELECT date, round(model_temp_z, 6) AS model_temp_z, round(api_temp_z, 6) AS api_temp_z,
       CASE WHEN NOT fetched THEN 'api_fetch_failed' WHEN NOT general THEN 'api_data_missing' WHEN lo IS NULL THEN 'error'
            WHEN model_temp_z > api_temp_z THEN 'model' WHEN api_temp_z > model_temp_z THEN 'api'
            ELSE 'equal' END AS temperature,
       round(model_wind_z, 6) AS model_wind_z, round(api_wind_z, 6) AS api_wind_z,
       CASE WHEN NOT fetched THEN 'api_fetch_failed' WHEN NOT general THEN 'api_data_missing' WHEN whi IS NULL THEN 'error'
            WHEN model_wind_z > api_wind_z THEN 'model' WHEN api_wind_z > model_wind_z THEN 'api'
            ELSE 'equal' END AS wind
FROM z"""


@query("forecast_verdict", VERDICT_SQL)
def q_forecast_verdict(spark, sf_dir):
    c = wx.compare(persistence(spark, sf_dir), records(spark, sf_dir), target_stats(spark, sf_dir))
    return c.select("date", *[F.round(z, 6).alias(z) if z in Z else F.col(z)
                              for z in c.columns if z != "date"])


@query("forecast_summary", f"""WITH {SQL_DAY}, {SQL_TARGETS},
m AS (SELECT (ds + INTERVAL 1 DAY)::DATE AS date, t_max AS p_max, t_min AS p_min, t_wind AS p_wind FROM dt
      UNION ALL
      SELECT (a.ds + INTERVAL 2 DAY)::DATE, (a.t_max + b.t_max) / 2.0, (a.t_min + b.t_min) / 2.0,
             (a.t_wind + b.t_wind) / 2.0
      FROM dt a JOIN dt b ON b.ds = a.ds + INTERVAL 1 DAY),
e AS (SELECT date, max(p_max) AS ens_max, min(p_min) AS ens_min, max(p_wind) AS ens_wind FROM m GROUP BY date)
SELECT e.date, round(ens_max, 6) AS ens_max, round(ens_min, 6) AS ens_min, round(ens_wind, 6) AS ens_wind,
       CASE WHEN day.date IS NULL THEN 'api_fetch_failed' WHEN lo IS NULL OR hi IS NULL THEN NULL
            WHEN abs((ens_max + ens_min) / 2.0 - 25.0) > abs((lo + hi) / 2.0 - 25.0) THEN 'model'
            ELSE 'api' END AS temperature,
       CASE WHEN day.date IS NULL THEN 'api_fetch_failed' WHEN whi IS NULL THEN NULL
            WHEN ens_wind > whi THEN 'model' ELSE 'api' END AS wind, coalesce(txt, 'N/A') AS forecast_text
FROM e LEFT JOIN day ON day.date = e.date""")
def q_forecast_summary(spark, sf_dir):
    s = wx.ensemble_summary(model_forecasts(spark, sf_dir), records(spark, sf_dir))
    return s.select("date", *[F.round(c, 6).alias(c) for c in ("ens_max", "ens_min", "ens_wind")],
                    "temperature", "wind", "forecast_text")


def model_forecasts(spark, sf_dir):
    """(date, model, p_*): yesterday's targets, and the mean of the two days before."""
    d = daily_targets(spark, sf_dir)
    w = Window.orderBy("ds")  # one row per day: bounded by the calendar
    two = (d.withColumn("pd", F.lag("ds").over(w)).withColumn("pmx", F.lag("t_max").over(w))
           .withColumn("pmn", F.lag("t_min").over(w)).withColumn("pw", F.lag("t_wind").over(w))
           .filter(F.datediff("ds", "pd") == 1)
           .select(F.date_add("ds", 1).alias("date"), F.lit("mean2").alias("model"),
                   ((F.col("t_max") + F.col("pmx")) / 2.0).alias("p_max"),
                   ((F.col("t_min") + F.col("pmn")) / 2.0).alias("p_min"),
                   ((F.col("t_wind") + F.col("pw")) / 2.0).alias("p_wind")))
    return persistence(spark, sf_dir, 1).withColumn("model", F.lit("last")).unionByName(two)


@query("forecast_report", f"""WITH {SQL_DAY}, {SQL_TARGETS},
m AS (SELECT 'last' AS model, (ds + INTERVAL 1 DAY)::DATE AS date, t_max AS p_max, t_min AS p_min, t_wind AS p_wind FROM dt
      UNION ALL
      SELECT 'mean2', (a.ds + INTERVAL 2 DAY)::DATE, (a.t_max + b.t_max) / 2.0, (a.t_min + b.t_min) / 2.0,
             (a.t_wind + b.t_wind) / 2.0
      FROM dt a JOIN dt b ON b.ds = a.ds + INTERVAL 1 DAY),
j AS (SELECT m.*, day.date IS NOT NULL AS fetched, coalesce(day.general, FALSE) AS general, day.lo, day.hi, day.whi, day.txt,
             (mean_max + mean_min) / 2.0 AS tm, (std_max + std_min) / 2.0 AS tsd, mean_wind, std_wind
      FROM m LEFT JOIN day ON day.date = m.date CROSS JOIN st),
z AS (SELECT *, abs((p_max + p_min) / 2.0 - tm) / (tsd + 1e-8) AS zmt, abs((lo + hi) / 2.0 - tm) / (tsd + 1e-8) AS zat,
             abs(p_wind - mean_wind) / (std_wind + 1e-8) AS zmw, abs(whi - mean_wind) / (std_wind + 1e-8) AS zaw FROM j)
SELECT model, date, round(p_max, 6) AS p_max, round(p_min, 6) AS p_min, round(p_wind, 6) AS p_wind, fetched AS api_data_fetched,
       round((p_max + p_min) / 2.0, 6) AS model_avg_temp, round((lo + hi) / 2.0, 6) AS api_avg_temp, round(whi, 6) AS api_wind,
       coalesce(txt, 'N/A') AS forecast_text, round(zmt, 6) AS model_temp_z, round(zat, 6) AS api_temp_z,
       round(zmw, 6) AS model_wind_z, round(zaw, 6) AS api_wind_z,
       CASE WHEN NOT fetched THEN 'api_fetch_failed' WHEN NOT general THEN 'api_data_missing' WHEN lo IS NULL THEN 'error'
            WHEN zmt > zat THEN 'model' WHEN zat > zmt THEN 'api' ELSE 'equal' END AS temperature,
       CASE WHEN NOT fetched THEN 'api_fetch_failed' WHEN NOT general THEN 'api_data_missing' WHEN whi IS NULL THEN 'error'
            WHEN zmw > zaw THEN 'model' WHEN zaw > zmw THEN 'api' ELSE 'equal' END AS wind
FROM z""")
def q_forecast_report(spark, sf_dir):
    return wx.verbose_report(model_forecasts(spark, sf_dir), records(spark, sf_dir), target_stats(spark, sf_dir))
