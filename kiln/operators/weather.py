"""Nested forecast records and model-vs-forecast comparison (S5, C1-C5,
F1-F6, A22, X2-X3).

A forecast record is a nested STRUCT / ARRAY / MAP document. Records land
as JSON text; ``parse_records`` reads them with an explicit schema (never
inferred), ``flatten`` picks nested fields, ``region_texts`` explodes
periods x regions with a default for missing keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.operators.common import attach_row

EPS = 1e-8
# Fixed value of the short summary: temperatures are compared by their
# distance to 25 degrees.
SUMMARY_TEMP = 25.0

_LH = T.StructType([T.StructField("low", T.DoubleType()), T.StructField("high", T.DoubleType()),
                    T.StructField("unit", T.StringType())])
_CT = T.StructType([T.StructField("code", T.StringType()), T.StructField("text", T.StringType())])
_SPAN = T.StructType([T.StructField("start", T.TimestampType()), T.StructField("end", T.TimestampType()),
                      T.StructField("text", T.StringType())])
FORECAST_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("updatedTimestamp", T.TimestampType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("general", T.StructType([
        T.StructField("temperature", _LH),
        T.StructField("relativeHumidity", _LH),
        T.StructField("forecast", _CT),
        T.StructField("validPeriod", _SPAN),
        T.StructField("wind", T.StructType([
            T.StructField("speed", T.StructType([T.StructField("low", T.DoubleType()),
                                                 T.StructField("high", T.DoubleType())])),
            T.StructField("direction", T.StringType())])),
    ])),
    T.StructField("periods", T.ArrayType(T.StructType([
        T.StructField("timePeriod", _SPAN),
        T.StructField("regions", T.MapType(T.StringType(), _CT)),
    ]))),
])


def parse_records(json_text: DataFrame, col: str = "record") -> DataFrame:
    """JSON text -> typed record columns (explicit schema)."""
    return json_text.select(F.from_json(F.col(col), FORECAST_SCHEMA).alias("r")).select("r.*")


def read_records(spark, path: str) -> DataFrame:
    """S5 over landed files (one JSON document per line)."""
    return spark.read.schema(FORECAST_SCHEMA).json(path)


def flatten(records: DataFrame) -> DataFrame:
    """The general section as flat columns."""
    g = "general"
    return records.select(
        "date",
        F.col(f"{g}.temperature.low").alias("temp_low"), F.col(f"{g}.temperature.high").alias("temp_high"),
        F.col(f"{g}.relativeHumidity.low").alias("humidity_low"),
        F.col(f"{g}.relativeHumidity.high").alias("humidity_high"),
        F.col(f"{g}.wind.speed.low").alias("wind_low"), F.col(f"{g}.wind.speed.high").alias("wind_high"),
        F.col(f"{g}.forecast.text").alias("forecast_text"))


def region_texts(records: DataFrame, regions: DataFrame, default: str = "N/A") -> DataFrame:
    """(date, period, region, text) for every period and every distinct region of ``regions`` (region);
    a region missing from a period gets ``default``. The region names travel as one row."""
    names = regions.agg(F.array_sort(F.collect_set("region")).alias("_names"))
    p = records.select("date", F.posexplode("periods").alias("period", "p"))
    return attach_row(p, names).select("date", "period", F.explode("_names").alias("region"), "p").select(
        "date", "period", "region",
        F.coalesce(F.try_element_at("p.regions", F.col("region"))["text"], F.lit(default)).alias("text"))


def z_abs(x: Column, mean: Column, std: Column, eps: float = EPS) -> Column:
    """|x - mean| / (std + eps)."""
    return F.abs(x - mean) / (std + F.lit(eps))


def verdict(model_z: Column, api_z: Column) -> Column:
    """the more extreme forecast wins; exact tie -> 'equal'."""
    return (F.when(model_z > api_z, "model").when(api_z > model_z, "api").otherwise("equal"))


def compare(pred: DataFrame, records: DataFrame, stats: DataFrame) -> DataFrame:
    """F2-F4 per date. ``pred``: (date, p_max, p_min, p_wind); ``records``:
    parsed forecasts; ``stats``: one row of train means / stds."""
    api = records.select("date", F.lit(True).alias("_fetched"), F.col("general").alias("_g"))
    return verdict_columns(pred.join(api, "date", "left").crossJoin(F.broadcast(stats)))


def verdict_columns(j: DataFrame) -> DataFrame:
    """The F2-F4 projection over (date, p_*, _fetched, _g, stats columns);
    shared by the batch comparison and the streaming one."""
    return j.select(*verdict_list())


def verdict_list() -> list[Column]:
    t_mean = (F.col("mean_max") + F.col("mean_min")) / 2.0
    t_std = (F.col("std_max") + F.col("std_min")) / 2.0
    m_avg = (F.col("p_max") + F.col("p_min")) / 2.0
    a_avg = (F.col("_g.temperature.low") + F.col("_g.temperature.high")) / 2.0
    a_wind = F.col("_g.wind.speed.high")
    mz_t, az_t = z_abs(m_avg, t_mean, t_std), z_abs(a_avg, t_mean, t_std)
    mz_w = z_abs(F.col("p_wind"), F.col("mean_wind"), F.col("std_wind"))
    az_w = z_abs(a_wind, F.col("mean_wind"), F.col("std_wind"))

    def status(value_ok: Column, v: Column) -> Column:
        return (F.when(F.col("_fetched").isNull(), "api_fetch_failed")
                .when(F.col("_g").isNull(), "api_data_missing")
                .when(~value_ok, "error").otherwise(v))
    return [
        F.col("date"), mz_t.alias("model_temp_z"), az_t.alias("api_temp_z"),
        status(a_avg.isNotNull(), verdict(mz_t, az_t)).alias("temperature"),
        mz_w.alias("model_wind_z"), az_w.alias("api_wind_z"),
        status(a_wind.isNotNull(), verdict(mz_w, az_w)).alias("wind")]


def verbose_report(preds_long: DataFrame, records: DataFrame, stats: DataFrame, digits: int = 6) -> DataFrame:
    """one wide row per date and model (``preds_long``: date, model, p_*): the prediction, what the record says,
    the z-scores and both verdicts."""
    api = records.select("date", F.lit(True).alias("_fetched"), F.col("general").alias("_g"))
    j = attach_row(preds_long.join(api, "date", "left"), stats)
    low, high = F.col("_g.temperature.low"), F.col("_g.temperature.high")
    wide = j.select(
        "model", *[F.round(c, digits).alias(c) for c in ("p_max", "p_min", "p_wind")],
        F.col("_fetched").isNotNull().alias("api_data_fetched"),
        F.round((F.col("p_max") + F.col("p_min")) / 2.0, digits).alias("model_avg_temp"),
        F.round((low + high) / 2.0, digits).alias("api_avg_temp"), F.round("_g.wind.speed.high", digits).alias("api_wind"),
        F.coalesce("_g.forecast.text", F.lit("N/A")).alias("forecast_text"),
        F.struct(*verdict_list()).alias("_v"))
    z = ("model_temp_z", "api_temp_z", "model_wind_z", "api_wind_z")
    return wide.select("_v.date", *[c for c in wide.columns if c != "_v"],
                       *[F.round(f"_v.{c}", digits).alias(c) for c in z], "_v.temperature", "_v.wind")


def ensemble_summary(preds_long: DataFrame, records: DataFrame) -> DataFrame:
    """A22 + F5: per date the ensemble extremes over models (max of max,
    min of min, max wind), then the short verdict: temperature by distance
    to 25 degrees, wind by a plain greater-than. A record that lacks a value
    gets no verdict on it (NULL), and its forecast text defaults to 'N/A'."""
    ens = preds_long.groupBy("date").agg(F.max("p_max").alias("ens_max"), F.min("p_min").alias("ens_min"),
                                         F.max("p_wind").alias("ens_wind"))
    api = records.select("date", F.col("general.temperature.low").alias("_lo"),
                         F.col("general.temperature.high").alias("_hi"),
                         F.col("general.wind.speed.high").alias("_w"), F.lit(True).alias("_f"),
                         F.coalesce("general.forecast.text", F.lit("N/A")).alias("_text"))
    j = ens.join(api, "date", "left")
    e_avg = (F.col("ens_max") + F.col("ens_min")) / 2.0
    a_avg = (F.col("_lo") + F.col("_hi")) / 2.0
    temp = (F.when(F.col("_f").isNull(), "api_fetch_failed")
            .when(e_avg.isNull() | a_avg.isNull(), F.lit(None).cast("string"))
            .when(F.abs(e_avg - SUMMARY_TEMP) > F.abs(a_avg - SUMMARY_TEMP), "model").otherwise("api"))
    wind = (F.when(F.col("_f").isNull(), "api_fetch_failed")
            .when(F.col("ens_wind").isNull() | F.col("_w").isNull(), F.lit(None).cast("string"))
            .when(F.col("ens_wind") > F.col("_w"), "model").otherwise("api"))
    return j.select("date", "ens_max", "ens_min", "ens_wind", temp.alias("temperature"), wind.alias("wind"),
                    F.coalesce("_text", F.lit("N/A")).alias("forecast_text"))
