"""Streaming re-aims.

* ``load_totals``: 5-minute event totals with an event-time watermark; rows
  later than the watermark are dropped by Spark, state for closed windows
  is released.
* ``forecast_verdicts``: forecast documents landing as JSON files are read
  with the explicit schema and compared with a static table of model
  predictions (stream-static join) as they arrive.
* ``polled_verdicts``: the same for a source that is polled: copies are dropped,
  and only the newest document of a date counts, whatever the order of arrival.
* ``run_available_now``: process everything available, then stop (the batch
  form of a scheduled poll); checkpoints go to the given folder, which on a
  cluster must be shared storage.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from kiln.operators import weather as wx


def event_stream(spark: SparkSession, folder: str, schema, name_glob: str = "events*.parquet") -> DataFrame:
    """Parquet files appearing in ``folder`` as a stream (schema given)."""
    return (spark.readStream.schema(schema).option("pathGlobFilter", name_glob)
            .option("maxFilesPerTrigger", 64).parquet(folder)
            .withColumn("ts", F.col("ts").cast("timestamp")))


def load_totals(events: DataFrame, window: str = "5 minutes", watermark: str = "10 minutes") -> DataFrame:
    """F8: (window_start, window_end, n_events, value_sum) per event-time window."""
    return (events.withWatermark("ts", watermark)
            .groupBy(F.window("ts", window))
            .agg(F.count(F.lit(1)).alias("n_events"),
                 F.sum(F.col("value").cast("decimal(18,2)")).alias("value_sum"))
            .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                    "n_events", "value_sum"))


def forecast_verdicts(spark: SparkSession, landing: str, predictions: DataFrame, stats: DataFrame) -> DataFrame:
    """verdicts for each forecast document as it lands (stream-static
    inner join on the date; a document that arrived was fetched)."""
    recs = spark.readStream.schema(wx.FORECAST_SCHEMA).json(landing)
    api = recs.select("date", F.lit(True).alias("_fetched"), F.col("general").alias("_g"))
    j = api.join(predictions, "date").crossJoin(F.broadcast(stats))
    return wx.verdict_columns(j)


_RECORD = "date date, updated timestamp, document string"


def _newest(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The newest of the documents of one date, if it is newer than what was passed on before."""
    if state.hasTimedOut:
        state.remove()
        return
    rows = pd.concat(list(parts))
    best = rows.loc[rows["updated"].idxmax()]
    before = state.get[0] if state.exists else None
    if before is None or best["updated"].to_pydatetime() > before:
        state.update((best["updated"].to_pydatetime(),))
        yield pd.DataFrame([best])[["date", "updated", "document"]]
    state.setTimeoutTimestamp(int(pd.Timestamp(best["updated"]).timestamp() * 1000) + _KEEP_MS)


#: How long a date's newest time is remembered behind the watermark.
_KEEP_MS = 30 * 24 * 3600 * 1000


def newest_forecasts(spark: SparkSession, landing: str, watermark: str = "3 days") -> DataFrame:
    """(date, updated, document) of polled forecast documents, each time a newer one of its date arrives.

    ``landing`` receives one JSON document per line, the same ones again and again. Copies (date and update time) are dropped within
    the watermark, documents older than it are late and dropped, and the newest update time of each date is kept in
    state, so that an older document that arrives after a newer one changes nothing. Documents without date or update time are
    left out. After a restart from the checkpoint the state goes on where it was.
    """
    doc = F.from_json("value", "date date, updatedTimestamp timestamp")
    polled = (spark.readStream.text(landing).select(doc.alias("d"), F.col("value").alias("document"))
              .select(F.col("d.date").alias("date"), F.col("d.updatedTimestamp").alias("updated"), "document")
              .where("date IS NOT NULL AND updated IS NOT NULL").withWatermark("updated", watermark)
              .dropDuplicatesWithinWatermark(["date", "updated"]))
    return polled.groupBy("date").applyInPandasWithState(
        _newest, _RECORD, "newest timestamp", "append", GroupStateTimeout.EventTimeTimeout)


def polled_verdicts(spark: SparkSession, landing: str, predictions: DataFrame, stats: DataFrame, watermark: str = "3 days") -> DataFrame:
    """(date, updated, verdict columns): a verdict for each date, and a new one whenever a newer forecast arrives."""
    recs = newest_forecasts(spark, landing, watermark).select("date", "updated", F.from_json("document", wx.FORECAST_SCHEMA).alias("r"))
    api = recs.select("date", "updated", F.lit(True).alias("_fetched"), F.col("r.general").alias("_g"))
    return api.join(predictions, "date").crossJoin(F.broadcast(stats)).select("updated", *wx.verdict_list())


def latest_verdicts(spark: SparkSession, table: str) -> DataFrame:
    """What ``polled_verdicts`` has appended to the Parquet folder ``table``: the newest row of each date."""
    rows = spark.read.parquet(table)
    return rows.groupBy("date").agg(F.max_by(F.struct(*rows.columns), "updated").alias("r")).select("r.*")


def run_available_now(df: DataFrame, checkpoint: str, sink=None, mode: str = "append",
                      fmt: str = "parquet", path: str | None = None):
    """Run a streaming frame over all available input, then stop.

    ``sink`` may be a ``foreachBatch`` function (batch_df, batch_id); else
    rows go to ``fmt`` at ``path``.
    """
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if sink is not None:
        w = w.foreachBatch(sink)
    else:
        w = w.format(fmt).option("path", path)
    q = w.start()
    q.awaitTermination()
    return q
