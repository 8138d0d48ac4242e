"""Registered queries over files that Spark writes from the tables and reads back (W7): scans, sinks, coercions, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.lineage import Scratch
from kiln.operators import augment as aug
from kiln.operators import fuzzy as fz
from kiln.operators import models
from kiln.operators.common import attach_row
from kiln.plans import query
from kiln.plans import weather_queries as wq
from kiln.plans.series_queries import target_stats
from kiln.plans.text_queries import SQL_TOKENS_CTE, TOK, sql_deletion, sql_swap
from kiln.plans.vocab_queries import SQL_PAIRS, pairs
from kiln.functions.text import tokenize
from kiln.operators import weather as wx
from kiln.sources import files
from kiln.sources.tables import load
from kiln.streaming import jobs


def _folder(spark, name: str) -> str:
    """A fresh path below the shared scratch folder."""
    return f"{Scratch(spark, name).base}/files"


def _lines(df: DataFrame, line, path: str) -> str:
    df.select(line.alias("value")).write.text(path)
    return path


# ------------------------------------------------------------ CSV
CUSTOMER = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


@query("csv_round_trip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def q_csv_round_trip(spark, sf_dir):
    """Customers to CSV with a header and back under their schema."""
    path = _folder(spark, "csv")
    files.write_table(load(spark, sf_dir, "customer"), path, "csv")
    return files.read_csv(spark, path, CUSTOMER)


def broken_csv(spark, sf_dir) -> str:
    """Customers as lines without header: every fifth is short of its last field, every seventh has one more, and every third
    balance is the marker ``na``."""
    k = F.col("c_custkey")
    fields = F.concat_ws(",", k.cast("string"), "c_name", F.col("c_nationkey").cast("string"),
                         F.when(k % 3 == 0, "na").otherwise(F.col("c_acctbal").cast("string")))
    line = F.concat(fields, F.when(k % 7 == 0, F.concat(F.lit(","), "c_mktsegment", F.lit(",more")))
                    .when(k % 5 == 0, "").otherwise(F.concat(F.lit(","), "c_mktsegment")))
    return _lines(load(spark, sf_dir, "customer"), line, _folder(spark, "broken-csv"))


@query("csv_malformed", """
SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END AS c_acctbal,
       CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS c_mktsegment,
       (SELECT count(*) FROM customer WHERE c_custkey % 7 = 0) AS skipped
FROM customer WHERE c_custkey % 7 <> 0""")
def q_csv_malformed(spark, sf_dir):
    """Long lines left out and counted, short ones padded, markers as NULL."""
    path = broken_csv(spark, sf_dir)
    rows = files.read_csv(spark, path, CUSTOMER, header=False, long_lines="skip")
    return attach_row(rows, files.skipped_lines(spark, path, CUSTOMER, header=False))


@query("csv_null_rows", """
SELECT c_custkey, c_acctbal, c_mktsegment,
       (SELECT count(*) FROM customer WHERE c_custkey % 3 = 0 OR (c_custkey % 5 = 0 AND c_custkey % 7 <> 0)) AS dropped
FROM customer WHERE c_custkey % 3 <> 0 AND (c_custkey % 5 <> 0 OR c_custkey % 7 = 0)""")
def q_csv_null_rows(spark, sf_dir):
    """Rows with NULL in required columns go and are counted."""
    rows = files.read_csv(spark, broken_csv(spark, sf_dir), CUSTOMER, header=False)
    needed = ["c_acctbal", "c_mktsegment"]
    kept, dropped = files.drop_null_rows(files.require_columns(rows, needed), needed)
    return attach_row(kept, dropped).select("c_custkey", *needed, "dropped")


_ONE_LINE = r"[\r\n]+"


@query("csv_news", f"""
SELECT (doc_id % 4)::INTEGER AS label,
       CASE WHEN doc_id % 11 = 0 THEN source ELSE source || ' ' || regexp_replace(text, '{_ONE_LINE}', ' ', 'g') END AS text
FROM documents WHERE text <> ''""")
def q_csv_news(spark, sf_dir):
    """Documents as quoted lines (label from 1, title, description) without header; every eleventh has no description."""
    docs = load(spark, sf_dir, "documents").where("text <> ''")

    def quoted(c):
        return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))

    short = F.concat((F.col("doc_id") % 4 + 1).cast("string"), F.lit(","), quoted(F.col("source")))
    line = F.when(F.col("doc_id") % 11 == 0, short).otherwise(
        F.concat(short, F.lit(","), quoted(F.regexp_replace("text", _ONE_LINE, " "))))
    return files.read_news_csv(spark, _lines(docs, line, _folder(spark, "news")))


@query("tsv_pairs", f"WITH {SQL_PAIRS} SELECT tgt AS src, src AS tgt FROM pn")
def q_tsv_pairs(spark, sf_dir):
    """Sentence pairs with a third field, read in the other direction."""
    line = F.concat_ws("\t", "src", "tgt", F.col("turn").cast("string"))
    return files.read_pairs_tsv(spark, _lines(pairs(spark, sf_dir), line, _folder(spark, "pairs")), reverse=True)


@query("csv_timestamps", """
SELECT event_id, CASE WHEN event_id % 50 <> 0 THEN ts END AS ts,
       CASE WHEN event_id % 50 = 0 THEN 'Total ' || event_type END AS summary FROM events""")
def q_csv_timestamps(spark, sf_dir):
    """Lines whose time does not parse are summary rows."""
    at = F.when(F.col("event_id") % 50 == 0, F.concat(F.lit("Total "), "event_type")) \
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    path = _folder(spark, "timestamps")
    files.write_table(load(spark, sf_dir, "events").select("event_id", at.alias("ts")), path, "csv")
    rows, rest = files.coerce_timestamps(files.read_csv(spark, path, "event_id BIGINT, ts STRING"), "ts")
    return rows.withColumn("summary", F.lit(None).cast("string")).unionByName(
        rest.select("event_id", F.lit(None).cast("timestamp").alias("ts"), F.col("ts").alias("summary")))


@query("export_flat", f"SELECT doc_id, lang, len({TOK})::BIGINT AS n_tokens FROM documents")
def q_export_flat(spark, sf_dir):
    """A result with an array column, exported without it."""
    path = _folder(spark, "export")
    docs = load(spark, sf_dir, "documents", spread=True).select("doc_id", "lang", tokenize("text").alias("tokens"))
    files.export_results(docs.withColumn("n_tokens", F.size("tokens").cast("long")), path)
    return files.read_csv(spark, path, "doc_id BIGINT, lang STRING, n_tokens BIGINT")


# ------------------------------------------------------------ JSON, Parquet, models
@query("json_documents", """
SELECT n.n_name, count(c.c_custkey)::BIGINT AS customers, list_sort(list(DISTINCT c.c_mktsegment))[1] AS first_segment,
       count(DISTINCT c.c_mktsegment)::BIGINT AS segments
FROM nation n JOIN customer c ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name""")
def q_json_documents(spark, sf_dir):
    """A statistics document per nation, one per line."""
    c, n = load(spark, sf_dir, "customer"), load(spark, sf_dir, "nation")
    stats = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(
        F.count(F.lit(1)).alias("customers"), F.array_sort(F.collect_set("c_mktsegment")).alias("segments"))
    path = _lines(stats, F.to_json(F.struct("n_name", "customers", "segments")), _folder(spark, "json"))
    back = files.read_json_doc(spark, path, "n_name STRING, customers BIGINT, segments ARRAY<STRING>")
    return back.select("n_name", "customers", F.get("segments", F.lit(0)).alias("first_segment"),
                       F.size("segments").cast("long").alias("segments"))


@query("materialised_totals", """
SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total FROM orders GROUP BY o_custkey""")
def q_materialised_totals(spark, sf_dir):
    """Totals built and committed once; the second call reads what the first has committed."""
    path = _folder(spark, "totals")

    def build():
        return load(spark, sf_dir, "orders").groupBy("o_custkey").agg(
            F.count(F.lit(1)).alias("n_orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))

    def never():
        raise RuntimeError("a committed table is built again")

    files.materialised(spark, path, build)
    return files.materialised(spark, path, never)


@query("augment_saved", f"""
WITH {SQL_TOKENS_CTE}
SELECT doc_id, 0 AS copy, 'original' AS technique, text FROM tok
UNION ALL SELECT doc_id, 1, 'deletion', aug_text FROM {sql_deletion('tok', 1)}
UNION ALL SELECT doc_id, 1, 'swap', aug_text FROM {sql_swap('tok', 1)}""")
def q_augment_saved(spark, sf_dir):
    """Augmented documents saved by technique and read back."""
    path = _folder(spark, "augmented")
    docs = load(spark, sf_dir, "documents", spread=True).select("doc_id", "text")
    files.write_table(aug.augment(docs, "doc_id", "text", ("deletion", "swap")), path, partition_by=["technique"])
    return spark.read.parquet(path).select("doc_id", "copy", "technique", "text")


@query("saved_model", """
WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)
SELECT DISTINCT l_quantity, round(a + b * l_quantity, 3) AS predicted FROM lineitem, f""")
def q_saved_model(spark, sf_dir):
    """A regression fitted, saved, loaded and applied."""
    rows = load(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice")
    path = _folder(spark, "model")
    files.save_model(models.regression(["l_quantity"], "l_extendedprice", solver="normal").fit(rows), path)
    return files.load_model(path).transform(rows.select("l_quantity").distinct()) \
        .select("l_quantity", F.round("prediction", 3).alias("predicted"))


# ------------------------------------------------------------ profiles
_PROFILED = ("l_quantity", "l_extendedprice", "l_discount")
_STATS = {"count": "count({c})", "mean": "avg({c})", "stddev": "stddev_samp({c})", "min": "min({c})", "max": "max({c})"}


@query("table_profile", "\nUNION ALL ".join(
    f"SELECT '{name}' AS summary, " + ", ".join(f"round({sql.format(c=c)}::DOUBLE, 4) AS {c}" for c in _PROFILED) + " FROM lineitem"
    for name, sql in _STATS.items()))
def q_table_profile(spark, sf_dir):
    """The exact statistics of a table's profile (its quartiles are approximate)."""
    p = files.profile(load(spark, sf_dir, "lineitem").select(*_PROFILED))
    return p.where(F.col("summary").isin(*_STATS)).select(
        "summary", *[F.round(F.col(c).cast("double"), 4).alias(c) for c in _PROFILED])


_ORDERS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@query("column_profile", "WITH n AS (" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS name, count(*) - count({c}) AS n_nulls, count(DISTINCT {c}) AS n_values FROM orders" for c in _ORDERS) + """)
SELECT (c.ordinal_position - 1)::INTEGER AS position, n.name,
       CASE c.data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
            WHEN 'TIMESTAMP' THEN 'timestamp' ELSE c.data_type END AS type, n.n_nulls, n.n_values
FROM n JOIN information_schema.columns c ON c.table_name = 'orders' AND c.column_name = n.name""")
def q_column_profile(spark, sf_dir):
    """The columns of a table with their nulls and distinct values."""
    orders = load(spark, sf_dir, "orders")
    seen = orders.unpivot([], [F.col(c).cast("string").alias(c) for c in orders.columns], "name", "value") \
        .groupBy("name").agg(F.count(F.when(F.col("value").isNull(), 1)).alias("n_nulls"), F.countDistinct("value").alias("n_values"))
    return files.column_metadata(orders).drop("nullable").join(seen, "name").select("position", "name", "type", "n_nulls", "n_values")


@query("fuzzy_compose", """
WITH s AS (SELECT s.s_nationkey AS i, c.c_nationkey AS j, sum(l.l_extendedprice::DECIMAL(18,2))::DOUBLE AS v
           FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey JOIN orders o ON o.o_orderkey = l.l_orderkey
           JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY 1, 2),
r AS (SELECT i, j, v / (SELECT max(v) FROM s) AS w FROM s)
SELECT a.i, b.j, max(least(a.w, b.w)) AS w FROM r a JOIN r b ON b.i = a.j GROUP BY a.i, b.j""")
def q_fuzzy_compose(spark, sf_dir):
    """The trade relation between nations (share of the greatest), composed with itself."""
    li, o = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "orders")
    s, c = load(spark, sf_dir, "supplier"), load(spark, sf_dir, "customer")
    sums = (li.join(s, li.l_suppkey == s.s_suppkey).join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
            .groupBy(F.col("s_nationkey").alias("i"), F.col("c_nationkey").alias("j"))
            .agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("v")))
    sums = Scratch(spark, "trade").write(sums, "sums")
    relation = attach_row(sums, sums.agg(F.max("v").alias("_most"))).select("i", "j", (F.col("v") / F.col("_most")).alias("w"))
    return fz.maxmin_compose(relation, relation)


# ------------------------------------------------------------ streams
@query("stream_totals", """
WITH t AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, count(*) AS n_events,
                  sum(value::DECIMAL(18,2))::DOUBLE AS value_sum FROM events GROUP BY 1)
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, n_events, value_sum FROM t
WHERE window_start + INTERVAL 5 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def q_stream_totals(spark, sf_dir):
    """F8: the events as a stream; the five-minute windows that the watermark has closed."""
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    # as a pattern the path may be one file or a folder of them
    events = jobs.event_stream(spark, f"{path}*", spark.read.parquet(path).schema, "*.parquet")
    base = _folder(spark, "stream-totals")
    jobs.run_available_now(jobs.load_totals(events), f"{base}/state", path=f"{base}/totals")
    return spark.read.parquet(f"{base}/totals").withColumn("value_sum", F.col("value_sum").cast("double"))


@query("stream_verdicts", f"SELECT * FROM ({wq.VERDICT_SQL}) WHERE temperature <> 'api_fetch_failed'")
def q_stream_verdicts(spark, sf_dir):
    """forecasts polled twice: first an older version of each, in two copies, then, after a restart, the newest one and the old
    one again."""
    base = _folder(spark, "polled")
    newest = Scratch(spark, "forecasts").write(wq.forecast_json(spark, sf_dir).select(F.col("record").alias("value")), "newest")
    r = F.from_json("value", wx.FORECAST_SCHEMA).alias("r")
    older = newest.select(r).select(F.to_json(
        F.col("r").withField("updatedTimestamp", F.col("r.updatedTimestamp") - F.expr("INTERVAL 6 HOURS"))
        .withField("general.temperature.high", F.col("r.general.temperature.high") + 10.0)).alias("value"))
    predictions, stats = wq.persistence(spark, sf_dir), target_stats(spark, sf_dir)
    for poll in (older.unionAll(older), newest.unionAll(older)):
        poll.write.mode("append").text(f"{base}/landing")
        jobs.run_available_now(jobs.polled_verdicts(spark, f"{base}/landing", predictions, stats, "3650 days"),
                               f"{base}/state", path=f"{base}/verdicts")
    found = jobs.latest_verdicts(spark, f"{base}/verdicts").drop("updated")
    return found.select(*[F.round(c, 6).alias(c) if c in wq.Z else F.col(c) for c in found.columns])
