"""Experiment-grid queries: Naive Bayes (SQL form) per training size and augmentation on the documents table.

Every query computes the grid from the tables: all configurations are fitted by the same jobs, with the
configuration as a column. The training texts lie in twelve cells: four variants (original, synonym, deletion,
swap) by three size bands (the first tenth of the training documents in hash order, the rest of the first half,
the others); a configuration is a set of cells.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from kiln.functions.hashing import hash32, sql_hash32
from kiln.functions.text import sql_clean_text
from kiln.lineage import Scratch
from kiln.operators import augment as aug
from kiln.operators import experiments as ex
from kiln.operators import metrics
from kiln.operators.common import hash_cut
from kiln.plans import query
from kiln.plans.text_queries import (ALPHA, SQL_SPLIT, SQL_SYNONYMS, TOK, _synonyms_from, documents, split_documents, sql_deletion,
                                     sql_swap, sql_synonym)

SIZES = (0.1, 0.5, 1.0)
VARIANTS = ("original", "synonym", "deletion", "swap")
#: The augmentations of the size experiment; the single techniques run on all documents too.
COMBINATIONS = ("baseline", "synonym", "deletion", "synonym+deletion", "synonym+deletion+swap")
CONFIGS = [(size, name) for size in SIZES for name in COMBINATIONS] + [(1.0, "swap")]


def _variants(name):
    return ["original", *([] if name == "baseline" else name.split("+"))]


def experiment_grid(spark, sf_dir):
    """(model, augmentation, dataset_size, accuracy, precision, recall, f1, n_train), one row per configuration."""
    work = Scratch(spark, "experiments")
    s = work.write(split_documents(spark, sf_dir), "split", "zstd")
    train = s.filter(F.col("split") == "train").select("doc_id", "text", "label")
    h = hash32(F.col("doc_id"), 42, "size")
    place = F.struct(h.alias("h"), F.col("doc_id").alias("i"))
    band = F.lit(2)
    for k in (1, 0):
        cut = hash_cut(train.select("doc_id", h.alias("_h")), [], "_h", "doc_id", SIZES[k], F.floor)
        row = cut.agg(F.max(F.struct(F.col("_cut_hash").alias("h"), F.col("_cut_id").alias("i"))).alias(f"_c{k}"))
        train = train.crossJoin(F.broadcast(row))
        band = F.when(place <= F.col(f"_c{k}"), k).otherwise(band)
    train = train.withColumn("band", band).drop("_c0", "_c1")
    texts = aug.augment(train, "doc_id", "text", aug.TECHNIQUES, 1, _synonyms_from(documents(spark, sf_dir)))
    variant = F.array_position(F.array(*[F.lit(v) for v in VARIANTS]), F.col("technique")) - 1
    texts = work.write(texts.select((variant * len(SIZES) + F.col("band")).cast("int").alias("cell"), "label", "text"), "texts",
                       "zstd")
    cells = len(VARIANTS) * len(SIZES)
    rows = [(n, name, size, [VARIANTS.index(v) * len(SIZES) + b for v in _variants(name) for b in range(SIZES.index(size) + 1)])
            for n, (size, name) in enumerate(CONFIGS)]
    configs = spark.createDataFrame(rows, "config int, augmentation string, dataset_size double, members array<int>")
    val = s.filter(F.col("split") == "val").select("doc_id", "label", "text")
    pred = ex.naive_bayes_grid(texts, val, configs, cells, ALPHA)
    used = texts.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    n_train = (configs.select("config", F.explode("members").alias("cell")).join(used, "cell")
               .groupBy("config").agg(F.sum("n").alias("n_train")))
    scores = metrics.accuracy_weighted(pred, by=["config"])
    return (configs.join(scores, "config").join(n_train, "config")
            .select(F.lit("naive_bayes").alias("model"), "augmentation", "dataset_size",
                    *[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "f1")], "n_train"))


_MEMBERS = ", ".join(f"({size}::DOUBLE, '{name}', '{v}')" for size, name in CONFIGS for v in _variants(name))

SQL_GRID = f"""
{SQL_SPLIT},
tok AS (SELECT doc_id, text, label, {TOK} AS t FROM s WHERE split = 'train'),
{SQL_SYNONYMS.replace('FROM tok', f'FROM (SELECT {TOK} AS t FROM documents)', 1)},
vt AS (SELECT doc_id, label, 'original' AS variant, text FROM tok
  UNION ALL SELECT doc_id, label, 'synonym', aug_text FROM {sql_synonym('tok', 1)} JOIN tok USING (doc_id)
  UNION ALL SELECT doc_id, label, 'deletion', aug_text FROM {sql_deletion('tok', 1)} JOIN tok USING (doc_id)
  UNION ALL SELECT doc_id, label, 'swap', aug_text FROM {sql_swap('tok', 1)} JOIN tok USING (doc_id)),
rk AS (SELECT doc_id, row_number() OVER (ORDER BY {sql_hash32('doc_id', "'42'", "'size'")}, doc_id) AS rn,
              count(*) OVER () AS n FROM tok),
cfg(size, aug, variant) AS (VALUES {_MEMBERS}),
tr AS (SELECT cfg.size, cfg.aug, vt.* FROM cfg JOIN vt USING (variant) JOIN rk USING (doc_id)
       WHERE cfg.size = 1.0 OR rk.rn <= floor(rk.n * cfg.size)),
tx AS (SELECT doc_id, variant, list_filter(string_split({sql_clean_text('text')}, ' '), lambda x: x <> '') AS t
       FROM (SELECT doc_id, variant, text FROM vt UNION ALL SELECT doc_id, 'val', text FROM s WHERE split = 'val')),
oc AS (SELECT doc_id, variant, unnest(list_concat(list_concat(t,
            list_transform(range(1, len(t)), lambda i: array_to_string(t[i:i+1], ' '))),
            list_transform(range(1, len(t) - 1), lambda i: array_to_string(t[i:i+2], ' ')))) AS term FROM tx),
tc AS (SELECT doc_id, variant, term, count(*) AS c FROM oc GROUP BY ALL),
model AS (SELECT size, aug, term, label, sum(c) AS ntc FROM tr JOIN tc USING (doc_id, variant) GROUP BY ALL),
vs AS (SELECT size, aug, count(DISTINCT term)::DOUBLE AS v FROM model GROUP BY ALL),
tot AS (SELECT size, aug, label, sum(ntc)::DOUBLE AS tot FROM model GROUP BY ALL),
dc AS (SELECT size, aug, label, count(*)::DOUBLE AS nc FROM tr GROUP BY ALL),
ntr AS (SELECT size, aug, count(*) AS n FROM tr GROUP BY ALL),
vtc AS (SELECT doc_id, term, c FROM tc WHERE variant = 'val'),
td AS (SELECT size, aug, doc_id, sum(c) AS t FROM vtc JOIN (SELECT DISTINCT size, aug, term FROM model) USING (term) GROUP BY ALL),
sd AS (SELECT size, aug, doc_id, label, sum(c * ln((ntc + {ALPHA}) / {ALPHA})) AS sc FROM vtc JOIN model USING (term) GROUP BY ALL),
sc AS (SELECT dc.size, dc.aug, val.doc_id, val.label AS truth, dc.label AS cls,
         ln(dc.nc / ntr.n) + coalesce(td.t, 0) * ln({ALPHA} / (coalesce(tot.tot, 0) + {ALPHA} * vs.v)) + coalesce(sd.sc, 0) AS score
       FROM (SELECT doc_id, label FROM s WHERE split = 'val') val CROSS JOIN dc JOIN ntr USING (size, aug) JOIN vs USING (size, aug)
       LEFT JOIN tot ON tot.size = dc.size AND tot.aug = dc.aug AND tot.label = dc.label
       LEFT JOIN td ON td.size = dc.size AND td.aug = dc.aug AND td.doc_id = val.doc_id
       LEFT JOIN sd ON sd.size = dc.size AND sd.aug = dc.aug AND sd.doc_id = val.doc_id AND sd.label = dc.label),
pd AS (SELECT size, aug, doc_id, truth, first(cls ORDER BY score DESC, cls) AS prediction FROM sc GROUP BY ALL),
cm AS (SELECT size, aug, truth, prediction, count(*) AS n FROM pd GROUP BY ALL),
pc AS (SELECT size, aug, c, sum(tp) AS tp, sum(support) AS support, sum(predicted) AS predicted FROM (
         SELECT size, aug, truth AS c, CASE WHEN truth = prediction THEN n ELSE 0 END AS tp, n AS support, 0 AS predicted FROM cm
         UNION ALL SELECT size, aug, prediction, 0, 0, n FROM cm) GROUP BY ALL),
pm AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS p,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS r FROM pc),
pf AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f FROM pm),
grid AS (SELECT 'naive_bayes' AS model, aug AS augmentation, size AS dataset_size, round(sum(tp) / sum(support), 6) AS accuracy,
                round(sum(p * support) / sum(support), 6) AS precision, round(sum(r * support) / sum(support), 6) AS recall,
                round(sum(f * support) / sum(support), 6) AS f1, any_value(ntr.n)::BIGINT AS n_train
         FROM pf JOIN ntr USING (size, aug) GROUP BY size, aug)"""


@query("experiment_grid", f"WITH {SQL_GRID} SELECT * FROM grid")
def q_experiment_grid(spark, sf_dir):
    return experiment_grid(spark, sf_dir)


@query("pivot_accuracy", f"""WITH {SQL_GRID}
SELECT (dataset_size * 100)::INTEGER || '%' AS size, {', '.join(
    f"max(CASE WHEN augmentation = '{a}' THEN accuracy END) AS " + '"' + a + '"' for a in COMBINATIONS)}
FROM grid GROUP BY 1""")
def q_pivot_accuracy(spark, sf_dir):
    r = experiment_grid(spark, sf_dir).withColumn("size", ex.size_label("dataset_size"))
    return ex.pivot_metric(r, "size", "augmentation", "accuracy", list(COMBINATIONS))


@query("baseline_delta", f"""WITH {SQL_GRID}
SELECT g.model, g.dataset_size, g.augmentation, g.accuracy, round(g.accuracy - b.accuracy, 6) AS accuracy_delta
FROM grid g LEFT JOIN grid b ON b.dataset_size = g.dataset_size AND b.augmentation = 'baseline'""")
def q_baseline_delta(spark, sf_dir):
    r = ex.baseline_delta(experiment_grid(spark, sf_dir), ["model", "dataset_size"], "augmentation", "accuracy")
    return r.select("model", "dataset_size", "augmentation", "accuracy", F.round("accuracy_delta", 6).alias("accuracy_delta"))


@query("group_mean", f"""WITH {SQL_GRID}
SELECT model, augmentation, round(avg(accuracy), 6) AS mean_accuracy FROM grid GROUP BY ALL""")
def q_group_mean(spark, sf_dir):
    r = ex.group_mean(experiment_grid(spark, sf_dir), ["model", "augmentation"], "accuracy")
    return r.withColumn("mean_accuracy", F.round("mean_accuracy", 6))


@query("experiment_summary", f"""WITH {SQL_GRID}
SELECT 'task1' AS task, model, 'Default' AS configuration, accuracy, NULL::DOUBLE AS precision, NULL::DOUBLE AS recall, NULL::DOUBLE AS f1
FROM grid WHERE dataset_size = 1.0 AND augmentation = 'baseline'
UNION ALL SELECT 'task2', model, 'Aug: ' || augmentation, accuracy, NULL, NULL, NULL FROM grid
WHERE dataset_size = 1.0 AND augmentation IN ('baseline', 'synonym', 'deletion', 'swap')
UNION ALL SELECT 'task3', model, format('Size: {{:.1f}}%, Aug: {{}}', dataset_size * 100, augmentation), accuracy, precision, recall, f1
FROM grid WHERE augmentation <> 'swap'""")
def q_experiment_summary(spark, sf_dir):
    """Three task tables with different columns, stacked by name."""
    r = Scratch(spark, "summary").write(experiment_grid(spark, sf_dir), "grid")
    t1 = r.filter((F.col("dataset_size") == 1.0) & (F.col("augmentation") == "baseline")).select(
        F.lit("task1").alias("task"), "model", F.lit("Default").alias("configuration"), "accuracy")
    singles = F.col("augmentation").isin("baseline", "synonym", "deletion", "swap")
    t2 = r.filter((F.col("dataset_size") == 1.0) & singles).select(
        F.lit("task2").alias("task"), "model", F.concat(F.lit("Aug: "), "augmentation").alias("configuration"),
        "accuracy")
    t3 = r.filter(F.col("augmentation") != "swap").select(
        F.lit("task3").alias("task"), "model",
        F.format_string("Size: %.1f%%, Aug: %s", F.col("dataset_size") * 100, F.col("augmentation")).alias("configuration"),
        "accuracy", "precision", "recall", "f1")
    return t1.unionByName(t2, allowMissingColumns=True).unionByName(t3, allowMissingColumns=True)


@query("model_comparison", f"""WITH {SQL_GRID}
SELECT augmentation, max(CASE WHEN dataset_size = 0.1 THEN accuracy ELSE 0 END) AS small,
       max(CASE WHEN dataset_size = 0.5 THEN accuracy ELSE 0 END) AS half,
       max(CASE WHEN dataset_size = 1.0 THEN accuracy ELSE 0 END) AS "all" FROM grid GROUP BY augmentation""")
def q_model_comparison(spark, sf_dir):
    """Accuracy by training size; a size that was not run counts as 0."""
    sizes = F.element_at(F.create_map(F.lit(0.1), F.lit("small"), F.lit(0.5), F.lit("half"), F.lit(1.0), F.lit("all")), F.col("dataset_size"))
    r = ex.pivot_metric(experiment_grid(spark, sf_dir).withColumn("s", sizes), "augmentation", "s", "accuracy", ["small", "half", "all"])
    return ex.model_comparison(r, "augmentation", ["small", "half", "all"])


_TRIALS = "tr1 AS (SELECT *, row_number() OVER (ORDER BY dataset_size, augmentation) AS trial FROM grid)"


@query("best_trial", f"""WITH {SQL_GRID}, {_TRIALS}
SELECT model, first(dataset_size ORDER BY accuracy DESC, trial) AS dataset_size, first(augmentation ORDER BY accuracy DESC, trial) AS augmentation,
       first(trial ORDER BY accuracy DESC, trial)::INTEGER AS trial, max(accuracy) AS best_accuracy FROM tr1 GROUP BY model""")
def q_best_trial(spark, sf_dir):
    r = experiment_grid(spark, sf_dir)
    # one row per configuration: a global window over the result table is fine
    trials = r.withColumn("trial", F.row_number().over(Window.orderBy("dataset_size", "augmentation")))
    return ex.best_trial(trials, ["model"], "trial", "accuracy", ["dataset_size", "augmentation"])


_CURVES = "cv AS (SELECT augmentation, row_number() OVER (PARTITION BY augmentation ORDER BY dataset_size) AS epoch, accuracy FROM grid)"


def _curves(spark, sf_dir):
    """Accuracy by training size: an augmentation's epochs are its growing sizes."""
    w = Window.partitionBy("augmentation").orderBy("dataset_size")
    return experiment_grid(spark, sf_dir).select("augmentation", F.row_number().over(w).alias("epoch"), "accuracy")


@query("early_stop", f"""WITH {SQL_GRID}, {_CURVES},
pb AS (SELECT *, max(accuracy) OVER (PARTITION BY augmentation ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev,
              max(accuracy) OVER (PARTITION BY augmentation ORDER BY epoch) AS running_best,
              max(epoch) OVER (PARTITION BY augmentation) AS last FROM cv),
im AS (SELECT *, prev IS NULL OR accuracy > prev AS improved FROM pb),
sb AS (SELECT *, epoch - max(CASE WHEN improved THEN epoch END) OVER (PARTITION BY augmentation ORDER BY epoch) AS since_best FROM im)
SELECT augmentation, epoch::INTEGER AS epoch, accuracy, improved, since_best::INTEGER AS since_best, running_best,
       coalesce(min(CASE WHEN since_best >= 1 THEN epoch END) OVER (PARTITION BY augmentation), last)::INTEGER AS stop_epoch FROM sb""")
def q_early_stop(spark, sf_dir):
    """N12 on accuracy by training size."""
    return ex.early_stop(_curves(spark, sf_dir), "augmentation", "epoch", "accuracy", patience=1)


@query("pad_history", f"""WITH {SQL_GRID}, {_CURVES},
fr AS (SELECT DISTINCT a.augmentation, e.epoch FROM cv a, cv e)
SELECT fr.augmentation, fr.epoch::INTEGER AS epoch, last_value(cv.accuracy IGNORE NULLS) OVER (
         PARTITION BY fr.augmentation ORDER BY fr.epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS accuracy
FROM fr LEFT JOIN cv USING (augmentation, epoch)""")
def q_pad_history(spark, sf_dir):
    """Curves of unequal length, padded with their last value."""
    c = Scratch(spark, "curves").write(_curves(spark, sf_dir), "curves")
    epochs = c.agg(F.sequence(F.lit(1), F.max("epoch")).alias("e"))
    frame = c.select("augmentation").distinct().crossJoin(F.broadcast(epochs)).select("augmentation", F.explode("e").alias("epoch"))
    return ex.pad_last(frame.join(c, ["augmentation", "epoch"], "left"), "augmentation", "epoch", ["accuracy"])
