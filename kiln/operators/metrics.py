"""Classification and regression metrics as aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion(df: DataFrame, label: str = "label", pred: str = "prediction", by=()) -> DataFrame:
    """Sparse confusion counts (*by, label, prediction, n)."""
    return df.groupBy(*by, F.col(label).alias("label"), F.col(pred).alias("prediction")) \
        .agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, classes: list, label: str = "label", pred: str = "prediction") -> DataFrame:
    """A16 in dense form: one row per true label, one column per class of the given list."""
    return confusion(df, label, pred).groupBy("label").pivot("prediction", classes).agg(F.sum("n")).na.fill(0)


def per_class(df: DataFrame, label: str = "label", pred: str = "prediction", by=()) -> DataFrame:
    """Per class (and ``by``): tp, support (true count), predicted count, precision,
    recall, f1. Classes are the union of true and predicted labels; a zero
    denominator gives 0 (scikit-learn's zero_division=0)."""
    cm = confusion(df, label, pred, by)
    same = F.col("label") == F.col("prediction")
    # each cell adds to its true class and to its predicted one
    sides = cm.select(*by, F.explode(F.array(
        F.struct(F.col("label").alias("cls"), F.when(same, F.col("n")).otherwise(0).alias("tp"),
                 F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col("prediction").alias("cls"), F.lit(0).cast("long").alias("tp"),
                 F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted")))).alias("s"))
    t = sides.groupBy(*by, F.col("s.cls").alias("cls")).agg(
        *[F.sum(f"s.{c}").alias(c) for c in ("tp", "support", "predicted")])
    p = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    r = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    t = t.withColumn("precision", p).withColumn("recall", r)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(F.lit(0.0))
    return t.withColumn("f1", f1)


def accuracy_weighted(df: DataFrame, label: str = "label", pred: str = "prediction", by=()) -> DataFrame:
    """A13 + A14: one row (per ``by``) of accuracy, precision, recall, f1, support-weighted."""
    pc = per_class(df, label, pred, by)
    return pc.groupBy(*by).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("recall"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"))


def class_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Per-class rows plus 'macro avg' and 'weighted avg' rows."""
    pc = per_class(df, label, pred)
    rows = pc.select(F.col("cls").cast("string").alias("cls"), "precision", "recall", "f1",
                     F.col("support").cast("bigint").alias("support"))
    macro = pc.agg(F.lit("macro avg").alias("cls"), F.avg("precision").alias("precision"),
                   F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                   F.sum("support").cast("bigint").alias("support"))
    weighted = pc.agg(
        F.lit("weighted avg").alias("cls"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("recall"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"),
        F.sum("support").cast("bigint").alias("support"))
    return rows.unionByName(macro).unionByName(weighted)


def combined_loss(df: DataFrame, targets: list[str], preds: list[str], means: list,
                  stds: list, penalty_factor: float = 2.0, alpha: float = 0.5) -> DataFrame:
    """Extreme-weighted MSE over rows x targets.

    Weight is 1 + alpha * penalty_factor where |target - mean| > std, else 1.
    ``means``/``stds`` are columns or numbers.
    """
    def c(x):
        return x if not isinstance(x, (int, float)) else F.lit(float(x))
    terms = []
    for t, p, m, s in zip(targets, preds, means, stds):
        e = F.col(p) - F.col(t)
        w = F.lit(1.0) + F.when(F.abs(F.col(t) - c(m)) > c(s),
                                F.lit(alpha * penalty_factor)).otherwise(F.lit(0.0))
        terms.append(e * e * w)
    row_sum = terms[0]
    for x in terms[1:]:
        row_sum = row_sum + x
    return df.agg((F.sum(row_sum) / (F.count(F.lit(1)) * len(targets))).alias("combined_loss"))
