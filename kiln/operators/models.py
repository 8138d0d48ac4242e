"""Model jobs on ``pyspark.ml`` (M4-M8, M11-M13): fit on a DataFrame, score
a DataFrame. Fitting is distributed by MLlib; the driver only loops over a
small parameter grid."""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, NaiveBayes
from pyspark.ml.feature import (CountVectorizer, IndexToString, NGram, RegexTokenizer, SQLTransformer,
                                StopWordsRemover, StringIndexer, VectorAssembler)
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions.text import ENGLISH_STOPWORDS, SK_TOKEN_RE
from kiln.lineage import Scratch
from kiln.operators import gram, naive_bayes


def nb_text_pipeline(text_col: str, label_col: str, alpha: float = 1.0, max_features: int | None = None,
                     ngram: int = 2, stop_words=ENGLISH_STOPWORDS):
    """M7: tokens (lower case, 2+ word chars) -> without stop words -> uni+bi-grams -> counts -> multinomial
    Naive Bayes with smoothed priors. Without ``max_features`` all terms count, and they stay in the tasks
    (``naive_bayes``); with it, MLlib keeps that many terms and their class matrix on the driver, and labels are indexed
    and mapped back."""
    tok = RegexTokenizer(inputCol=text_col, outputCol="_raw", pattern=SK_TOKEN_RE, gaps=False, toLowercase=True)
    stages = [tok, StopWordsRemover(inputCol="_raw", outputCol="_tok", stopWords=list(stop_words))]
    if max_features is None:
        return CountedPipeline(Pipeline(stages=stages), text_col, label_col, alpha, ngram)
    grams = ["_tok"]
    for n in range(2, ngram + 1):
        stages.append(NGram(n=n, inputCol="_tok", outputCol=f"_g{n}"))
        grams.append(f"_g{n}")
    stages.append(SQLTransformer(statement=f"SELECT *, concat({', '.join(grams)}) AS _terms FROM __THIS__"))
    idx = StringIndexer(inputCol=label_col, outputCol="_y", stringOrderType="alphabetAsc")
    stages += [CountVectorizer(inputCol="_terms", outputCol="_x", vocabSize=max_features),
               idx, NaiveBayes(featuresCol="_x", labelCol="_y", smoothing=alpha, modelType="multinomial",
                               predictionCol="_p")]
    return Pipeline(stages=stages)


@dataclass
class CountedPipeline:
    """Tokens by MLlib's transformers, counts and scores by ``naive_bayes``: no vocabulary and no class matrix on the driver."""

    tokens: Pipeline
    text_col: str
    label_col: str
    alpha: float
    ngram: int

    def fit(self, train: DataFrame) -> CountedModel:
        """A training text without a label is an error."""
        tokens = self.tokens.fit(train)
        label = F.coalesce(F.col(self.label_col).cast("string"), F.raise_error("a training text has no label").cast("string"))
        return CountedModel(self, tokens, tokens.transform(train).select(label.alias(self.label_col), self.text_col, "_tok"))


@dataclass
class CountedModel:
    """The training texts' tokens; terms are counted where the texts to predict ask for them."""

    pipeline: CountedPipeline
    tokens: PipelineModel
    train: DataFrame

    def predict(self, df: DataFrame) -> DataFrame:
        p = self.pipeline
        # rows are told apart by a written number: ids may repeat
        rows = Scratch(df.sparkSession, "text-model").write(
            self.tokens.transform(df).drop("_raw").withColumn("_row", F.monotonically_increasing_id()), "rows")
        found = naive_bayes.fit_predict(self.train, rows.select("_row", p.text_col, "_tok"), "_row", p.text_col, p.label_col, p.alpha, 1, p.ngram,
                                        F.col("_tok"), prior=p.alpha)
        return rows.drop("_tok").join(found.select("_row", "prediction"), "_row").drop("_row")


def nb_predict(model, df: DataFrame, label_col: str) -> DataFrame:
    if isinstance(model, CountedModel):
        return model.predict(df)
    labels = model.stages[-2].labels
    out = model.transform(df)
    return IndexToString(inputCol="_p", outputCol="prediction", labels=labels).transform(out)


def sample_space(space: dict, trials: int, seed: int = 42) -> list[dict]:
    """M8/M9: parameter rows drawn by hash. A list is a choice, a pair of integers a range (both ends count), a pair of
    floats a uniform range, and ('log', low, high) a log-uniform one. The same seed gives the same rows."""
    def draw(name: str, trial: int) -> float:
        return int(hashlib.md5(f"{seed}|{name}|{trial}".encode()).hexdigest()[:13], 16) / 16**13

    def value(spec, u: float):
        if isinstance(spec, list):
            return spec[int(u * len(spec))]
        if spec[0] == "log":
            return float(math.exp(math.log(spec[1]) + u * (math.log(spec[2]) - math.log(spec[1]))))
        low, high = spec
        if isinstance(low, int) and isinstance(high, int):
            return low + int(u * (high - low + 1))
        return low + u * (high - low)

    return [{k: value(v, draw(k, t)) for k, v in space.items()} for t in range(trials)]


def kfold_search(df: DataFrame, features: list[str], label: str, fold_col: str, folds: int, trials: list[dict]) -> list[tuple]:
    """M9: (trial, reg, elastic, fold, rmse, pruned) of ``gram.kfold_losses`` over folds 0 to ``folds`` - 1, with median pruning."""
    losses = gram.kfold_losses(df.where(F.col(fold_col).between(0, folds - 1)), features, label, fold_col, trials)
    return sorted(map(tuple, gram.median_pruning(losses).collect()), key=lambda r: (r[0], r[3]))


def regression(features: list[str], label: str, kind: str = "linear", weight: str | None = None,
               **params) -> Pipeline:
    """Assembler + LinearRegression or GBTRegressor."""
    asm = VectorAssembler(inputCols=features, outputCol="_x", handleInvalid="skip")
    if kind == "gbt":
        est = GBTRegressor(featuresCol="_x", labelCol=label, **params)
    else:
        est = LinearRegression(featuresCol="_x", labelCol=label, **params)
    if weight:
        est.setWeightCol(weight)
    return Pipeline(stages=[asm, est])


def linear_svc(features: list[str], label: str, **params) -> Pipeline:
    """Margin classifier on (kernel) features; label 0/1."""
    asm = VectorAssembler(inputCols=features, outputCol="_x")
    return Pipeline(stages=[asm, LinearSVC(featuresCol="_x", labelCol=label, **params)])


def feature_importances(model, names: list[str]) -> list[tuple[str, float]]:
    """M6: importances of the fitted tree ensemble, largest first."""
    imp = model.stages[-1].featureImportances.toArray()
    return sorted(zip(names, map(float, imp)), key=lambda x: -x[1])


def extreme_weight(target: str, mean, std, alpha: float = 0.5, penalty_factor: float = 2.0):
    """A12 as a weight column: squared error weighted by this equals the
    combined loss."""
    return F.lit(1.0) + F.when(F.abs(F.col(target) - mean) > std, F.lit(alpha * penalty_factor)).otherwise(0.0)
