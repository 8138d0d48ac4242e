"""Corpus pipeline: language id, line dedup, near dedup, decontamination and packing of ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
``docs`` of the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.lineage import Scratch
from kiln.llm import decontaminate, language, line_dedup, near_dup, packing
from kiln.llm.names import fresh, quoted
from kiln.sources.tables import load

#: A document stays when its leading language has at least this score.
LEAST_SCORE = 0.3
#: Near duplicates: five words and a similarity of at least 0.8.
SIMILAR_PERCENT = 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters and those whose leading language scores below ``LEAST_SCORE``. Without any
    labelled document to learn from, only the former go. The score compares the learned languages with each other, so
    in effect mixtures of several languages go; text in an unlearned language or script, and letter noise, stays."""
    model = language.learn(docs.where(~language.held_out()))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language.identify(docs, model)
    return found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*quoted(docs.columns))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take later copies of repeated line runs out; documents of which nothing is left go."""
    cleaned = line_dedup.dedup_lines(docs)
    left = (F.col("n_deleted") == 0) | (F.length(F.regexp_replace("text", r"\s+", "")) > 0)
    return (cleaned.where(left)
            .withColumn("n_chars", F.when(F.col("n_deleted") == 0, F.col("n_chars"))
                        .otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
            .select(*quoted(docs.columns)))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near duplicates, one with the smallest doc_id. Rows are told apart by a written
    number, so that copies go too when they repeat a doc_id or lack one (those with a doc_id come first). Null and
    blank texts are near to nothing and stay."""
    work = Scratch(spark, "dedup-documents")
    row, = fresh(docs.columns, "_row")
    numbered = work.write(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = near_dup.near_duplicates(numbered.select(F.col(row).alias("doc_id"), "text"), SIMILAR_PERCENT)
    place = numbered.select(F.col(row).alias("row"), F.struct(
        F.col("doc_id").isNull().alias("last"), F.col("doc_id").cast("long").alias("id"), F.col(row).alias("row")).alias("place"))
    groups = work.write(found.select(F.col("doc_id").alias("row"), "component_id").join(place, "row"), "groups")
    first = work.write(groups.groupBy("component_id").agg(F.min("place.row").alias("any"), F.max("place.row").alias("other"),
                                                          F.min("place").alias("first"))
                       .where(F.col("any") < F.col("other")).select("component_id", F.col("first.row").alias("first")), "first")
    gone = work.write(groups.join(first, "component_id").where("row <> first").select("row"), "gone")
    for name in ("groups", "first"):
        work.drop(name)
    return numbered.join(gone, F.col(row) == gone["row"], "left_anti").select(*quoted(docs.columns))


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain a benchmark item."""
    return decontaminate.clean_documents(docs, load(spark, sf_dir, "benchmark"))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 ids with their place in a sequence."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("minhash_near_dup", dedup_documents),
    ("decontaminate", decontaminate_documents),
    ("pack", pack_documents),
]

#: Language inference, MinHash and packing have no SQL form; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each but the last is written to the shared checkpoint folder, and a stage's
    table is removed when the next is written."""
    work = Scratch(spark, "pipeline")
    docs, before = load(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = work.write(stage(spark, docs, sf_dir), name)
        if before:
            work.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
