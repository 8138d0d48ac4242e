"""Queries of the training-data operators over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm import (best_fit, chat, decontaminate, embedding_dup, fill_middle, language, line_dedup, near_dup, oracles, packing, pii,
                      ranked_search, secrets, token_count)
from kiln.sources.tables import load


#: Key of the registered query only; a caller brings a secret one.
DEMO_KEY = b"kiln-demonstration-key"


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scan(load(spark, sf_dir, "documents")))


def op2_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(load(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = F.lit(r"\### Assistant: </turn> ok")
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), hard.alias("text"))
    return chat.digests(chat.render(turns.unionByName(added)))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_deleted", "text")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").withColumn("held_out", language.held_out())
    return language.with_language(docs, keep=["doc_id", "held_out"])


def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(load(spark, sf_dir, "documents"), DEMO_KEY)


def op7_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dup.near_duplicates(load(spark, sf_dir, "embeddings"), cosine=0.93)


def op8_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(load(spark, sf_dir, "documents"), percent=85)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contained_items(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), percent=80)
    return found.select("doc_id", "item_id", "n_item", "n_shared")


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.drop("loss_tokens")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), k=10)


def op12_best_fit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(fill_middle.fill_in_middle(load(spark, sf_dir, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_scan": op1_secret_scan,
        "op2_token_count": op2_token_count,
        "op3_chat_format": op3_chat_format,
        "op4_line_dedup": op4_line_dedup,
        "op5_language_id": op5_language_id,
        "op6_pseudonyms": op6_pseudonyms,
        "op7_embedding_near_dup": op7_embedding_near_dup,
        "op8_minhash_near_dup": op8_minhash_near_dup,
        "op9_decontaminate": op9_decontaminate,
        "op10_pack": op10_pack,
        "op11_ranked_search": op11_ranked_search,
        "op12_best_fit_pack": op12_best_fit_pack,
        "op13_fill_in_middle": op13_fill_in_middle,
    }


def oracle_sql() -> dict[str, str]:
    """The others have no SQL form: learned models, tokenizers, keyed permutations, compression."""
    return {
        "op3_chat_format": oracles.CHAT_FORMAT,
        "op4_line_dedup": oracles.LINE_DEDUP,
        "op7_embedding_near_dup": oracles.EMBEDDING_NEAR_DUP,
        "op8_minhash_near_dup": oracles.MINHASH_NEAR_DUP,
        "op9_decontaminate": oracles.DECONTAMINATE,
        "op11_ranked_search": oracles.RANKED_SEARCH,
        "op13_fill_in_middle": oracles.FILL_IN_MIDDLE,
    }
