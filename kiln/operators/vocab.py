"""Vocabularies, index encoding / decoding, token-table lookups (A18-A19,
J3-J6, T3, T12-T13, N11).

Token ids follow first appearance in a total order (document id, token
position). The vocabulary is aggregated first (word -> count, first
position); only that much smaller table is then put in order, with the
distributed ``global_index`` (no single-task window).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.functions.text import clean_text, remove_stopwords
from kiln.lineage import Scratch
from kiln.operators.common import global_index, lookup, lookup_apart

PAD, UNK = 0, 1          # W1 ids (fixed values of the classifier vocabulary)
SOS, EOS = 0, 1          # W2 ids (fixed values of the sentence-pair vocabulary)


def _keys(id_col) -> list[str]:
    return [id_col] if isinstance(id_col, str) else list(id_col)


def token_positions(df: DataFrame, id_col, tokens: Column, keep=()) -> DataFrame:
    """(*ids, *keep, pos, word) with 0-based pos; ``id_col`` may be a list."""
    return df.select(*[F.col(k) for k in _keys(id_col)], *[F.col(k) for k in keep],
                     F.posexplode(tokens).alias("pos", "word"))


def build_vocab(df: DataFrame, id_col, tokens: Column, min_freq: int = 1,
                first_id: int = 2) -> DataFrame:
    """(word, idx, cnt). Words with cnt >= min_freq, numbered from
    ``first_id`` in order of first appearance (*id_cols, pos). A task counts the words of a batch of texts at a time, so a
    batch sends one row for each of its words."""
    keys = _keys(id_col)
    order = [F.col(f"k{i}") for i in range(len(keys))] + [F.col("p")]
    rows = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], tokens.alias("_t"))
    kind = T.StructType([*rows.schema.fields[:-1], T.StructField("word", T.StringType()), T.StructField("p", T.IntegerType()), T.StructField("n", T.LongType())])
    stats = (rows.mapInArrow(partial(_count_words, kind.names), kind).groupBy("word")
             .agg(F.sum("n").alias("cnt"), F.min(F.struct(*order)).alias("first"))
             .filter(F.col("cnt") >= F.lit(min_freq)))
    ranked = global_index(stats, [F.col(f"first.k{i}") for i in range(len(keys))]
                          + [F.col("first.p")], out="_i")
    return ranked.select("word", (F.col("_i") + F.lit(first_id - 1)).alias("idx"),
                         F.col("cnt").cast("bigint").alias("cnt"))


def _count_words(names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        *keys, tokens = batch.columns
        by_key = pa.Table.from_arrays(keys, names=names[:-3])
        order = pc.sort_indices(by_key, sort_keys=[(k, "ascending") for k in by_key.column_names], null_placement="at_start")
        batch = batch.take(order)  # the first row of a word is then its least
        *keys, tokens = batch.columns
        words = pc.list_flatten(tokens)
        text = pc.list_parent_indices(tokens).to_numpy(zero_copy_only=False)
        length = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
        place = np.arange(len(words)) - np.repeat(np.cumsum(length) - length, length)
        coded = words.dictionary_encode(null_encoding="encode")
        code = coded.indices.to_numpy(zero_copy_only=False)
        # texts of one key may follow each other: of their words the one that stands first counts
        same = np.zeros(len(batch), np.int64)
        if len(batch):
            same[1:] = np.cumsum(np.any([_changes(k) for k in keys], axis=0))
        by = np.lexsort((place, same[text]))
        shown, at, n = np.unique(code[by], return_index=True, return_counts=True)
        at = by[at]
        yield pa.RecordBatch.from_arrays([*(k.take(pa.array(text[at])) for k in keys), coded.dictionary.take(pa.array(shown)),
                                          pa.array(place[at], pa.int32()), pa.array(n, pa.int64())], names=names)


def _changes(values: pa.Array) -> np.ndarray:
    """Whether a value differs from the one before it, from the second value on."""
    code = values.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return code[1:] != code[:-1]


def encode_padded(df: DataFrame, id_col: str, tokens: Column, vocab: DataFrame,
                  max_length: int | None = 100) -> DataFrame:
    """T13 + J3 in long form: (id, pos, token_id). Unknown words -> 1. With
    ``max_length`` texts are truncated to it and padded with 0 up to it;
    without, whole texts are encoded. Tokens are made once: a position past
    the end of the text is a row without a word."""
    t = df.select(F.col(id_col), tokens.alias("_t"))
    if max_length is None:
        words = t.select(id_col, F.posexplode("_t").alias("pos", "word"))
    else:
        # reading past the end gives NULL, which is the padding
        words = t.select(id_col, F.posexplode(F.transform(
            F.sequence(F.lit(0), F.lit(max_length - 1)), lambda k: F.get("_t", k))).alias("pos", "word"))
    found = lookup_apart(words, "word", vocab, "idx", "cnt")
    return found.select(id_col, "pos", F.when(F.col("word").isNull(), F.lit(PAD))
                        .otherwise(F.coalesce("idx", F.lit(UNK))).cast("int").alias("token_id"))


def decode(encoded: DataFrame, id_col: str, vocab: DataFrame) -> DataFrame:
    """Ids back to words, padding dropped, '<unk>' for 1; one text per id. The ids are written once; only those of rare
    words are shuffled for the words, and the words of a text leave a task as one row."""
    ids = vocab.select(F.col("idx").cast("int").alias("_key"), "word", "cnt")
    rows = Scratch(encoded.sparkSession, "decode").write(encoded.filter(F.col("token_id") != PAD), "ids", "zstd")
    words = (lookup_apart(rows.withColumn("_key", F.when(F.col("token_id") != UNK, F.col("token_id"))), "_key", ids, "word", "cnt")
             .select(id_col, "pos", F.when(F.col("token_id") == UNK, F.lit("<unk>")).otherwise(F.col("word")).alias("word")))
    piece = T.ArrayType(T.StructType().add("pos", "integer").add("n", "integer").add("text", "string"))
    kind = words.select(id_col).schema.add("pieces", piece)
    whole = words.mapInArrow(partial(_pieces, kind.names), kind).groupBy(id_col).agg(F.array_sort(F.flatten(F.collect_list("pieces"))).alias("p"))
    # pieces of texts with the same id may lie over each other: their words are put in order one by one
    over = F.exists(F.sequence(F.lit(1), F.size("p") - 1), lambda i: F.get("p", i)["pos"] < F.get("p", i - 1)["pos"] + F.get("p", i - 1)["n"])
    single = F.array_sort(F.flatten(F.transform("p", lambda x: F.transform(
        F.when(x["n"] == 1, F.array(x["text"])).otherwise(F.split(x["text"], " ")), lambda w, i: F.struct((x["pos"] + i).alias("pos"), w.alias("text"))))))
    texts = F.when((F.size("p") > 1) & over, F.transform(single, lambda x: x["text"])).otherwise(F.transform("p", lambda x: x["text"]))
    return whole.select(id_col, F.array_join(texts, " ").alias("decoded"))


def _pieces(names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of an id that follow each other are joined by blanks; the pieces of rows of an id that follow each other become one row.
    A word that is null or has a blank is a piece by itself."""
    for batch in batches:
        ids, pos, word = batch.columns
        if not len(word):
            continue
        pos = pos.to_numpy(zero_copy_only=False)
        alone = pc.fill_null(pc.match_substring(word, " "), True).to_numpy(zero_copy_only=False)
        new_id = np.concatenate([[True], _changes(ids)])
        begins = new_id.copy()
        begins[1:] |= (pos[1:] != pos[:-1] + 1) | alone[1:] | alone[:-1]
        start = np.flatnonzero(begins)
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array([*start, len(word)], pa.int32()), word), " ")
        n = np.diff(start, append=len(word))
        pieces = pa.StructArray.from_arrays([pa.array(pos[start], pa.int32()), pa.array(n, pa.int32()), text], ["pos", "n", "text"])
        row = np.flatnonzero(new_id)
        ends = pa.array([*np.searchsorted(start, row), len(start)], pa.int32())
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(row)), pa.ListArray.from_arrays(ends, pieces)], names=names)


def encode_strict_eos(df: DataFrame, id_col, tokens: Column, vocab: DataFrame) -> DataFrame:
    """T12 + J4: (*ids, pos, token_id) with EOS appended; a missing word
    fails the job (``assert_true``), as the reference's dict lookup raises."""
    keys = _keys(id_col)
    words = token_positions(df, keys, tokens)
    hits = (lookup(words, "word", vocab, "idx", "cnt", [*keys, "pos"])
            .select(*keys, "pos",
                    F.when(F.assert_true(F.col("idx").isNotNull(), "word not in vocabulary").isNull(),
                           F.col("idx")).cast("int").alias("token_id")))
    eos = df.select(*keys, F.size(tokens).alias("pos"), F.lit(EOS).alias("token_id"))
    return hits.unionByName(eos)


def map_tokens(df: DataFrame, id_col: str, tokens: Column, table: DataFrame,
               key: str = "word", value: str = "lemma", out: str = "mapped") -> DataFrame:
    """T3/J6-style lookup of every token in a (key -> value) table; tokens
    without an entry are kept, and of several entries of a key the smallest
    counts. Each distinct (id, word) is looked up once, by an equi-join, and
    a text gets its few found words back as one small map. The entries are
    written before the join, so that their real size decides whether the
    words are shuffled for it."""
    entries = Scratch(df.sparkSession, "token-map").write(
        table.groupBy(F.col(key).alias("word")).agg(F.min(value).alias("_v")), "entries")
    t = df.withColumn("_t", tokens)
    words = t.select(id_col, F.explode(F.array_distinct("_t")).alias("word"))
    found = (words.join(entries, "word").groupBy(id_col)
             .agg(F.map_from_entries(F.collect_list(F.struct("word", "_v"))).alias("_found")))
    return (t.join(found, id_col, "left")
            .withColumn(out, F.when(F.col("_found").isNull(), F.col("_t")).otherwise(
                F.transform("_t", lambda x: F.coalesce(F.try_element_at("_found", x), x))))
            .drop("_t", "_found"))


def preprocess(df: DataFrame, id_col: str, text_col: str, stop_words=None,
               lemmas: DataFrame | Callable[[DataFrame], DataFrame] | None = None, out: str = "processed") -> DataFrame:
    """T4: clean text (T1), then without ``stop_words`` (T2) if given, then with words mapped by ``lemmas``
    (word, lemma) (T3) if given; tokens joined by one space. ``lemmas`` may be a function that makes them from the
    tokens (id, t) of all texts. With lemmas the tokens are made once and written, as several steps read them."""
    tokens = F.filter(F.split(clean_text(text_col), " "), lambda x: x != F.lit(""))
    t = df.withColumn("_p", remove_stopwords(tokens, stop_words) if stop_words else tokens)
    if lemmas is not None:
        t = Scratch(df.sparkSession, "preprocess").write(t, "tokens")
        table = lemmas(t.select(id_col, F.col("_p").alias("t"))) if callable(lemmas) else lemmas
        t = map_tokens(t, id_col, F.col("_p"), table, out="_p2").drop("_p").withColumnRenamed("_p2", "_p")
    return t.withColumn(out, F.array_join("_p", " ")).drop("_p")
