"""Count and TF-IDF vectors of word n-grams in long form."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kiln.functions.text import ngrams, remove_stopwords, sk_tokenize
from kiln.lineage import Scratch
from kiln.operators.blobs import packed, unpacked
from kiln.operators.common import attach_row, lookup, small_side
from kiln.operators.naive_bayes import changes, exact_order, gram_ids, word_ids

#: Rows of a batch of counted terms, about.
BATCH_TERMS = 1 << 17
#: Tokens, or terms, of a chunk of documents that meets its document frequencies at once; a longer document is a chunk of its own.
CHUNK_TOKENS = 1 << 19


def document_terms(df: DataFrame, id_col: str, tokens: Column, n_min: int = 1, n_max: int = 1) -> DataFrame:
    """(id, n, term, count) of the word n-grams of each document, joined by one blank.

    A row's n-grams are counted where the row lies. Only the rows of ids that come more than once, null among them, are
    added up by a shuffle; those ids are found by themselves, without the texts.
    """
    rows = _with_rows(df, id_col, tokens, _repeated(df, id_col))
    kind = _term_kind(rows, id_col)
    once = rows.where("_rows IS NULL").select(id_col, "_tok").mapInArrow(partial(_count_terms, n_min, n_max, [f.name for f in kind]), kind)
    return once.unionByName(_added_terms(rows, id_col, n_min, n_max))


def _repeated(df: DataFrame, id_col: str) -> DataFrame:
    return small_side(df.groupBy(F.col(id_col).alias("_id")).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1"))


def _with_rows(df: DataFrame, id_col: str, tokens: Column, again: DataFrame) -> DataFrame:
    """(id, _rows, _tok): the rows with tokens; ``_rows`` is null for an id that comes once."""
    return df.join(again, F.col(id_col).eqNullSafe(F.col("_id")), "left").select(id_col, "_rows", tokens.alias("_tok")).where("size(_tok) > 0")


def _term_kind(rows: DataFrame, id_col: str) -> T.StructType:
    return rows.select(id_col).schema.add("n", "integer").add("term", "string").add("count", "long")


def _added_terms(rows: DataFrame, id_col: str, n_min: int, n_max: int) -> DataFrame:
    """The terms of the ids that come more than once."""
    kind = _term_kind(rows, id_col)
    counted = rows.where("_rows IS NOT NULL").select(id_col, "_tok").mapInArrow(partial(_count_terms, n_min, n_max, [f.name for f in kind]), kind)
    return counted.groupBy(id_col, "n", "term").agg(F.sum("count").alias("count"))


def _count_terms(n_min: int, n_max: int, names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, order, terms, counts = [], [], [], []
        for k, words in enumerate(batch.column(1)):
            words = words.as_py()
            for n in range(n_min, n_max + 1):
                found = Counter(words if n == 1 else map(" ".join, zip(*(words[i:] for i in range(n)), strict=False)))
                at += [k] * len(found)
                order += [n] * len(found)
                terms += found
                counts += found.values()
            if len(at) >= BATCH_TERMS or k == len(batch) - 1:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(order, pa.int32()),
                                                  pa.array(terms, pa.string()), pa.array(counts, pa.int64())], names=names)
                at, order, terms, counts = [], [], [], []


def grams(text_col: str, n_min: int = 1, n_max: int = 1, stop_words=()) -> tuple[Column, Column]:
    """(tokens, n-grams of a column ``_tok`` that holds them): words of two or more characters, lower case; stop words go
    before n-grams are made."""
    tokens = sk_tokenize(text_col)
    return (remove_stopwords(tokens, stop_words) if stop_words else tokens), ngrams(F.col("_tok"), n_min, n_max)


def vectorise(df: DataFrame, id_col: str, text_col: str, n_min: int = 1, n_max: int = 1, stop_words=(),
              max_features: int | None = None, weighting: str = "count") -> DataFrame:
    """(id, term, count), or (id, term, weight) with ``weighting='tfidf'``.

    ``max_features`` keeps the terms with the highest total count (ties by term); None keeps all. TF-IDF is
    tf * (ln((1 + n) / (1 + df)) + 1), divided by the document's L2 norm. A document without terms has no rows.
    TF-IDF of all terms shuffles no term: see ``_all_weights``. Otherwise terms are counted where the texts lie: (id, term, tf) is written and
    everything else reads that. Document frequencies are looked up with the commonest terms split off.
    """
    if weighting not in ("count", "tfidf"):
        raise ValueError(f"unknown weighting {weighting!r}")
    work = Scratch(df.sparkSession, "vectorise")
    tokens, _ = grams(text_col, n_min, n_max, stop_words)
    if weighting == "tfidf" and max_features is None:
        return _all_weights(df, id_col, tokens, n_min, n_max, work)
    tf = work.write(document_terms(df, id_col, tokens, n_min, n_max).drop("n"), "tf")
    stats = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("count").alias("_total"))
    if max_features is not None:
        stats = stats.orderBy(F.desc("_total"), "term").limit(max_features)
    if weighting == "count" and max_features is None:
        return tf
    found = lookup(tf, "term", work.write(stats, "terms"), "df", "df", [id_col]).where("df IS NOT NULL")
    if weighting == "count":
        return found.drop("df")
    n = df.agg(F.count(F.lit(1)).cast("double").alias("_n"))
    w = attach_row(found, n).withColumn("_w", F.col("count") * (F.log((1 + F.col("_n")) / (1 + F.col("df"))) + 1))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(id_col)))
    return w.select(id_col, "term", (F.col("_w") / norm).alias("weight"))


def _all_weights(df: DataFrame, id_col: str, tokens: Column, n_min: int, n_max: int, work: Scratch) -> DataFrame:
    """(id, term, weight) of every term.

    Documents are written as numbered chunks of coded words. A chunk sends the ids of its distinct terms (80 bits; two of m distinct terms
    share one with probability about m^2 / 2^81), packed, with the number of its documents that have them to the
    parts of a shuffle by id; each part sends the sums back in the same order, and the chunk makes its terms again from its words. Norms are
    sums within a chunk. An id that comes more than once, null among them, has its counts added up by a shuffle first, goes the same
    way as rows of terms and gets its norm by a second shuffle; so such a document may have any size.
    """
    spark, rows_n, again = df.sparkSession, df.count(), _repeated(df, id_col)
    rows = _with_rows(df, id_col, tokens, again)
    kind = T.StructType().add("chunk", "long").add("data", "binary")
    chunks = work.write(rows.where("_rows IS NULL").select(id_col, "_tok").mapInArrow(partial(_chunks, False), kind), "chunks")
    repeated = None if again.isEmpty() else work.write(
        _added_terms(rows, id_col, n_min, n_max).select(id_col, "term", "count").mapInArrow(partial(_chunks, True), kind), "repeated")
    every = chunks if repeated is None else chunks.unionByName(repeated)
    n = every.count()
    if not n:
        return spark.createDataFrame([], rows.select(id_col).schema.add("term", "string").add("weight", "double"))
    # a part gets about as many ids as a chunk has; the packed rows are short, so their number of tasks is given
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n)
    asked = T.StructType().add("part", "integer").add("chunk", "long").add("data", "binary")
    sums = (every.mapInArrow(partial(_ask, n_min, n_max, parts), asked).repartition(parts, "part")
            .groupBy("part").applyInArrow(_document_frequencies, asked))
    kind = rows.select(id_col).schema.add("term", "string").add("weight", "double")
    schema = to_arrow_schema(kind)

    def weighed(chunk, found):
        return _weigh(n_min, n_max, rows_n, schema, chunk, found)

    def met(some: DataFrame, found: DataFrame) -> DataFrame:
        return (some.repartition(parts, "chunk").groupBy("chunk").cogroup(found.repartition(parts, "chunk").groupBy("chunk"))
                .applyInArrow(weighed, kind))

    if repeated is None:
        return met(chunks, sums)
    sums = work.write(sums, "sums")
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(id_col)))
    return met(chunks, sums.where("chunk >= 0")).unionByName(
        met(repeated, sums.where("chunk < 0")).withColumn("weight", F.col("weight") / norm))


def _chunks(added: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, data): rows that follow each other as an Arrow stream, numbered by the task and the place in it; below zero if they are ``added`` terms."""
    task, made = TaskContext.get().partitionId() if TaskContext.get() else 0, 0
    for batch in batches:
        length = np.ones(len(batch), np.int64) if added else pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64)
        cuts = np.flatnonzero(np.diff((np.cumsum(length) - 1) // CHUNK_TOKENS)) + 1
        for low, high in zip([0, *cuts], [*cuts, len(batch)], strict=True):
            if high > low:
                part = batch.slice(low, high - low)
                if not added:
                    offsets = np.concatenate([[0], np.cumsum(length[low:high])])
                    coded = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pc.list_flatten(part.column(1)).dictionary_encode())
                    part = pa.RecordBatch.from_arrays([part.column(0), coded], names=["id", "tok"])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                    stream.write_batch(part)
                number = task << 32 | made
                yield pa.RecordBatch.from_arrays([pa.array([~number if added else number], pa.int64()),
                                                  pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["chunk", "data"])
                made += 1


def _chunk_terms(data: bytes, n_min: int, n_max: int) -> tuple:
    """(ids, words, code of each token); for each term of a document its row, first token, number of words and count; for each
    distinct term ta, tb and the place of its first row of those. Always in the same order."""
    batch = pa.ipc.open_stream(data).read_next_batch()
    added = batch.num_columns == 3
    tok = pc.split_pattern(batch.column(1), " ") if added else batch.column(1)
    length, coded = pc.list_value_length(tok).to_numpy(zero_copy_only=False), pc.list_flatten(tok)
    coded = coded.dictionary_encode() if added else coded
    code, row = coded.indices.to_numpy(zero_copy_only=False), np.repeat(np.arange(len(batch)), length)
    ta, tb, at, size = gram_ids(word_ids(coded.dictionary)[code], row, n_min, n_max)
    tb = (tb >> np.uint64(16)).astype(np.uint16)
    if added:  # a row is one term
        ta, tb, at, size = (x[size == length[row[at]]] for x in (ta, tb, at, size))
    order = exact_order(ta, tb)
    ta, tb, at, size = ta[order], tb[order], at[order], size[order]
    # the occurrences of a term are in order of its documents
    first = np.flatnonzero(changes(ta, tb, row[at]))
    count = batch.column(2).to_numpy(zero_copy_only=False)[row[at]] if added else np.diff(first, append=len(ta))
    ta, tb, at, size = ta[first], tb[first], at[first], size[first]
    start = np.flatnonzero(changes(ta, tb))
    return (batch.column(0), coded.dictionary, code), (row[at], at, size, count), (ta[start], tb[start], start), added


def _ask(n_min: int, n_max: int, parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            _, (row, *_), (ta, tb, start), _ = _chunk_terms(data, n_min, n_max)
            if not len(ta):
                continue
            df = np.diff(start, append=len(row)).astype(np.uint32)
            part = ((ta >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            cuts = np.flatnonzero(changes(part))
            blobs = [packed([np.diff(ta[low:high], prepend=np.uint64(0)), tb[low:high], df[low:high]])
                     for low, high in zip(cuts, np.append(cuts[1:], len(ta)), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(part[cuts], pa.int32()), pa.array(np.full(len(cuts), chunk), pa.int64()), pa.array(blobs, pa.binary())],
                                             names=["part", "chunk", "data"])


def _document_frequencies(table: pa.Table) -> pa.Table:
    """What the chunks asked of a part, with the sums over all chunks."""
    blobs = [unpacked(d, [np.uint64, np.uint16, np.uint32]) for d in table.column("data").to_pylist()]
    ta, tb, df = (np.concatenate(x) for x in zip(*((np.cumsum(a, dtype=np.uint64), b, n) for a, b, n in blobs), strict=True))
    order = exact_order(ta, tb)
    new = changes(ta[order], tb[order])
    sums = np.empty(len(order), np.int64)
    sums[order] = np.add.reduceat(df[order].astype(np.int64), np.flatnonzero(new))[np.cumsum(new) - 1]
    back = [packed([s]) for s in np.split(sums, np.cumsum([len(b[0]) for b in blobs])[:-1])]
    return table.set_column(table.schema.get_field_index("data"), "data", pa.array(back, pa.binary()))


def _weigh(n_min: int, n_max: int, n: int, schema: pa.Schema, chunk: pa.Table, found: pa.Table) -> pa.Table:
    """(id, term, weight) of a chunk; terms of ids that come more than once are not divided by their norm."""
    if not found.num_rows:
        return schema.empty_table()
    (ids, words, code), (row, at, size, count), (_, _, start), added = _chunk_terms(chunk.column("data")[0].as_py(), n_min, n_max)
    found = found.sort_by("part")
    df = np.concatenate([unpacked(d, [np.int64])[0] for d in found.column("data").to_pylist()])
    weight = count * (np.log((1.0 + n) / (1.0 + df)) + 1.0)[np.repeat(np.arange(len(start)), np.diff(start, append=len(row)))]
    if not added:
        weight /= np.sqrt(np.bincount(row, weight * weight, len(ids)))[row]
    out = []
    for k in range(n_min, n_max + 1):
        of = np.flatnonzero(size == k)
        parts = [words.take(pa.array(code[at[of] + i])) for i in range(k)]
        terms = pc.binary_join_element_wise(*parts, " ") if k > 1 else parts[0]
        columns = [ids.take(pa.array(row[of])), terms, pa.array(weight[of])]
        out.append(pa.table([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema))
    return pa.concat_tables(out)
