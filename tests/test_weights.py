"""TF-IDF of all terms: chunks of documents that meet their document frequencies by packed ids."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from kiln.operators import vectorise as vec
from kiln.operators.blobs import packed, unpacked


def plain(rows: list[tuple], n_max: int) -> dict:
    """Rows of an id are one document, yet the number of documents is that of the rows."""
    tf = defaultdict(Counter)
    for key, words in rows:
        tf[key].update(" ".join(words[i:i + k]) for k in range(1, n_max + 1) for i in range(len(words) - k + 1))
    df = Counter(t for c in tf.values() for t in c)
    w = {k: {t: c * (math.log((1 + len(rows)) / (1 + df[t])) + 1) for t, c in terms.items()} for k, terms in tf.items()}
    return {(k, t): x / math.sqrt(sum(y * y for y in terms.values())) for k, terms in w.items() for t, x in terms.items()}


def texts(seed: int, n: int) -> list[list[str]]:
    rng = random.Random(seed)
    return [rng.choices(["aa", "bb", "cc", "dd", "éé", "ff"], k=rng.randrange(12)) for _ in range(n)]


@pytest.mark.parametrize("ids", [list(range(30)), [None, None, *range(25), 3, 3, 4]])
def test_weights_of_all_terms(spark, ids):
    """Unique, repeated and null ids against plain sums; unique ids need no window and no join of terms."""
    rows = list(zip(ids, texts(len(set(ids)), 30), strict=True))
    df = spark.createDataFrame([(k, " ".join(t)) for k, t in rows], "id long, text string")
    out = vec.vectorise(df, "id", "text", 1, 2, weighting="tfidf")
    got = {(r.id, r.term): r.weight for r in out.collect()}
    assert got == pytest.approx(plain(rows, 2)) and out.count() == len(got) and out.dtypes == [("id", "bigint"), ("term", "string"), ("weight", "double")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and ("Window" in plan) == (None in ids)


def test_weights_of_texts_without_terms(spark):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "a")], "id long, text string")
    assert vec.vectorise(df, "id", "text", weighting="tfidf").collect() == []
    df = spark.createDataFrame([(1, "aa"), (2, "aa bb")], "id long, text string")
    assert [(r.id, r.term, round(r.weight, 9)) for r in vec.vectorise(df, "id", "text", 2, 2, weighting="tfidf").collect()] == [(2, "aa bb", 1.0)]


@pytest.mark.parametrize("added", [False, True])
def test_chunks_meet_their_document_frequencies(monkeypatch, added):
    """However documents, or rows of terms, are cut into chunks and parts, each term gets its sum."""
    monkeypatch.setattr(vec, "CHUNK_TOKENS", 9)
    rows = list(enumerate(texts(7, 25)))
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.list_(pa.string()))], names=["id", "tok"])
    if added:
        tf = [(k, t, c) for k, w in rows for t, c in Counter(" ".join(w[i:i + n]) for n in (1, 2) for i in range(len(w) - n + 1)).items()]
        batch = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*tf, strict=True)], names=["id", "term", "count"])
    chunks = [b for b in vec._chunks(added, iter([batch, batch.slice(0, 0)]))]
    numbers = [b.column(0)[0].as_py() for b in chunks]
    assert len(set(numbers)) == len(numbers) > 5 and all((k < 0) == added for k in numbers)
    asked = pa.Table.from_batches(list(vec._ask(1, 2, 7, iter(chunks))))
    back = pa.concat_tables([vec._document_frequencies(asked.filter(pa.compute.equal(asked["part"], p))) for p in set(asked["part"].to_pylist())])
    schema = pa.schema([("id", pa.int64()), ("term", pa.string()), ("weight", pa.float64())])
    out = [r for b in chunks for r in vec._weigh(1, 2, len(rows), schema, pa.Table.from_batches([b]), back.filter(pa.compute.equal(back["chunk"], b.column(0)[0]))).to_pylist()]
    got = {(r["id"], r["term"]): r["weight"] for r in out}
    if added:  # without norms yet
        norm = Counter()
        for (k, _), w in got.items():
            norm[k] += w * w
        got = {(k, t): w / math.sqrt(norm[k]) for (k, t), w in got.items()}
    assert got == pytest.approx(plain(rows, 2)) and len(out) == len(got)


def test_packed_columns_come_back():
    columns = [np.array([1, 1 << 63], np.uint64), np.zeros(0, np.uint16), np.array([-5, 7, 9], np.int64)]
    got = unpacked(packed(columns), [np.uint64, np.uint16, np.int64])
    assert [(c.dtype, c.tolist()) for c in got] == [(c.dtype, c.tolist()) for c in columns]
