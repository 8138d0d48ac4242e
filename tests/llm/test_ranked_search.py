import math
import re
from collections import Counter

import numpy as np
import pytest
from tests.llm.conftest import SMALL

from kiln.llm import ranked_search

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, k=10):
    """The written-out score of every document for every item."""
    words = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in docs]
    words = [(i, w) for i, w in words if w]
    n_docs, n_terms = len(words), sum(len(w) for _, w in words)
    counts = [(i, len(w), Counter(w)) for i, w in words]
    df = Counter(t for _, _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, n, c in counts:
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in TERM.findall((text or "").translate(LOWER)) if t in c)
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def rows(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert rows(ranked_search.search(docs, items)) == want and len(want) > 100


def test_shards_and_blocks_do_not_matter(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(120)
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], 3)
    monkeypatch.setattr(ranked_search, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(ranked_search, "SHARD_DOCS", 7)
    monkeypatch.setattr(ranked_search, "SHARD_POSTINGS", 400)
    assert rows(ranked_search.search(docs, items, 3)) == want


def test_edge_rows(spark, make_docs):
    docs = [(1, None), (2, ""), (3, " .,;"), (5, "alpha beta beta"), (4, "alpha beta beta"), (4, "alpha beta beta"), (None, "Alpha BETA beta"),
            (6, "gamma " * 3000), (7, "Éa éa 日本 ALPHA9 alpha_beta"), (8, "x" * 50_000 + " delta"), (9, "\u0000beta\u007fgamma")]
    items = [(1, "alpha beta"), (1, "beta beta GAMMA"), (None, "éa Éa"), (3, None), (4, "... "), (5, "unseen"), (6, "日本 delta alpha9")]
    table = spark.createDataFrame([(i, t, 1, "s") for i, t in items], "item_id long, text string, doc_id int, score string")
    want = brute(docs, items, 4)
    assert rows(ranked_search.search(make_docs(docs), table, 4)) == want and len(want) > 10
    assert rows(ranked_search.search(make_docs([]), table)) == [] == rows(ranked_search.search(make_docs(docs), table.limit(0)))
    assert rows(ranked_search.search(make_docs(docs[:3]), table)) == []


@pytest.mark.parametrize("chunk", [1, 7, 1 << 20])
def test_terms_do_not_depend_on_pieces(monkeypatch, chunk):
    monkeypatch.setattr(ranked_search, "_CHUNK", chunk)
    text = "One two-three, ünï 4x5 \t日本語 end"
    assert [w.decode() for part in ranked_search.terms(text.encode()) for w in part] == TERM.findall(text.translate(LOWER))


def test_range_maxima_and_bounds():
    """Every stretch's greatest impact, and a search that leaves most documents of a large shard unscored."""
    rng = np.random.default_rng(3)
    docs, words = 4000, 40
    has = rng.random((docs, words)) < rng.random(words) * 0.3
    doc, term = np.nonzero(has)
    impact = rng.integers(1, 1000, len(doc)) * (1 + 20 * (rng.random(len(doc)) < 0.01))
    shard = ranked_search.Shard(term, doc, impact, docs, words)
    start = rng.integers(0, shard.first[1] - 1, 500)
    end = start + 1 + rng.integers(0, shard.first[1] - start)
    end = np.minimum(end, shard.first[1])
    assert [shard.impact[p] for p in shard.greatest(start, end)] == [shard.impact[a:b].max() for a, b in zip(start, end, strict=True)]
    items = [dict.fromkeys(rng.choice(words, 8, replace=False).tolist(), 1) for _ in range(40)]
    scored, before = [0], ranked_search.Search._score

    def counted(self, item, doc, score):
        scored[0] += len(item)
        return before(self, item, doc, score)

    ranked_search.Search._score = counted
    try:
        item, got, score = shard.search(items, 10)
    finally:
        ranked_search.Search._score = before
    for k, words_of in enumerate(items):
        total = np.zeros(docs, dtype=np.int64)
        for t in words_of:
            np.add.at(total, doc[term == t], impact[term == t])
        best = np.lexsort((np.arange(docs), -total))[:10]
        assert got[item == k].tolist() == best.tolist() and score[item == k].tolist() == total[best].tolist()
    assert scored[0] < 0.5 * docs * len(items)


def test_many_equal_documents_are_not_all_scored():
    docs = 3000
    shard = ranked_search.Shard(np.repeat([0, 1], docs), np.tile(np.arange(docs), 2), np.full(2 * docs, 7), docs, 2)
    search = ranked_search.Search(shard, [{0: 1, 1: 2}], 10)
    item, doc, score = search.run()
    assert doc.tolist() == list(range(10)) and set(score.tolist()) == {21} and search.used < 400
