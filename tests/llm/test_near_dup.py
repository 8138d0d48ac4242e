import random

import numpy as np
import pytest
from tests.llm import brute
from tests.llm.conftest import MEDIUM

from kiln.lineage import Scratch
from kiln.llm import near_dup
from kiln.llm.shingles import shingle_set, word_hashes
from kiln.operators.components import connected_components


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("text", ["", " \t\r\n\x0b\x0c", "one", " a B\tc ", "a b c d e f a b c d e",
                                  "É à b C d e f x", "x " * 40, "tab joined word kept here now then"])
def test_shingle_sets_match_tuples(text):
    assert len(shingle_set(text.encode())) == len(brute.shingles(text))


def test_shingle_identity():
    a, b = "The cat sat on the mat today", "the CAT\tsat  on the\nmat yesterday"
    assert len(np.intersect1d(shingle_set(a.encode()), shingle_set(b.encode()))) == \
        len(brute.shingles(a) & brute.shingles(b))


def test_long_text_is_hashed_whole():
    text = b" ".join(b"w%d" % k for k in range(400_000))
    assert len(word_hashes(text)) == 400_000 == len(np.unique(word_hashes(text)))


def test_table_against_all_pairs(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    for percent in (85, 80):
        assert result(near_dup.near_duplicates(docs, percent)) == brute.near_duplicates(rows, percent)


def test_large_groups_cross_tiles(make_docs, monkeypatch):
    monkeypatch.setattr(near_dup, "TILE", 8)
    draw = random.Random(5)
    words = [f"w{k}" for k in range(500)]
    rows = []
    for group in range(3):
        base = [draw.choice(words) for _ in range(80)]
        for _ in range(40):
            copy = list(base)
            for _ in range(draw.randint(0, 4)):
                copy[draw.randrange(80)] = draw.choice(words)
            rows.append((len(rows), " ".join(copy)))
    assert result(near_dup.near_duplicates(make_docs(rows), 85)) == brute.near_duplicates(rows, 85)


def test_edge_rows(make_docs):
    same = "one two three four five six seven"
    rows = [(3, None), (4, ""), (5, "  "), (9, same), (8, same), (8, same), (None, same), (11, "short text"),
            (12, "SHORT  text"), (13, "w " * 200_000)]
    out = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept)
                  for r in near_dup.near_duplicates(make_docs(rows)).collect()), key=str)
    assert out == sorted([(3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (9, 3, 8, False), (8, 3, 8, True),
                          (8, 3, 8, True), (None, 3, None, True), (11, 1, 11, True), (12, 1, 11, False),
                          (13, 1, 13, True)], key=str)


def test_empty_table(make_docs):
    assert near_dup.near_duplicates(make_docs([])).collect() == []


def test_components_of_a_long_path(spark):
    work = Scratch(spark, "test")
    path = spark.range(3000).selectExpr("(id * 7919) % 3001 AS a", "((id + 1) * 7919) % 3001 AS b")
    got = connected_components(path, work, "path")
    assert got.select("component").distinct().count() == 1 and got.count() == 3001
