import re
from hashlib import sha256

import numpy as np
import pytest
from tests.llm.conftest import SMALL

from kiln.llm import fill_middle

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]", re.S)


def hexed(text):
    return sha256(text.encode()).hexdigest()


def brute(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    groups = hexed(f"1:{'' if doc_id is None else doc_id}")
    h = [int(groups[8 * k: 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(c in text for c in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(units), "plain", None, None, hexed(text), hexed(text)
    out = f"<S>{s}<P>{p}<M>{m}" if h[3] % 100 < 20 else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, len(units), "spm" if out[1] == "S" else "psm", len(p), len(m), hexed(out), hexed(text)


def check(docs, rows):
    got = sorted((tuple(r) for r in fill_middle.digests(fill_middle.fill_in_middle(docs)).collect()), key=str)
    assert got == sorted((brute(*r) for r in rows), key=str)
    return got


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = check(docs, [(r.doc_id, r.text) for r in docs.collect()])
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_edge_rows(make_docs):
    rows = [(k, t) for k, t in enumerate([
        None, "", "a", "ab", " ", "\n", "a<P>b", "<", "<<", "a<", "<S", "x <M> y", "a<b<c", "<p><s><m>", "ABC def\tghi 😀日本 é", "<P", ">", "same", "same",
        "\u0000nul", "<" * 50, "z" * 40_000, "q " * 40_000, "é" * 20_000])]
    rows += [(None, "no id here"), (3, "repeated"), (3, "repeated")]
    for shift in (0, 100, 200, 300):  # other draws of the same texts
        moved = [(None if k is None else k + shift, t) for k, t in rows]
        check(make_docs(moved), moved)
    check(make_docs([]), [])


@pytest.mark.parametrize("block", [1, 50, 1 << 20])
def test_blocks_do_not_matter(spark, monkeypatch, block):
    monkeypatch.setattr(fill_middle, "BLOCK", block)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(30)
    check(docs, [(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("gaps", ["words", "ones", "giants", "mixed", "single"])
def test_rank_index_is_exact_and_bounded(gaps):
    rng = np.random.default_rng(5)
    steps = {"words": rng.integers(1, 9, 50_000), "ones": np.ones(10_000, dtype=int), "giants": rng.integers(1, 5000, 2000),
             "mixed": np.where(rng.random(20_000) < 0.01, 3000, rng.integers(1, 6, 20_000)), "single": np.array([], dtype=int)}[gaps]
    offsets = np.concatenate([[0], np.cumsum(steps)]).astype(np.int64)
    index = fill_middle.RankIndex.fit(offsets)
    rank = np.arange(len(offsets))
    assert (index(rank) == offsets).all()
    assert np.abs(offsets - index.predict(rank)).max() <= fill_middle.ERROR + 1
    assert len(index.first) <= 1 + offsets[-1] / fill_middle.ERROR  # a break takes more than the error in characters
    if gaps in ("words", "ones"):
        assert len(index.first) < len(offsets) / 500
