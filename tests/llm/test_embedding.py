import numpy as np
import pytest
from tests.llm.brute import components
from tests.llm.conftest import MEDIUM

from kiln.llm import embedding_dup


def expected(rows, cosine):
    """Exact links over all pairs."""
    good = [(i, lab, np.array(v, dtype=np.float64)) for i, lab, v in rows if i is not None and lab is not None and v
            and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, n = [], {}
    for a in range(len(good)):
        for b in range(a):
            (i, k, x), (j, m, y) = good[a], good[b]
            if k == m and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
                links.append((i, j))
                n[i], n[j] = n.get(i, 0) + 1, n.get(j, 0) + 1
    comp = components([r[0] for r in rows if r[0] is not None], links)
    return {i: (n.get(i, 0), c) for i, c in comp.items()}


def got(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in df.collect() if r.vec_id is not None}


def test_whole_table(spark):
    table = spark.read.parquet(f"{MEDIUM}/embeddings.parquet")
    rows = [(r.vec_id, r.label, r.embedding) for r in table.collect()]
    assert got(embedding_dup.near_duplicates(table)) == expected(rows, 0.93)


@pytest.mark.parametrize("tile", [1024, 16])
def test_groups_across_tiles(spark, monkeypatch, tile):
    monkeypatch.setattr(embedding_dup, "TILE", tile)
    draw = np.random.default_rng(4)
    rows = []
    for group in range(6):
        base = draw.standard_normal(24)
        rows += [(base + draw.standard_normal(24) * s).tolist() for s in draw.choice([0, 0.1, 0.25, 0.4], 25)]
    rows = [(7 * k % 1009, k % 5 % 2, v) for k, v in enumerate(rows)]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert got(embedding_dup.near_duplicates(table)) == expected(rows, 0.93)


def test_edge_rows(spark):
    one = [1.0, 2.0, 3.0]
    rows = [(1, 0, None), (2, 0, []), (3, 0, [0.0, 0.0, 0.0]), (4, 0, [float("nan"), 1.0, 1.0]), (5, 0, [None, 1.0, 1.0]), (6, None, one),
            (7, 0, [float("inf"), 1.0, 1.0]), (8, 0, one), (9, 0, [2.0, 4.0, 6.0]), (10, 0, one), (11, 1, one), (12, 0, [1.0, 2.0]),
            (13, 0, [1e300, 2e300, 3e300]), (14, 0, [-1.0, -2.0, -3.0])]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, label int, embedding array<double>, node int")
    want = {i: (0, i) for i in range(1, 15)} | {8: (3, 8), 9: (3, 8), 10: (3, 8), 13: (3, 8)}
    assert got(embedding_dup.near_duplicates(table)) == want
    again = embedding_dup.near_duplicates(table.unionAll(table.where("vec_id IN (8, 11)"))).collect()
    assert sorted(r.n_links for r in again if r.vec_id in (8, 11)) == [1, 1, 4, 4]
    nobody = spark.createDataFrame([(None, 0, one), (None, 0, one)], "vec_id long, label int, embedding array<double>")
    assert [(r.n_links, r.component_id, r.kept) for r in embedding_dup.near_duplicates(nobody).collect()] == [(0, None, True)] * 2
    assert embedding_dup.near_duplicates(table.where("vec_id > 99")).collect() == []


def test_pairs_at_the_threshold_are_judged_alike_in_every_tile():
    rng = np.random.default_rng(12)
    base = rng.standard_normal((40, 24))
    a = embedding_dup.unit_rows(np.repeat(base, 20, axis=0) + 0.05 * rng.standard_normal((800, 24)))
    cosine = float(np.einsum("ij,ij->i", a[:1], a[1:2])[0])  # exactly at the bound
    whole = embedding_dup.links_between(a, a, cosine)  # many pass: by block product
    alone = embedding_dup.links_between(a[:1], a[1:], cosine)  # few pass
    far = embedding_dup.links_between(a[1:2], a[rng.permutation(len(a))], cosine)
    assert whole[0, 1] and alone[0, 0] and far.sum() == whole[1].sum()
