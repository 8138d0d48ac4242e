"""Exact similarity join and spanning forest against brute force."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kiln.operators import fuzzy as fz
from kiln.operators import vectors as vx


def clustered(n, clusters, dim, noise, seed):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((clusters, dim))
    out = centres[rng.integers(0, clusters, n)] + noise * rng.standard_normal((n, dim))
    return out * rng.choice([-1.0, 1.0], n)[:, None] * rng.uniform(0.1, 9, n)[:, None]


def table(spark, vectors):
    return spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "id long, v array<double>").repartition(4)


def brute(vectors, threshold, absolute):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    sim = unit @ unit.T
    sim = np.abs(sim) if absolute else sim
    return {(int(i), int(j)): sim[i, j] for i, j in zip(*np.nonzero(np.triu(sim >= threshold, 1)), strict=True)}


@pytest.mark.parametrize("absolute,threshold,noise,tile", [(True, 0.9, 0.1, 16), (False, 0.9, 0.1, 16), (True, 0.4, 2.0, 64), (True, 0.99, 0.05, 8),
                                                            (False, -0.2, 0.3, 50)])
def test_cosine_pairs_equal_brute_force(spark, absolute, threshold, noise, tile):
    vectors = clustered(300, 20, 12, noise, 4)
    rows = vx.cosine_pairs(table(spark, vectors), "id", "v", threshold, absolute, tile).collect()
    got = {(r.i, r.j): r.sim for r in rows}
    want = brute(vectors, threshold, absolute)
    assert len(rows) == len(got) and set(got) == set(want)
    assert all(math.isclose(got[k], want[k], abs_tol=1e-9) for k in want)


def test_clusters_are_not_multiplied_with_each_other(spark):
    vectors = clustered(2000, 40, 16, 0.05, 9)
    found = vx.cosine_join_report(table(spark, vectors), "id", "v", 0.95, True, 50).first()
    assert found.vectors == 2000 and found.products == 2000 * 1999 // 2
    assert found.products_met < 0.1 * found.products and found.tile_pairs_met < 0.1 * found.tile_pairs
    assert vx.cosine_pairs(table(spark, vectors), "id", "v", 0.95, True, 50).count() == len(brute(vectors, 0.95, True))


def test_one_repeated_vector_and_edge_rows(spark):
    rows = [(k, [1.0, 2.0]) for k in range(40)] + [(100, [0.0, 0.0]), (101, None), (102, [float("nan"), 1.0]), (None, [1.0, 2.0]), (103, [-2.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    out = vx.cosine_pairs(df, "id", "v", 0.5, True, 8).collect()
    assert sorted((r.i, r.j) for r in out) == [(i, j) for i in range(40) for j in range(i + 1, 40)]
    empty = df.limit(0)
    assert vx.cosine_pairs(empty, "id", "v", 0.5).collect() == [] and vx.cosine_join_report(empty, "id", "v", 0.5).first().vectors == 0


def path_minima(forest, nodes):
    """Closure weights from the forest: the least weight on the path between every two nodes."""
    near = {n: [] for n in nodes}
    for i, j, w in forest:
        near[i].append((j, w))
        near[j].append((i, w))
    out = {}
    for root in nodes:
        todo = [(root, math.inf)]
        seen = {root}
        while todo:
            at, least = todo.pop()
            for other, w in near[at]:
                if other not in seen:
                    seen.add(other)
                    out[root, other] = min(least, w)
                    todo.append((other, out[root, other]))
    return out


@pytest.mark.parametrize("finish", [0, 1 << 18])
@pytest.mark.parametrize("levels", [3, 1000])
def test_forest_stands_for_the_closure(spark, finish, levels):
    """Every path minimum equals the cell of the literal closure, with and without ties."""
    rng = np.random.default_rng(levels)
    cells = {(int(min(a, b)), int(max(a, b))): float(rng.integers(1, levels + 1)) / levels
             for a, b in rng.integers(0, 40, (70, 2)) if a != b}
    edges = spark.createDataFrame([(i, j, w) for (i, j), w in cells.items()], "i long, j long, w double").repartition(3)
    forest = [tuple(r) for r in fz.spanning_forest(edges, finish).collect()]
    nodes = {n for e in cells for n in e}
    both = edges.unionAll(edges.selectExpr("j", "i", "w"))
    closure = {(r.i, r.j): r.w for r in fz.transitive_closure(both).collect() if r.i != r.j}
    assert path_minima(forest, nodes) == closure
    kept = sorted(forest, key=lambda e: (-e[2], e[0], e[1]))  # the tie rule: greedy in the order of w, i, j
    root, greedy = {n: n for n in nodes}, []
    for (i, j), w in sorted(cells.items(), key=lambda e: (-e[1], e[0])):
        if root[i] != root[j]:
            greedy.append((i, j, w))
            old = root[j]
            root = {n: root[i] if r == old else r for n, r in root.items()}
    assert kept == greedy


def test_forest_of_a_hub_and_a_chain(spark):
    hub = [(0, k, 0.5) for k in range(1, 400)]
    chain = [(k, k + 1, k / 2000) for k in range(1000, 1200)]
    edges = spark.createDataFrame([*hub, *chain, (5, 5, 1.0), (1, 2, None), (3, 0, 0.4)], "i long, j long, w double")
    assert sorted(tuple(r) for r in fz.spanning_forest(edges, 0).collect()) == sorted([*hub, *chain])
    assert fz.spanning_forest(edges.limit(0), 0).collect() == []
    nodes = spark.createDataFrame([(0,), (1,), (1000,), (1200,), (7777,)], "node long")
    got = {r.node: (r.cluster, r.merge) for r in fz.closure_of_nodes(nodes, fz.spanning_forest(edges)).collect()}
    assert got == {0: (0, 0.5), 1: (0, 0.5), 1000: (1000, 0.5), 1200: (1000, 1199 / 2000), 7777: (7777, None)}


def test_components_of_one_task_equal_those_of_rounds(spark):
    rng = np.random.default_rng(6)
    rows = [(float(g), int(a), int(b)) for g, a, b in zip(rng.integers(0, 3, 120), rng.integers(0, 90, 120), rng.integers(0, 90, 120), strict=True)]
    edges = spark.createDataFrame(rows, "alpha double, i long, j long").repartition(3)
    nodes = spark.range(95).select(F.col("id").alias("node")).crossJoin(spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "alpha double"))
    got = [sorted(map(tuple, fz.threshold_components(nodes, edges, ["alpha"], finish).collect())) for finish in (0, 1000)]
    assert got[0] == got[1] and len(got[0]) == 285


def test_tiles_grow_where_cells_part_nothing(spark):
    """A vector goes to a fixed number of tiles, so what is shuffled grows with the rows and not with their square."""
    vectors = np.random.default_rng(3).standard_normal((20_000, 6))
    found = vx.cosine_join_report(table(spark, vectors), "id", "v", 0.9).first()
    assert found.vectors == 20_000 and found.tile_pairs_met <= vx.MOST_COPIES * (vx.MOST_COPIES + 1) // 2
    some = vectors[:1500]
    rows, pivots = vx._layout(vectors[:4096], 1_000_000, 1.5, True)
    assert rows * vectors.shape[1] * 8 <= vx.TILE_BYTES and len(pivots) == 1
    near = clustered(4096, 400, 16, 0.01, 5)
    assert vx._layout(near, 200_000, 0.1, True)[0] < 200_000 // vx.MOST_COPIES  # clusters keep their small tiles
    got = {(r.i, r.j) for r in vx.cosine_pairs(table(spark, some), "id", "v", 0.95).collect()}
    assert got == set(brute(some, 0.95, True))


def test_edges_of_a_task_are_thinned_to_a_forest(monkeypatch):
    rng = np.random.default_rng(8)
    edges = {(int(min(a, b)), int(max(a, b))): float(rng.integers(1, 5)) for a, b in rng.integers(0, 60, (1500, 2)) if a != b}
    rows = pa.table({"i": [i for i, _ in edges], "j": [j for _, j in edges], "w": list(edges.values())})
    want = list(fz._finish([b.append_column("a", b["i"]).append_column("b", b["j"]) for b in rows.to_batches()]))
    for size in (40, 500, 1 << 19):
        monkeypatch.setattr(fz, "THIN_EDGES", size)
        kept = pa.Table.from_batches(fz._thin(rows.to_batches(max_chunksize=50)))
        assert len(kept) < len(rows) if size == 500 else len(kept) == 59 if size > 500 else True
        again = list(fz._finish([b.append_column("a", b["i"]).append_column("b", b["j"]) for b in kept.combine_chunks().to_batches()]))
        assert [b.to_pydict() for b in again] == [b.to_pydict() for b in want]
