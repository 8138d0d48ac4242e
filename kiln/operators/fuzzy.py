"""Fuzzy relations and Mamdani scoring.

* ``threshold_components``: clusters of the alpha-cut of the max-min
  transitive closure. The alpha-cut of the closure equals the connected
  components of the graph with edges w >= alpha, so the closure is never
  materialised: star contraction of the edge list until nothing changes.
* ``spanning_forest`` stands for the whole closure: the closure weight of two
  nodes is the least weight on their path in the maximum spanning forest.
* ``maxmin_compose`` / ``transitive_closure`` are the literal matrix
  operations for small relations (every (i, k) pair through every j); use
  them on relations of a few thousand cells, not on data-sized graphs.
* Mamdani scoring evaluates the rule base per row with array expressions:
  min AND, min implication, max aggregation, centroid over a sampled output
  universe.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.lineage import Scratch
from kiln.operators.components import connected_components

# The rule base of the controller (two inputs, one output).
# Membership functions as (name, shape, params) per variable, in file order;
# ranges: Y [-100, 100], THETA [-180, 180], U [-30, 30].
MF_Y = [("AB", "trap", (-100, -100, -40, -10)), ("AC", "tri", (-20, -10, 0)),
        ("BC", "tri", (0, 10, 20)), ("BE", "trap", (10, 40, 100, 100)), ("CE", "tri", (-5, 0, 5))]
MF_THETA = [("AO", "trap", (-180, -180, -120, -80)), ("AR", "tri", (-100, -70, -40)),
            ("BR", "tri", (40, 70, 100)), ("AH", "tri", (-50, -26, 0)), ("HZ", "tri", (-10, 0, 10)),
            ("BH", "tri", (0, 26, 50)), ("BO", "trap", (80, 120, 180, 180))]
MF_U = [("NB", "trap", (-30, -30, -30, -17)), ("NM", "tri", (-25, -15, -5)), ("NS", "tri", (-12, -6, 0)),
        ("ZE", "tri", (-5, 0, 5)), ("PS", "tri", (0, 6, 12)), ("PM", "tri", (5, 15, 25)),
        ("PB", "trap", (17, 30, 30, 30))]
U_RANGE = (-30.0, 30.0)
# Rules as (Y set, THETA set, U set), 1-based indices, all with weight 1.
RULES = [(4, 7, 7), (3, 7, 7), (5, 7, 6), (2, 7, 6), (1, 7, 5), (4, 3, 7), (3, 3, 7), (5, 3, 6),
         (2, 3, 5), (1, 3, 3), (4, 6, 7), (3, 6, 6), (5, 6, 5), (2, 6, 3), (1, 6, 2), (4, 5, 6),
         (3, 5, 6), (5, 5, 4), (2, 5, 2), (1, 5, 2), (4, 4, 6), (3, 4, 5), (5, 4, 3), (2, 4, 2),
         (1, 4, 1), (4, 2, 5), (3, 2, 3), (5, 2, 2), (2, 2, 1), (1, 2, 1), (4, 1, 3), (3, 1, 2),
         (5, 1, 2), (2, 1, 1), (1, 1, 1)]
U_SAMPLES = 101  # our choice: points of the sampled output universe


def membership(x: Column, shape: str, p) -> Column:
    """V8: triangle (a, b, c) or trapezoid (a, b, c, d); flat shoulders when
    a == b or c == d."""
    if shape == "tri":
        a, b, c, d = p[0], p[1], p[1], p[2]
    else:
        a, b, c, d = p
    left = F.lit(1.0) if a == b else (x - F.lit(float(a))) / F.lit(float(b - a))
    right = F.lit(1.0) if c == d else (F.lit(float(d)) - x) / F.lit(float(d - c))
    return F.greatest(F.lit(0.0), F.least(left, F.lit(1.0), right))


def sql_membership(x: str, shape: str, p) -> str:
    if shape == "tri":
        a, b, c, d = p[0], p[1], p[1], p[2]
    else:
        a, b, c, d = p
    left = "1.0::DOUBLE" if a == b else f"(({x} - {float(a)}::DOUBLE) / {float(b - a)}::DOUBLE)"
    right = "1.0::DOUBLE" if c == d else f"(({float(d)}::DOUBLE - {x}) / {float(d - c)}::DOUBLE)"
    return f"greatest(0.0::DOUBLE, least({left}, 1.0::DOUBLE, {right}))"


def mamdani(df: DataFrame, y_col: str, theta_col: str, out: str = "u") -> DataFrame:
    """V9: crisp output per row; NULL when no rule fires."""
    mu_y = [membership(F.col(y_col), s, p).alias(f"_y{i}") for i, (_, s, p) in enumerate(MF_Y, 1)]
    mu_t = [membership(F.col(theta_col), s, p).alias(f"_t{i}") for i, (_, s, p) in enumerate(MF_THETA, 1)]
    d = df.select("*", *mu_y, *mu_t)
    # strength of each output set: max over its rules of min(mu_y, mu_theta)
    strength = {}
    for ry, rt, ru in RULES:
        w = F.least(F.col(f"_y{ry}"), F.col(f"_t{rt}"))
        strength.setdefault(ru, []).append(w)
    s_cols = [(F.greatest(*ws) if len(ws) > 1 else ws[0]).alias(f"_s{u}") for u, ws in sorted(strength.items())]
    d = d.select("*", *s_cols)
    num, den = None, None
    for x, terms in output_samples():
        parts = [F.least(F.col(f"_s{u}"), F.lit(mu)) for u, mu in terms if u in strength]
        if not parts:
            continue
        m = F.greatest(*parts) if len(parts) > 1 else parts[0]
        num = m * F.lit(x) if num is None else num + m * F.lit(x)
        den = m if den is None else den + m
    drop = [c for c in d.columns if c.startswith(("_y", "_t", "_s"))]
    return d.withColumn(out, F.when(den > 0, num / den)).drop(*drop)


def output_samples():
    """Sampled output universe: [(x, [(set index, membership > 0), ...])].

    Computed from the output membership functions (a rule, not a table), so
    the aggregation over the universe becomes a flat sum of ``least`` /
    ``greatest`` terms that whole-stage codegen compiles; no lambda per row.
    """
    lo, hi = U_RANGE
    step = (hi - lo) / (U_SAMPLES - 1)
    out = []
    for i in range(U_SAMPLES):
        x = lo + i * step
        terms = []
        for u, (_, shape, p) in enumerate(MF_U, 1):
            mu = _mu(x, shape, p)
            if mu > 0:
                terms.append((u, mu))
        out.append((x, terms))
    return out


def _mu(x: float, shape: str, p) -> float:
    if shape == "tri":
        a, b, c, d = p[0], p[1], p[1], p[2]
    else:
        a, b, c, d = p
    left = 1.0 if a == b else (x - a) / (b - a)
    right = 1.0 if c == d else (d - x) / (d - c)
    return max(0.0, min(left, 1.0, right))


def sql_mamdani(y: str, theta: str) -> str:
    """DuckDB form of ``mamdani`` over columns ``y`` and ``theta``."""
    strength = {}
    for ry, rt, ru in RULES:
        strength.setdefault(ru, []).append(
            f"least({sql_membership(y, *MF_Y[ry - 1][1:])}, {sql_membership(theta, *MF_THETA[rt - 1][1:])})")
    s = {u: (f"greatest({', '.join(ws)})" if len(ws) > 1 else ws[0]) for u, ws in strength.items()}
    num, den = None, None
    for x, terms in output_samples():
        parts = [f"least({s[u]}, {mu!r}::DOUBLE)" for u, mu in terms if u in s]
        if not parts:
            continue
        m = f"greatest({', '.join(parts)})" if len(parts) > 1 else parts[0]
        num = f"{m} * {x!r}::DOUBLE" if num is None else f"{num} + {m} * {x!r}::DOUBLE"
        den = m if den is None else f"{den} + {m}"
    return f"(CASE WHEN {den} > 0 THEN ({num}) / ({den}) END)"


# ------------------------------------------------------------ relations
def alpha_cut(edges: DataFrame, alpha: float, w_col: str = "w") -> DataFrame:
    """V4: crisp relation of the cells with membership >= alpha."""
    return edges.filter(F.col(w_col) >= F.lit(float(alpha)))


def maxmin_compose(r: DataFrame, s: DataFrame) -> DataFrame:
    """V2/J8 for small relations (i, j, w): (R o S)(i, k) = max_j min(R(i,j), S(j,k))."""
    a = r.select(F.col("i"), F.col("j").alias("m"), F.col("w").alias("w1"))
    b = s.select(F.col("i").alias("m"), F.col("j").alias("k"), F.col("w").alias("w2"))
    return (a.join(b, "m").groupBy("i", "k").agg(F.max(F.least("w1", "w2")).alias("w"))
            .withColumnRenamed("k", "j"))


def transitive_closure(r: DataFrame) -> DataFrame:
    """V3 for small relations: square until nothing changes, keeping the max with the previous relation. Each
    round is written to the shared folder and the one before it removed. Memberships only grow and come from
    the finite set of input weights, so the loop ends."""
    work, turn = Scratch(r.sparkSession, "closure"), 0
    cur = work.write(r.select("i", "j", "w"), "0")
    while True:
        turn += 1
        nxt = work.write(cur.unionByName(maxmin_compose(cur, cur)).groupBy("i", "j").agg(F.max("w").alias("w")), str(turn))
        changed = (nxt.join(cur.withColumnRenamed("w", "w0"), ["i", "j"], "left")
                   .filter(F.col("w0").isNull() | (F.col("w") != F.col("w0"))).limit(1).count())
        work.drop(str(turn - 1))
        cur = nxt
        if changed == 0:
            return cur


#: Contracted relations of at most so many edges are finished by one task.
FINISH_EDGES = 1 << 18
_EDGE = "a long, b long, i long, j long, w double"


def _heaviest() -> Column:
    """The edge that comes first: greatest w, then smallest i and j."""
    return F.max(F.struct("w", (-F.col("i")).alias("i"), (-F.col("j")).alias("j"), "a", "b")).alias("e")


def _edge(e: str = "e") -> list[Column]:
    return [F.col(f"{e}.a").alias("a"), F.col(f"{e}.b").alias("b"), (-F.col(f"{e}.i")).alias("i"), (-F.col(f"{e}.j")).alias("j"),
            F.col(f"{e}.w").alias("w")]


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The forest of all edges of one task: heaviest first, an edge is kept when it joins two trees."""
    batches = list(batches)
    if not batches:
        return
    table = pa.Table.from_batches(batches).sort_by([("w", "descending"), ("i", "ascending"), ("j", "ascending")])
    root: dict[int, int] = {}
    kept = []
    for k, (a, b) in enumerate(zip(table["a"].to_pylist(), table["b"].to_pylist(), strict=True)):
        a, b = _top(root, a), _top(root, b)
        if a != b:
            root[a] = b
            kept.append(k)
    yield from table.take(pa.array(kept, pa.int64())).combine_chunks().to_batches()


#: Edges that a task looks through at a time for those that can't be in the forest.
THIN_EDGES = 1 << 19


def _forest(i: np.ndarray, j: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Places of the edges of the forest, by rounds of Boruvka over all edges at once."""
    order = np.lexsort((j, i, -w))
    nodes, ends = np.unique(np.concatenate([i[order], j[order]]), return_inverse=True)
    a, b = ends[:len(order)], ends[len(order):]
    kept, edge = np.zeros(len(order), bool), np.arange(len(order))
    while len(edge):
        # edges are in order, so a tree's first one is its heaviest
        first = np.full(len(nodes), len(order))
        np.minimum.at(first, a, edge)
        np.minimum.at(first, b, edge)
        root = np.arange(len(nodes))
        at = np.flatnonzero(first < len(order))
        kept[first[at]] = True
        chosen = np.searchsorted(edge, first[at])
        root[at] = a[chosen] + b[chosen] - at
        # two trees that chose the same edge point at each other: the smaller becomes the root
        mutual = (root[root] == np.arange(len(nodes))) & (np.arange(len(nodes)) < root)
        root[mutual] = np.flatnonzero(mutual)
        while not np.array_equal(up := root[root], root):
            root = up
        a, b = root[a], root[b]
        stay = a != b
        a, b, edge = a[stay], b[stay], edge[stay]
    return order[kept]


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a task without those that are the last of a circle: the forest of some edges and what was kept of those before."""
    waiting: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        waiting.append(batch)
        size += batch.num_rows
        if size >= THIN_EDGES:
            table = _thinned(waiting)
            waiting, size = table.to_batches(), table.num_rows
            if size > THIN_EDGES // 2:  # a forest this large is passed on
                yield from waiting
                waiting, size = [], 0
    if waiting:
        yield from _thinned(waiting).to_batches()


def _thinned(batches: list[pa.RecordBatch]) -> pa.Table:
    table = pa.Table.from_batches(batches)
    return table.take(pa.array(_forest(*(table[c].to_numpy() for c in ("i", "j", "w"))))).combine_chunks()


def _top(root: dict, x):
    """The root of x; nodes on the way then point to it."""
    path = []
    while (up := root.get(x, x)) != x:
        path.append(x)
        x = up
    root.update(dict.fromkeys(path, x))
    return x


def spanning_forest(edges: DataFrame, finish: int = FINISH_EDGES) -> DataFrame:
    """V3 for relations of any size: (i, j, w), i < j, the maximum spanning forest of symmetric ``edges`` (i, j, w).

    The max-min closure of two nodes is the least w on their path in the forest, so n - 1 edges stand for the n^2 cells of the
    closure and serve every alpha level. Of equal weights the edge with the smallest i, then j comes first, which makes the
    forest unique. Each round every tree takes its heaviest edge outwards, the trees so joined become one node, and of the
    edges between two of them the heaviest stays: the number of trees at least halves. Once at most ``finish`` edges are left, one
    task sorts them. Before the first round each task that makes edges drops those that are the last of a circle of its own
    edges, which no forest of all has; so what is shuffled follows the nodes of the tasks. Self-edges and null weights are
    ignored; an empty relation gives no rows.
    """
    work, turn, taken = Scratch(edges.sparkSession, "forest"), 0, []
    ends = edges.where("i <> j AND w IS NOT NULL").select(F.least("i", "j").cast("long").alias("i"),
                                                          F.greatest("i", "j").cast("long").alias("j"), F.col("w").cast("double").alias("w"))
    ends = ends.mapInArrow(_thin, "i long, j long, w double")
    current = work.write(ends.groupBy("i", "j").agg(F.max("w").alias("w")).selectExpr("i AS a", "j AS b", "i", "j", "w"), "edges-0")
    while current.count() > finish:
        turn += 1
        sides = current.select(F.col("a").alias("x"), "*").unionAll(current.select(F.col("b").alias("x"), "*"))
        picked = work.write(sides.groupBy("x").agg(_heaviest()).select(*_edge()).distinct(), f"picked-{turn}")
        taken.append(picked)
        trees = work.write(connected_components(picked.select("a", "b"), work, f"trees-{turn}"), f"tree-of-{turn}")
        # both sides of each join are plain scans: the tree with most of the edges can be split
        moved = work.write(current.join(trees.selectExpr("node AS a", "component AS ta"), "a").drop("a"), f"moved-{turn}")
        moved = (moved.join(trees.selectExpr("node AS b", "component AS tb"), "b").where("ta <> tb")
                 .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b"), "i", "j", "w"))
        current = work.write(moved.groupBy("a", "b").agg(_heaviest()).select(*_edge()), f"edges-{turn}")
        for name in (f"edges-{turn - 1}", f"moved-{turn}", f"tree-of-{turn}"):
            work.drop(name)
    out = current.coalesce(1).mapInArrow(_finish, _EDGE)
    for picked in taken:
        out = out.unionByName(picked)
    return work.write(out.select("i", "j", "w"), "forest")


def closure_of_nodes(nodes: DataFrame, forest: DataFrame) -> DataFrame:
    """(node, cluster, merge): the smallest node with a closure weight above 0 to ``node``, and the greatest closure weight that it
    has to any other node, the level below which it is no cluster of its own; null for a node without edges."""
    ends = forest.select(F.explode(F.array("i", "j")).alias("node"), "w")
    found = threshold_components(nodes, forest.select("i", "j"))
    return found.join(ends.groupBy("node").agg(F.max("w").alias("merge")), "node", "left").select("node", "cluster", "merge")


def threshold_components(nodes: DataFrame, edges: DataFrame, group_cols=(), finish: int = FINISH_EDGES) -> DataFrame:
    """V5: (*group, node, cluster) = smallest node id reachable over the (undirected) edges of the same group;
    isolated nodes are their own cluster. ``nodes``: (*group, node); ``edges``: (*group, i, j). All groups
    (e.g. alpha levels) advance in the same rounds, which go on until nothing changes; at most ``finish`` edges are one task's."""
    g, work = list(group_cols), Scratch(nodes.sparkSession, "clusters")
    links = work.write(edges.select(*g, F.col("i").cast("long").alias("a"), F.col("j").cast("long").alias("b")), "edges")
    if links.count() > finish:
        found = connected_components(links, work, "clusters", g)
    else:
        kind = links.select(*g, F.col("a").alias("node"), F.col("b").alias("component")).schema
        found = links.coalesce(1).mapInArrow(partial(_trees, len(g), [f.name for f in kind]), kind)
    return (nodes.select(*g, "node").join(found, [*g, "node"], "left")
            .select(*g, "node", F.coalesce("component", "node").alias("cluster")))


def _trees(keys: int, names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(*group, node, component) of all edges of one task; the root of a tree is its smallest node."""
    trees: dict[tuple, dict] = {}
    kinds = []
    for batch in batches:
        kinds = batch.schema.types
        for *group, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            root = trees.setdefault(tuple(group), {})
            a, b = _top(root, a), _top(root, b)
            root[max(a, b)] = root[min(a, b)] = min(a, b)
    rows = [(*group, node, _top(root, node)) for group, root in trees.items() for node in list(root)]
    if kinds:
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)
