"""Registered vector, fuzzy-relation, Mamdani and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.functions.hashing import sql_hash32
from kiln.operators import fuzzy as fz
from kiln.operators import rules, sets
from kiln.operators import vectors as vx
from kiln.operators.common import spread
from kiln.operators.split import pick_k
from kiln.plans import query
from kiln.sources.tables import load

COS_MIN = 0.4
ALPHAS = (0.4, 0.45, 0.5)  # levels at which these embeddings have edges


def embeddings(spark, sf_dir):
    return load(spark, sf_dir, "embeddings", spread=True)


CENTRES = 10

SQL_CENTRES = f"""
el AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS dim
       FROM embeddings),
cl AS (SELECT label, dim, avg(v) AS mean FROM el GROUP BY label, dim),
cv AS (SELECT label, list(mean ORDER BY dim) AS centre FROM cl GROUP BY label)"""
SQL_SAMPLED = f"""
cv AS (SELECT vec_id AS label, embedding::DOUBLE[] AS centre FROM
       (SELECT *, {sql_hash32('vec_id', "'42'", "'centres'")} AS h FROM embeddings) ORDER BY h, vec_id LIMIT {CENTRES}),
dd AS (SELECT max(sqrt(list_sum(list_transform(list_zip(a.centre, b.centre), lambda p: (p[1] - p[2]) * (p[1] - p[2])))))
              AS dmax, count(DISTINCT a.label) AS m FROM cv a, cv b),
sg AS (SELECT dmax, dmax / sqrt(2 * m) AS sigma, m AS n_centres FROM dd)"""


def sampled_centres(spark, sf_dir):
    """As many vectors as asked for, drawn without replacement; each is labelled by its own id."""
    drawn = pick_k(embeddings(spark, sf_dir), "vec_id", CENTRES, 42, "centres")
    return drawn.select(F.col("vec_id").alias("label"), vx.as_double_array("embedding").alias("centre"))


@query("class_centroids", f"WITH {SQL_CENTRES} SELECT label, dim::INTEGER AS dim, round(mean, 9) AS mean FROM cl")
def q_class_centroids(spark, sf_dir):
    c = vx.centroids_long(embeddings(spark, sf_dir), "embedding", "label")
    return c.select("label", "dim", F.round("mean", 9).alias("mean"))


@query("dmax_sigma", f"""WITH {SQL_SAMPLED}
SELECT round(dmax, 9) AS dmax, round(sigma, 9) AS sigma, n_centres::INTEGER AS n_centres FROM sg""")
def q_dmax_sigma(spark, sf_dir):
    c = sampled_centres(spark, sf_dir)
    d = vx.dmax_sigma(c)
    return d.select(F.round("dmax", 9).alias("dmax"), F.round("sigma", 9).alias("sigma"), "n_centres")


@query("rbf_features", f"""WITH {SQL_SAMPLED}
SELECT e.vec_id, c.label AS centre_label,
       round(exp(-list_sum(list_transform(list_zip(e.embedding::DOUBLE[], c.centre),
                 lambda p: (p[1] - p[2]) * (p[1] - p[2]))) / (2 * sg.sigma * sg.sigma)), 9) AS phi
FROM embeddings e, cv c, sg""")
def q_rbf_features(spark, sf_dir):
    e = embeddings(spark, sf_dir)
    c = sampled_centres(spark, sf_dir)
    f = vx.rbf_features(e, "vec_id", "embedding", c, vx.dmax_sigma(c))
    return f.select("vec_id", "centre_label", F.round("phi", 9).alias("phi"))


@query("nearest_centroid", f"""WITH {SQL_CENTRES},
d AS (SELECT e.vec_id, e.label, c.label AS cl,
             list_sum(list_transform(list_zip(e.embedding::DOUBLE[], c.centre),
                      lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM embeddings e, cv c)
SELECT vec_id, label, first(cl ORDER BY d, cl) AS predicted FROM d GROUP BY vec_id, label""")
def q_nearest_centroid(spark, sf_dir):
    e = embeddings(spark, sf_dir)
    c = vx.centroid_vectors(e, "embedding", "label")
    return vx.nearest_centre(e.select("vec_id", "label", "embedding"), "vec_id", "embedding", c) \
        .select("vec_id", "label", "predicted")


SQL_COS = f"""
nv AS (SELECT vec_id, embedding::DOUBLE[] AS v, list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) AS nn
       FROM embeddings),
cp AS (SELECT a.vec_id AS i, b.vec_id AS j, abs(list_dot_product(a.v, b.v)) / sqrt(a.nn * b.nn) AS sim
       FROM nv a JOIN nv b ON a.vec_id < b.vec_id),
edges AS (SELECT i, j, sim FROM cp WHERE sim >= {COS_MIN})"""


def cosine_edges(spark, sf_dir):
    return vx.cosine_pairs(embeddings(spark, sf_dir), "vec_id", "embedding", COS_MIN, absolute=True)


@query("cosine_pairs", f"WITH {SQL_COS} SELECT i, j, round(sim, 6) AS sim FROM edges")
def q_cosine_pairs(spark, sf_dir):
    return cosine_edges(spark, sf_dir).select("i", "j", F.round("sim", 6).alias("sim"))


@query("cosine_join_report")
def q_cosine_join_report(spark, sf_dir):
    """What the cells of the metric partition spare the join."""
    return vx.cosine_join_report(embeddings(spark, sf_dir), "vec_id", "embedding", COS_MIN)


ALPHA_SQL = ", ".join(f"({a}::DOUBLE)" for a in ALPHAS)


@query("alpha_cut", f"""WITH {SQL_COS}
SELECT a.alpha, i, j FROM edges, (VALUES {ALPHA_SQL}) a(alpha) WHERE sim >= a.alpha""")
def q_alpha_cut(spark, sf_dir):
    e = cosine_edges(spark, sf_dir)
    alphas = F.array(*[F.lit(a) for a in ALPHAS])
    return (e.select("i", "j", "sim", F.explode(alphas).alias("alpha"))
            .filter(F.col("sim") >= F.col("alpha")).select("alpha", "i", "j"))


SQL_FOREST = f"""{SQL_COS},
nd AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS r FROM embeddings),
we AS (SELECT i, j, round(sim, 9) AS w FROM edges),
od AS (SELECT i, j, w, a.r AS ri, b.r AS rj, row_number() OVER (ORDER BY w DESC, i, j) AS k
       FROM we JOIN nd a ON a.vec_id = i JOIN nd b ON b.vec_id = j),
fold(k, tree, i, j, w, taken) AS (
  SELECT 0::BIGINT, (SELECT list(r ORDER BY r) FROM nd), NULL::BIGINT, NULL::BIGINT, NULL::DOUBLE, false
  UNION ALL
  SELECT od.k, list_transform(tree, lambda x: CASE WHEN x = greatest(tree[ri], tree[rj]) THEN least(tree[ri], tree[rj]) ELSE x END),
         od.i, od.j, od.w, tree[ri] <> tree[rj]
  FROM fold JOIN od ON od.k = fold.k + 1)"""


def similarity_forest(spark, sf_dir):
    """The similarity relation's spanning forest, with memberships of nine digits."""
    edges = cosine_edges(spark, sf_dir).select("i", "j", F.round("sim", 9).alias("w"))
    return fz.spanning_forest(edges)


@query("fuzzy_forest", f"WITH RECURSIVE {SQL_FOREST} SELECT i, j, w FROM fold WHERE taken")
def q_fuzzy_forest(spark, sf_dir):
    """V3: the max-min closure of the similarity relation as n - 1 edges."""
    return similarity_forest(spark, sf_dir)


@query("fuzzy_closure", f"""WITH RECURSIVE {SQL_FOREST},
ts AS (SELECT tree FROM fold ORDER BY k DESC LIMIT 1),
mg AS (SELECT node, max(w) AS merge FROM (SELECT i AS node, w FROM we UNION ALL SELECT j, w FROM we) GROUP BY node)
SELECT n.vec_id, c.vec_id AS cluster, mg.merge
FROM nd n CROSS JOIN ts JOIN nd c ON c.r = ts.tree[n.r] LEFT JOIN mg ON mg.node = n.vec_id""")
def q_fuzzy_closure(spark, sf_dir):
    nodes = embeddings(spark, sf_dir).select(F.col("vec_id").alias("node"))
    return fz.closure_of_nodes(nodes, similarity_forest(spark, sf_dir)).withColumnRenamed("node", "vec_id")


@query("fuzzy_clusters", f"""WITH RECURSIVE {SQL_COS},
al AS (SELECT alpha FROM (VALUES {ALPHA_SQL}) a(alpha)),
ue AS (SELECT al.alpha, i AS s, j AS d FROM edges, al WHERE sim >= al.alpha
       UNION ALL SELECT al.alpha, j, i FROM edges, al WHERE sim >= al.alpha),
reach(alpha, src, dst) AS (
  SELECT al.alpha, vec_id, vec_id FROM embeddings, al
  UNION SELECT r.alpha, r.src, ue.d FROM reach r JOIN ue ON ue.alpha = r.alpha AND ue.s = r.dst)
SELECT alpha, src AS vec_id, min(dst) AS cluster FROM reach GROUP BY alpha, src""")
def q_fuzzy_clusters(spark, sf_dir):
    """All levels from one forest, whose edges are fewer than the nodes."""
    levels = F.array(*[F.lit(a) for a in ALPHAS])
    nodes = embeddings(spark, sf_dir).select(F.col("vec_id").alias("node"), F.explode(levels).alias("alpha"))
    forest = fz.spanning_forest(cosine_edges(spark, sf_dir).select("i", "j", F.col("sim").alias("w")))
    edges = forest.select("i", "j", "w", F.explode(levels).alias("alpha")).where("w >= alpha")
    return fz.threshold_components(nodes, edges, ["alpha"]).select("alpha", F.col("node").alias("vec_id"), "cluster")


SQL_MAMDANI = f"""
SELECT event_id, round({fz.sql_mamdani('y', 'theta')}, 6) AS u FROM (
  SELECT event_id, least(greatest((value - 25.0::DOUBLE) * 4.0::DOUBLE, -100.0::DOUBLE), 100.0::DOUBLE) AS y,
         (json_extract(props, '$.k')::DOUBLE - 50.0::DOUBLE) * 3.6::DOUBLE AS theta FROM events)"""


def controller_inputs(spark, sf_dir):
    ev = spread(load(spark, sf_dir, "events"))
    return ev.select("event_id", F.least(F.greatest((F.col("value") - 25.0) * 4.0, F.lit(-100.0)), F.lit(100.0)).alias("y"),
                     ((F.get_json_object("props", "$.k").cast("double") - 50.0) * 3.6).alias("theta"))


@query("mamdani_tables", SQL_MAMDANI)
def q_mamdani_tables(spark, sf_dir):
    """The same controller from rule tables, by a join of memberships with antecedents."""
    kinds = {"tri": "trimf", "trap": "trapmf"}
    sides = (("input", 1, "Y", (-100, 100), fz.MF_Y), ("input", 2, "THETA", (-180, 180), fz.MF_THETA), ("output", 1, "U", fz.U_RANGE, fz.MF_U))
    lines = []
    for side, n, name, (low, high), sets_of in sides:
        lines += [f"[{side.capitalize()}{n}]", f"Name='{name}'", f"Range=[{low} {high}]"]
        lines += [f"MF{k}='{label}':'{kinds[kind]}',[{' '.join(map(str, corners))}]" for k, (label, kind, corners) in enumerate(sets_of, 1)]
    tables = rules.parse(spark, "\n".join([*lines, "[Rules]", *(f"{y} {t}, {u} (1) : 1" for y, t, u in fz.RULES)]))
    scored = rules.score(controller_inputs(spark, sf_dir), "event_id", ["y", "theta"], *tables)
    return scored.select("event_id", F.round("u", 6).alias("u"))


@query("mamdani_score", f"""
SELECT event_id, round({fz.sql_mamdani('y', 'theta')}, 6) AS u FROM (
  SELECT event_id, least(greatest((value - 25.0::DOUBLE) * 4.0::DOUBLE, -100.0::DOUBLE), 100.0::DOUBLE) AS y,
         (json_extract(props, '$.k')::DOUBLE - 50.0::DOUBLE) * 3.6::DOUBLE AS theta FROM events)""")
def q_mamdani_score(spark, sf_dir):
    ev = spread(load(spark, sf_dir, "events"))
    x = ev.select("event_id",
                  F.least(F.greatest((F.col("value") - 25.0) * 4.0, F.lit(-100.0)), F.lit(100.0)).alias("y"),
                  ((F.get_json_object("props", "$.k").cast("double") - 50.0) * 3.6).alias("theta"))
    return fz.mamdani(x, "y", "theta").select("event_id", F.round("u", 6).alias("u"))


@query("row_mean", """
SELECT vec_id, round(list_avg(embedding::DOUBLE[]), 9) AS mean FROM embeddings""")
def q_row_mean(spark, sf_dir):
    return embeddings(spark, sf_dir).select("vec_id", F.round(vx.row_mean("embedding"), 9).alias("mean"))


# ------------------------------------------------------------ set operations
@query("sym_diff", """
WITH a AS (SELECT c_custkey AS key FROM customer WHERE c_acctbal > 0),
b AS (SELECT DISTINCT o_custkey AS key FROM orders WHERE o_totalprice > 100000)
(SELECT key FROM a EXCEPT SELECT key FROM b) UNION (SELECT key FROM b EXCEPT SELECT key FROM a)""")
def q_sym_diff(spark, sf_dir):
    """Customers in credit against customers with a large order."""
    a = load(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("key"))
    b = load(spark, sf_dir, "orders").where("o_totalprice > 100000").select(F.col("o_custkey").alias("key"))
    return sets.symmetric_difference([a, b], "key")


@query("distinct_sorted", "SELECT DISTINCT c_mktsegment FROM customer")
def q_distinct_sorted(spark, sf_dir):
    return sets.distinct_sorted(load(spark, sf_dir, "customer"), "c_mktsegment")


@query("union_missing", """
SELECT 'customer' AS kind, c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
       c_mktsegment AS segment FROM customer
UNION ALL
SELECT 'supplier', s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier""")
def q_union_missing(spark, sf_dir):
    c = load(spark, sf_dir, "customer").select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"))
    s = load(spark, sf_dir, "supplier").select(
        F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    return sets.union_all([c, s])


@query("flatten_index", """
SELECT c_custkey, flat, coalesce(list_position(flat, c_nationkey), 0)::BIGINT AS place, list_contains(flat, c_nationkey) AS held
FROM (SELECT c_custkey, c_nationkey, flatten([[c_custkey % 25, 7], [c_nationkey % 13]]) AS flat FROM customer)""")
def q_flatten_index(spark, sf_dir):
    """A nested list flattened, and where the customer's nation stands in it."""
    nested = F.array(F.array(F.col("c_custkey") % 25, F.lit(7).cast("long")), F.array((F.col("c_nationkey") % 13).cast("long")))
    flat, place, held = sets.flatten_index(nested, F.col("c_nationkey").cast("long"))
    return load(spark, sf_dir, "customer").select("c_custkey", flat.alias("flat"), place.cast("long").alias("place"), held.alias("held"))
