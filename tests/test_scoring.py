"""Naive Bayes scoring of many configurations, the orders it counts in, and the draws and cleaning before it."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kiln.functions import text as tx
from kiln.functions.hashing import above_after, digits_after, hash_digits, unit_hash, with_prefix
from kiln.operators import naive_bayes as nb

FITS = [(7, [0]), (8, [0, 1]), (9, [2, 1, 0]), (5, [])]


@pytest.mark.parametrize("rows", [1, 4, 1000])
def test_sums_of_a_text_wait_for_the_next_batch(rows):
    """Sums per configuration equal plain sums, however the hits of a text are cut into batches; null classes included."""
    rng = random.Random(rows)
    hits = [(i, rng.randrange(1, 5), [{"cls": c, "n": [rng.randrange(3) for _ in range(3)]} for c in rng.sample(["x", "y", None, "z"], rng.randrange(1, 4))])
            for i in sorted(rng.choices(range(12), k=60))]
    counts = pa.list_(pa.struct([("cls", pa.string()), ("n", pa.list_(pa.int64()))]))
    batches = [pa.RecordBatch.from_arrays([pa.array([h[0] for h in part], pa.int64()), pa.array([h[1] for h in part], pa.int64()), pa.array([h[2] for h in part], counts)],
                                          names=["id", "tf", "classes"]) for part in (hits[k:k + rows] for k in range(0, len(hits), rows))]
    schema = pa.schema([("config", pa.int32()), ("id", pa.int64()), ("_t", pa.float64()), ("_s", pa.list_(pa.struct([("cls", pa.string()), ("s", pa.float64())])))])
    got = [r for b in nb._hit_sums(FITS, 3, 0.5, schema, iter([batches[0].slice(0, 0), *batches])) for r in b.to_pylist()]
    terms, sums = Counter(), defaultdict(Counter)
    for i, tf, classes in hits:
        for config, members in FITS:
            n = {c["cls"]: sum(c["n"][k] for k in members) for c in classes}
            terms[config, i] += tf * any(n.values())
            for c, m in n.items():
                sums[config, i][c] += tf * math.log((m + 0.5) / 0.5)
    assert {(r["config"], r["id"]): r["_t"] for r in got} == {k: v for k, v in terms.items() if v} and len(got) == len({(r["config"], r["id"]) for r in got})
    for r in got:
        assert {e["cls"]: e["s"] for e in r["_s"] if e["s"]} == pytest.approx({c: s for c, s in sums[r["config"], r["id"]].items() if s})


def test_hits_are_not_multiplied_by_configurations(spark):
    """Plan of the predictions: configurations meet the classes and the texts, never the counts of terms."""
    texts = spark.createDataFrame([(k % 2, "xy"[k % 2], "a b c" if k % 2 else "d e f") for k in range(8)], "cell int, label string, text string")
    test = spark.createDataFrame([(1, "a c"), (2, "d q"), (3, ""), (4, None)], "id long, text string")
    configs = spark.createDataFrame([(0, [0, 1]), (1, [1])], "config int, members array<int>")
    out = nb.cell_predictions(texts, test, configs, 2, "id", "text", "label", nb.cleaned_tokens("text"), 0.1)
    assert {(r.config, r.id): r.prediction for r in out.collect()} == {(0, 1): "y", (0, 2): "x", (0, 3): "x", (0, 4): "x"} | {(1, k): "y" for k in range(1, 5)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "MapInArrow" in plan


def test_orders_keep_equal_ids_together():
    """Ids that differ only behind the bits that are put in order, and ids that differ only in their second half."""
    rng = np.random.default_rng(3)
    ta = rng.choice(np.array([5, 6, 7, 1 << 40, (1 << 40) + 1, 1 << 63], np.uint64), 400)
    tb = rng.choice(np.array([0, 9], np.uint16), 400)
    order = nb.exact_order(ta, tb)
    assert sorted(order) == list(range(400)) and nb.changes(ta[order], tb[order]).sum() == len(set(zip(ta.tolist(), tb.tolist(), strict=True)))
    assert len(nb.exact_order(ta[:0], tb[:0])) == 0
    low = rng.integers(0, 9, 400)
    wide = ta << np.uint64(21)
    order = nb._order(wide, low)
    assert [(wide[k], low[k]) for k in order] == sorted(zip(wide, low, strict=True))
    assert list(nb._order(ta, low << 40)) == list(np.lexsort((low, ta)))


def test_draws_with_a_bound_prefix(spark):
    """The same draws as by single keys, null ids included."""
    df = spark.createDataFrame([(1, ["a", "b", "c"]), (None, ["a", "d"]), (2, [])], "id long, t array<string>")
    rows = df.select(with_prefix([F.col("id"), F.lit(1), "w"], lambda p: F.transform("t", lambda x: digits_after(p, x))).alias("d"),
                     with_prefix([F.col("id"), F.lit(1), "w"], lambda p: F.transform("t", lambda x, i: above_after(0.4, p, i))).alias("u"))
    want = df.select(F.transform("t", lambda x: hash_digits(F.col("id"), F.lit(1), "w", x)).alias("d"),
                     F.transform("t", lambda x, i: unit_hash(F.col("id"), F.lit(1), "w", i) > 0.4).alias("u"))
    assert [(r.d, r.u) for r in rows.collect()] == [(r.d, r.u) for r in want.collect()]


def test_cleaning_by_marks_and_in_one_pass(spark):
    """Texts with and without URLs, tags, punctuation and digits of several scripts, against one pass for each."""
    texts = [None, "", "see HTTP://x.y/z, www.a.b <b>bold</b> 12 <http://q> a<b", "x <a\n> y", "wwwww ww http", "٣٤ 5a5 a-b_c   d", "<i>x</i>http <y>", "İ WWW. x", "a1.2b"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    s = F.lower("t")
    for regex, to in ((tx.URL_RE, ""), (tx.TAG_RE, ""), (tx.PUNCT, ""), (tx.DIGITS_RE, ""), (f"{tx.WS}+", " ")):
        s = F.regexp_replace(s, regex, to)
    assert all(r.a == r.b for r in df.select(tx.clean_text("t").alias("a"), F.trim(s).alias("b")).collect())
