"""Naive Bayes parameter search against plain Python."""

import math
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from kiln.operators import naive_bayes as nb

TRIALS = [{"alpha": a, "max_features": m} for a, m in ((0.1, 5), (1.0, 30), (0.01, 10_000), (0.5, 80), (0.1, 12))]


def brute(docs, trials):
    tf = {i: Counter([*t.split(), *(" ".join(p) for p in zip(t.split(), t.split()[1:]))]) for i, t, _, _ in docs}
    fit = [(i, c) for i, _, c, held in docs if not held and c is not None]
    n = defaultdict(Counter)
    for i, c in fit:
        n[c].update(tf[i])
    total = sum(n.values(), Counter())
    ranked = sorted(total, key=lambda w: (-total[w], w.encode()))
    out = []
    for trial in trials:
        a, vocab = trial["alpha"], set(ranked[:trial["max_features"]])
        right = []
        for i, _, truth, held in docs:
            if held and truth is not None:
                score = {c: math.log(sum(x == c for _, x in fit) / len(fit)) + sum(
                    k * math.log((n[c][w] + a) / (sum(n[c][v] for v in vocab) + a * len(vocab))) for w, k in tf[i].items() if w in vocab)
                    for c in n}
                right.append(min(score, key=lambda c: (-score[c], c)) == truth)
        out.append((a, trial["max_features"], sum(right) / len(right)))
    return out


def test_search_equals_brute_force(spark):
    draw = random.Random(5)
    words = {c: [draw.choice("abcdefgh") * draw.randint(1, 3) + draw.choice("xyz") for _ in range(25)] for c in "pqr"}
    docs = []
    for i in range(150):
        c = draw.choice("pqr")
        mixed = [draw.choice(words[c] if draw.random() < 0.35 else words[draw.choice("pqr")]) for _ in range(draw.randint(0, 14))]
        docs.append((i, " ".join(mixed), c if i % 29 else None, i % 4 == 0))
    df = spark.createDataFrame(docs, "doc_id long, text string, label string, held boolean").repartition(3)
    rows = nb.parameter_search(df, "doc_id", "text", "label", F.col("held"), TRIALS).orderBy("trial").collect()
    want = brute(docs, TRIALS)
    assert [(r.alpha, r.max_features) for r in rows] == [w[:2] for w in want]
    assert all(math.isclose(r.accuracy, w[2]) for r, w in zip(rows, want, strict=True)) and len({r.accuracy for r in rows}) > 2


def test_only_terms_of_the_largest_vocabulary_are_ranked(spark, monkeypatch):
    """Terms are counted by class where the texts are, and those that no vocabulary can hold are not put in order."""
    texts = ["a b a b c", "a b <i>x</i> d", "a c", None, "", "b a b"] + [f"a w{k} b" for k in range(60)]
    rows = [(k, t, "xy"[k % 2] if k != 1 else None, k % 10 == 3) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string, held boolean").repartition(3)
    want = Counter((y, " ".join(g)) for _, t, y, _ in rows for w in [re.sub("<.*?>|[0-9]", "", t or "").split()] for n in (1, 2, 3)
                   for g in zip(*(w[k:] for k in range(n)), strict=False))
    got = Counter()
    for r in nb.term_counts(df, "label", nb.cleaned_tokens("text")).collect():
        got[r.label, r.term] += r.n
    assert got == want
    many = [(k, f"a u{chr(97 + k % 26)}{chr(97 + k // 26)} b", "xy"[k % 2], k % 10 == 3) for k in range(200)]
    ranked, index = [], nb.global_index
    monkeypatch.setattr(nb, "global_index", lambda d, *a, **k: ranked.append(d.count()) or index(d, *a, **k))
    out = nb.parameter_search(spark.createDataFrame(many, "doc_id long, text string, label string, held boolean"), "doc_id", "text", "label",
                              F.col("held"), [{"alpha": 0.1, "max_features": 2}])
    assert out.first().accuracy is not None and ranked == [2]
