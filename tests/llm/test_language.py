import itertools
import zlib

import numpy as np
from pyspark.sql import functions as F
from tests.llm.conftest import MEDIUM

from kiln.llm import catalogue, language


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.lang for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang").collect()}
    out = catalogue.op5_language_id(spark, MEDIUM).collect()
    assert len(out) == len(labels)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.lang_pred == labels[r.doc_id] for r in held) / len(held) > 0.97


def model():
    texts = {"aa": "lorem dolor sit amet ipsum " * 50, "bb": "the quick brown fox jumps over dogs " * 50, "cc": "zyx wvu tsr qpo " * 50}
    counts = np.zeros((3, language.BUCKETS))
    for k, text in enumerate(texts.values()):
        np.add.at(counts[k], language.trigrams(text), 1)
    return language.Mixture(list(texts), counts)


def test_mixture_of_two_languages():
    lang, score, chosen, parts = model().infer("lorem dolor sit amet " * 30 + "the quick brown fox " * 10)
    assert (lang, chosen) == ("aa", ["aa", "bb"]) and 0.6 < parts[0] < 0.85 and abs(sum(parts) - 1) < 1e-9
    assert abs(score - parts[0]) < 1e-6
    assert model().infer("the quick brown fox jumps")[2] == ["bb"]


def grid(n, steps):
    """All proportions of n languages in ``steps`` equal parts."""
    if n == 1:
        yield (steps,)
        return
    for first in range(steps + 1):
        for rest in (grid(n - 1, steps - first) if n > 2 else [(steps - first,)]):
            yield (first, *rest)


def test_mixtures_against_a_likelihood_grid():
    """EM reaches the best likelihood of a grid, and the set is the best of all sets by penalised likelihood."""
    m = model()
    for text in ("lorem dolor sit amet " * 30 + "the quick brown fox " * 10, "zyx wvu tsr " * 20 + "ipsum lorem " * 20 + "over dogs jumps " * 20,
                 "the quick brown fox jumps", "zyx wvu the quick lorem " * 3, "dogs dolor " * 40):
        buckets, weight = np.unique(language.trigrams(text), return_counts=True)
        total, best = weight.sum(), {}
        for chosen in (c for n in (1, 2, 3) for c in itertools.combinations(range(3), n)):
            chance = m.chance[buckets][:, chosen]
            # the smallest proportion is a part in a thousand, so that no trigram has chance 0
            shares = [(np.array(p) / 50 + 1e-3) / (1 + 1e-3 * len(chosen)) for p in grid(len(chosen), 50)]
            likelihoods = [float(weight @ np.log(chance @ share)) for share in shares]
            share, likelihood = m._proportions(chance, weight.astype(float))
            at = int(np.argmax(likelihoods))
            assert likelihood > likelihoods[at] - 1e-3 * total and (len(chosen) == 1 or np.abs(share - shares[at]).max() < 0.05)
            best[chosen] = max(likelihood, likelihoods[at]) / language.OVERLAP - np.log1p(total / language.OVERLAP) * (len(chosen) - 1)
        found = m.infer(text)[2]
        assert tuple(sorted(m.languages.index(x) for x in found)) == max(best, key=best.get)


def test_texts_without_letters():
    for text in (None, "", "123 !! ...", "\n"):
        assert model().infer(text) == ("und", 0.0, [], [])
    assert language.Mixture([], model().chance.T[:0]).infer("abc") == ("und", 0.0, [], [])


def test_case_digits_and_long_texts():
    assert (language.trigrams("Ab c") == language.trigrams("aB, 9c!")).all()
    assert len(language.trigrams("漢字 𝒳" * 200_000)) > 100_000


def test_edge_rows(spark):
    rows = [(1, "le chat est la", "fr", "s"), (2, None, "fr", "s"), (None, "the cat", "en", "s"), (3, "123", None, "s"), (4, "", "en", "s"),
            (4, "the cat is here", "en", "s"), (4, "the cat is here", "en", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    out = language.with_language(docs).collect()
    assert len(out) == 7 and sorted(r.lang_pred for r in out)[-3:] == ["und"] * 3
    assert language.with_language(docs.where("doc_id > 9")).collect() == []
    odd = docs.withColumn("_text", F.lit(1)).withColumn("dotted.name", F.lit(2))
    assert language.with_language(odd).columns == ["doc_id", "text", "lang", "_text", "dotted.name", "lang_pred", "score", "languages",
                                                   "proportions"]
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.with_language(unlabelled).collect()} == {"und"}
