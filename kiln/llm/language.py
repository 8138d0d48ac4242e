"""Language id by multilingual mixture inference.

A document's letter trigrams are drawn from a mixture of per-language distributions.
Expectation-maximisation estimates the proportions, and the set of languages is the one with the best
likelihood less a penalty for each language, so a text in one language is not split among several.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.names import quoted

#: Labelled documents taken per language to fit the trigram counts (the expected number; by hash of doc_id).
SAMPLE = 4000
BUCKETS = 1 << 16
SMOOTHING = 0.1
#: A letter takes part in three trigrams, so a text has about a third as many independent ones.
OVERLAP = 3.0
#: EM ends when no proportion moves by ``STILL``, or after ``ROUNDS``.
STILL, ROUNDS = 1e-5, 500
UNKNOWN = "und"
_TABLE = 0x32000


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """Lower-case code point of each letter, 0 for everything else."""
    out = np.zeros(_TABLE, dtype=np.uint32)
    for code in range(_TABLE):
        letter = chr(code)
        if letter.isalpha():
            out[code] = ord(letter.lower()[0])
    return out


def trigrams(text: str | None) -> np.ndarray:
    """Hashed letter trigrams of the whole text; runs of other characters count as one blank."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    folded = np.where(codes < _TABLE, _folded()[np.minimum(codes, _TABLE - 1)], codes)
    letter = folded > 0
    if not letter.any():
        return np.empty(0, dtype=np.uint16)
    kept = folded[letter | np.concatenate([[True], letter[:-1]])]
    line = np.concatenate([np.zeros(int(kept[0] > 0), np.uint32), kept, np.zeros(int(kept[-1] > 0), np.uint32)])
    mixed = line[:-2] * np.uint32(0x9E3779B1) ^ line[1:-1] * np.uint32(0x85EBCA6B) ^ line[2:] * np.uint32(0xC2B2AE35)
    mixed ^= mixed >> np.uint32(15)
    return (mixed * np.uint32(0x2C1B3C6D) >> np.uint32(16)).astype(np.uint16)


class Mixture:
    """Trigram distributions of the learned languages."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        smooth = counts + SMOOTHING
        self.chance = np.ascontiguousarray((smooth / smooth.sum(axis=1, keepdims=True)).T)  # bucket x language

    @staticmethod
    def _proportions(chance: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
        """EM for the mixing proportions; the proportions and the log likelihood."""
        share = np.full(chance.shape[1], 1 / chance.shape[1])
        total = weight.sum()
        for _ in range(ROUNDS if chance.shape[1] > 1 else 0):
            before, share = share, share * (chance.T @ (weight / (chance @ share))) / total
            if np.abs(share - before).max() < STILL:
                break
        return share, float(weight @ np.log(chance @ share))

    def infer(self, text: str | None) -> tuple[str, float, list[str], list[float]]:
        """(language, score, language set, proportions); ``und`` without letters or learned languages."""
        grams = trigrams(text)
        if not len(grams) or not self.languages:
            return UNKNOWN, 0.0, [], []
        buckets, weight = np.unique(grams, return_counts=True)
        chance, weight = self.chance[buckets], weight.astype(np.float64)
        alone = weight @ np.log(chance)
        penalty = np.log1p(len(grams) / OVERLAP)
        first = int(np.argmax(alone))
        chosen, share, best = [first], np.ones(1), float(alone[first]) / OVERLAP
        if len(self.languages) > 1:
            overall, _ = self._proportions(chance, weight)
            order = [int(k) for k in np.argsort(-overall, kind="stable") if k != first and overall[k] > 0.005]
            for n in range(1, len(order) + 1):
                trial = [first, *order[:n]]
                parts, likelihood = self._proportions(chance[:, trial], weight)
                if likelihood / OVERLAP - penalty * n <= best:
                    break
                chosen, share, best = trial, parts, likelihood / OVERLAP - penalty * n
        # how sure the leading language is against the others of the set and against those outside it
        lead = int(np.argmax(share))
        rival = np.exp(np.clip((alone - alone[chosen].max()) / OVERLAP, -50, 0))
        rival[chosen] = 0
        score = float(share[lead] / (1 + rival.sum()))
        order = np.argsort(-share, kind="stable")
        return (self.languages[chosen[lead]], min(1.0, score), [self.languages[chosen[k]] for k in order],
                [float(share[k]) for k in order])


def learn(labelled: DataFrame, sample: int = SAMPLE) -> Mixture:
    """Trigram counts per language from (doc_id, text, lang): at most about ``sample`` documents a language.

    The counts are added up by Spark; what reaches the driver is one row per language and used bucket, at
    most languages x 65,536, whatever the size of the corpus.
    """
    usable = labelled.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    known = {r.lang: r.n for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not known:
        return Mixture([], np.zeros((0, BUCKETS)))
    part = F.element_at(F.create_map(*[F.lit(x) for k, n in known.items() for x in (k, min(1.0, sample / n))]), F.col("lang"))
    drawn = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < part * (1 << 30))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = sums.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                np.add.at(found, trigrams(text.as_py()), 1)
        for lang, found in sums.items():
            used = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used.astype(np.int32)),
                                              pa.array(found[used])], names=["lang", "bucket", "n"])

    counts = (drawn.select("lang", "text").mapInArrow(run, "lang string, bucket int, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    languages = sorted(known)
    table = np.zeros((len(languages), BUCKETS))
    place = {lang: k for k, lang in enumerate(languages)}
    if counts.num_rows:
        table[[place[x] for x in counts["lang"].to_pylist()], counts["bucket"].to_numpy()] = counts["n"].to_numpy()
    return Mixture(languages, table)


def identify(docs: DataFrame, model: Mixture, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with lang_pred, score, languages and proportions appended.

    Only the whole text decides. lang_pred is the language with the largest proportion of the chosen set and
    score that proportion, lessened when a language outside the set explains the text nearly as well.
    A text that is null or has no letter gets ``und``, score 0 and empty lists. Input columns of these
    names are replaced; all others are passed through; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ("lang_pred", "score", "languages", "proportions")
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in names]
    places = [f"c{k}" for k in range(len(keep))]  # plain names for the Python side
    docs = docs.select(*[c.alias(p) for c, p in zip(quoted(keep), places, strict=True)], docs["text"].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.infer(text.as_py()) for text in batch.column(len(keep))]
            kinds = (pa.string(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array([x[k] for x in found], t) for k, t in enumerate(kinds))],
                names=[*places, *names])

    kind = docs.drop("text").selectExpr("*", "'' AS lang_pred", "0D AS score", "CAST(array() AS array<string>) AS languages",
                                    "CAST(array() AS array<double>) AS proportions").schema
    return docs.mapInArrow(run, kind).toDF(*keep, *names)


def held_out(doc_id: str = "doc_id"):
    """True for documents that nothing is learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def with_language(docs: DataFrame, sample: int = SAMPLE, keep: list[str] | None = None) -> DataFrame:
    """The columns of ``identify``, learned from the labelled rows of ``docs`` that aren't held out."""
    return identify(docs, learn(docs.where(~held_out()), sample), keep)
