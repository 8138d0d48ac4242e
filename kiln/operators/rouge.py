"""ROUGE-N precision / recall / F per pair.

Normalisation follows the usual ROUGE scorer default: lower case, every run
of characters outside ``[a-z0-9]`` becomes a space, whitespace split. The
clipped overlap of one pair is ``sum_g min(count_pred(g), count_ref(g))``.
It is counted in the task that has the pair, by sorted n-gram codes, so no
n-gram is a row and a long text never meets another long text token by token.
Pairs with the same key share their counts; only those are aggregated by a
shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions.text import ngrams
from kiln.lineage import Scratch

#: Pairs whose n-grams are counted together.
ROWS = 512


def rouge_tokens(c) -> F.Column:
    s = F.trim(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", " "))
    return F.filter(F.split(s, " "), lambda x: x != F.lit(""))


def rouge_n(pairs: DataFrame, key_cols: list[str], pred_col: str, ref_col: str,
            orders=(1, 2), strip_eos: bool = True) -> DataFrame:
    """One row per pair: r{n}_precision, r{n}_recall, r{n}_fmeasure."""
    pred = F.col(pred_col)
    if strip_eos:
        pred = F.regexp_replace(pred, r"\s*<EOS>\s*$", "")
    toks = pairs.select(*key_cols, rouge_tokens(pred).alias("_p"), rouge_tokens(F.col(ref_col)).alias("_r"))
    toks = toks.select("*", *[F.greatest(F.size("_p") - (n - 1), F.lit(0)).alias(f"_np{n}") for n in orders],
                       *[F.greatest(F.size("_r") - (n - 1), F.lit(0)).alias(f"_nr{n}") for n in orders])
    work = Scratch(pairs.sparkSession, "rouge")
    toks = work.write(toks, "tokens")
    repeated = work.write(toks.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*key_cols), "repeated")
    single = toks.join(repeated, key_cols, "left_anti")
    kind = toks.drop("_p", "_r").schema
    for n in orders:
        kind = kind.add(f"_o{n}", "long")
    single = single.mapInArrow(partial(_overlaps, tuple(orders), [f.name for f in kind]), kind)
    # a key that is null in part equals no key
    known = F.lit(True)
    for k in key_cols:
        known = known & F.col(k).isNotNull()
    single = single.select(*[F.when(known, F.col(c)).alias(c) if c.startswith("_o") and c not in key_cols else c for c in single.columns])
    several = toks.join(repeated, key_cols, "left_semi")
    several = several.drop("_p", "_r").join(_pooled(several, key_cols, orders), key_cols, "left")
    res = single.unionByName(several)
    cols = []
    for n in orders:
        o = F.coalesce(F.col(f"_o{n}"), F.lit(0)).cast("double")
        p = F.when(F.col(f"_np{n}") > 0, o / F.col(f"_np{n}")).otherwise(F.lit(0.0))
        r = F.when(F.col(f"_nr{n}") > 0, o / F.col(f"_nr{n}")).otherwise(F.lit(0.0))
        cols += [p.alias(f"r{n}_precision"), r.alias(f"r{n}_recall")]
    res = res.select(*key_cols, *cols)
    for n in orders:
        p, r = F.col(f"r{n}_precision"), F.col(f"r{n}_recall")
        res = res.withColumn(f"r{n}_fmeasure", F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0)))
    return res


def _pooled(toks: DataFrame, key_cols: list[str], orders) -> DataFrame:
    """(*key_cols, _o{n}): the overlap of all pairs of a key, as one aggregation of their n-grams."""
    grams = None
    for n in orders:
        g = toks.select(*key_cols, F.lit(n).alias("n"),
                        F.explode(F.concat(
                            F.transform(ngrams(F.col("_p"), n, n), lambda x: F.struct(x.alias("g"), F.lit(1).alias("side"))),
                            F.transform(ngrams(F.col("_r"), n, n), lambda x: F.struct(x.alias("g"), F.lit(2).alias("side")))
                        )).alias("_x"))
        grams = g if grams is None else grams.unionByName(g)
    return (grams.groupBy(*key_cols, "n", F.col("_x.g"))
            .agg(F.sum(F.when(F.col("_x.side") == 1, 1).otherwise(0)).alias("cp"),
                 F.sum(F.when(F.col("_x.side") == 2, 1).otherwise(0)).alias("cr"))
            .groupBy(*key_cols)
            .agg(*[F.sum(F.when(F.col("n") == n, F.least("cp", "cr")).otherwise(0)).alias(f"_o{n}")
                   for n in orders]))


def _overlaps(orders: tuple[int, ...], names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            found = _overlap(part.column("_p"), part.column("_r"), orders)
            kept = [part.column(c) for c in names[:len(names) - len(orders)]]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(found[n], pa.int64()) for n in orders)], names=names)


def _overlap(pred: pa.ListArray, ref: pa.ListArray, orders: tuple[int, ...]) -> dict[int, np.ndarray]:
    """{n: the clipped overlap of each pair}; a null text has no n-grams."""
    pairs, out = len(pred), {}
    words = pa.concat_arrays([pc.list_flatten(pred), pc.list_flatten(ref)]).dictionary_encode()
    code, kinds = words.indices.to_numpy(zero_copy_only=False).astype(np.int64), max(1, len(words.dictionary))
    length = np.concatenate([pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False) for x in (pred, ref)])
    text, gram = np.repeat(np.arange(2 * pairs), length), code
    for n in range(1, max(orders) + 1):
        if n > 1:
            # n-grams end with their text; equal ones get the same code again
            inside = text[:max(0, len(text) - n + 1)] == text[n - 1:]
            gram = gram[:len(inside)] * kinds + code[n - 1:]
            gram = np.unique(gram, return_inverse=True)[1]
            own, shown = text[:len(inside)][inside], gram[inside]
        else:
            own, shown = text, gram
        if n in orders:
            key, place = np.unique(own % pairs * (shown.max(initial=0) + 1) + shown, return_inverse=True)
            least = np.minimum(np.bincount(place[own < pairs], minlength=len(key)), np.bincount(place[own >= pairs], minlength=len(key)))
            out[n] = np.bincount(key // (shown.max(initial=0) + 1), least, pairs).astype(np.int64)
    return out
