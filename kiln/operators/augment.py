"""Deterministic text augmentation.

Randomness is ``hash32(doc_id, copy, purpose[, position])``; the same draw
is computable in SQL, and re-executing a task after executor loss gives the
same rows. Tokens come from the T5 tokenizer and are joined by one space.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.functions.hashing import above_after, digits_after, hash32, hash_digits, with_prefix
from kiln.functions.text import tokenize
from kiln.lineage import Scratch

TECHNIQUES = ("synonym", "deletion", "swap")
TOKENS = "_t"
#: Words of a text that are looked up first, where one synonym is wanted.
FIRST_WORDS = 8


def with_tokens(df: DataFrame, text_col: str) -> DataFrame:
    """Tokenise once; the variant builders reuse an existing ``_t`` column
    (e.g. one computed below a shuffle that all variants share)."""
    return df if TOKENS in df.columns else df.withColumn(TOKENS, tokenize(text_col))


def random_deletion(df: DataFrame, id_col: str, text_col: str, copy_col: str,
                    p: float = 0.1, out: str = "aug_text") -> DataFrame:
    """Drop each token with probability p; keep one token if all go;
    texts of one token (or none) are returned unchanged."""
    return with_tokens(df, text_col).withColumn(out, _deleted(id_col, text_col, copy_col, p)).drop("_t")


def _deleted(id_col: str, text_col: str, copy_col: str, p: float) -> Column:
    kept = with_prefix([F.col(id_col), F.col(copy_col), "del"],
                       lambda prefix: F.filter(F.col("_t"), lambda x, i: above_after(float(p), prefix, i)))
    pick = F.array(F.element_at(
        "_t", (hash32(F.col(id_col), F.col(copy_col), "delpick")
                % F.greatest(F.size("_t"), F.lit(1))).cast("int") + 1))
    # the draws are made once, though their result is named twice
    made = F.transform(F.array(kept), lambda k: F.array_join(F.when(F.size(k) == 0, pick).otherwise(k), " "))
    return F.when(F.size("_t") <= 1, F.col(text_col)).otherwise(F.get(made, F.lit(0)))


def random_swap(df: DataFrame, id_col: str, text_col: str, copy_col: str,
                out: str = "aug_text", n: int = 1) -> DataFrame:
    """N times, swap one pair of distinct positions; < 2 tokens unchanged."""
    return _swapped(with_tokens(df, text_col), id_col, text_col, copy_col, out, n).drop("_t")


def _swapped(df: DataFrame, id_col: str, text_col: str, copy_col: str, out: str, n: int = 1) -> DataFrame:
    t = df.withColumn("_w", F.col("_t")).withColumn("_n", F.size("_t"))
    # divisors are guarded so texts of 0/1 tokens never divide by zero (ANSI)
    n1 = F.greatest(F.col("_n"), F.lit(1))
    for turn in range(n):
        draw = [turn] if turn else []
        i = hash32(F.col(id_col), F.col(copy_col), "swap1", *draw) % n1
        j = (i + 1 + hash32(F.col(id_col), F.col(copy_col), "swap2", *draw) % F.greatest(F.col("_n") - 1, F.lit(1))) % n1
        t = t.withColumn("_i", i.cast("int")).withColumn("_j", j.cast("int"))
        t = t.withColumn("_w", F.transform("_w", lambda x, k: F.when(k == F.col("_i"), F.get("_w", F.col("_j")))
                                           .when(k == F.col("_j"), F.get("_w", F.col("_i"))).otherwise(x)))
    res = F.when(F.col("_n") < 2, F.col(text_col)).otherwise(F.array_join("_w", " "))
    return t.withColumn(out, res).drop("_w", "_n", "_i", "_j")


def synonym_replacement(df: DataFrame, id_col: str, text_col: str, copy_col: str,
                        synonyms: DataFrame, out: str = "aug_text", n: int = 1) -> DataFrame:
    """Among the text's distinct alphanumeric tokens, in hash order, the
    first n with a synonym are replaced everywhere by one of their synonyms
    (hash-chosen). A synonym keeps its letters, digits and blanks only, and
    never is the word itself. Without any candidate the tokens are re-joined.
    The synonyms and the choices are written before their joins, so that
    their real size decides: while they are short, no token and no text is
    shuffled. For one synonym, the first ``FIRST_WORDS`` words of a text are
    looked up, and the others only where none of those has one."""
    return _replaced(with_tokens(df, text_col), id_col, text_col, copy_col, synonyms, out, n).drop("_t")


def _replaced(t: DataFrame, id_col: str, text_col: str, copy_col: str, synonyms: DataFrame, out: str, n: int = 1) -> DataFrame:
    work = Scratch(t.sparkSession, "synonyms")
    clean = F.trim(F.regexp_replace("synonym", r"[^\p{L}\p{N} ]", ""))
    syn = work.write(synonyms.select("word", clean.alias("synonym")).where("synonym <> '' AND synonym <> word")
                     .where(F.col("word").rlike(r"^[\p{L}\p{N}]+$")).groupBy("word").agg(F.array_sort(F.collect_set("synonym")).alias("_syns")), "words")
    keys, pick = [id_col, copy_col], F.get("_syns", (hash32(F.col(id_col), F.col(copy_col), "synpick") % F.size("_syns")).cast("int"))

    def draw(word: Column) -> Column:
        return hash_digits(F.col(id_col), F.col(copy_col), "synword", word).alias("h")

    def choices(rows: DataFrame) -> DataFrame:
        cands = rows.select(*keys, F.explode(F.array_distinct("_t")).alias("word")).join(syn, "word")
        return cands.select(*keys, F.struct(draw(F.col("word")), "word", pick.alias("to")).alias("c")).groupBy(*keys) \
            .agg((F.array(F.min("c")) if n == 1 else F.slice(F.array_sort(F.collect_list("c")), 1, n)).alias("_c"))

    if n == 1:
        # the first words in hash order are looked up; only texts without a synonym among them send all their words
        words = F.filter(F.array_distinct("_t"), lambda w: w.rlike(r"^[\p{L}\p{N}]+$"))
        drawn = t.select(*keys, F.sort_array(with_prefix([F.col(id_col), F.col(copy_col), "synword"], lambda prefix: F.transform(
            words, lambda w: F.struct(digits_after(prefix, w).alias("h"), w.alias("word"))))).alias("w"))
        seen = drawn.select(*keys, F.when(F.size("w") > FIRST_WORDS, F.get("w", F.lit(FIRST_WORDS - 1))["h"]).alias("last"),
                            F.explode(F.slice("w", 1, FIRST_WORDS)).alias("w")).select(*keys, "last", "w.h", "w.word")
        best = seen.join(syn, "word", "left").groupBy(*keys).agg(
            F.min("last").alias("last"), F.min(F.when(F.col("_syns").isNotNull(), F.struct("h", "word", pick.alias("to")))).alias("c"))
        best = work.write(best, "first")
        settled = F.col("c").isNotNull() & (F.col("last").isNull() | (F.col("c.h") <= F.col("last")))
        choice = best.where(settled).select(*keys, F.array("c").alias("_c"))
        late = work.write(best.where(~settled & F.col("last").isNotNull()).select(*keys), "late")
        if not late.isEmpty():
            choice = choice.unionByName(choices(t.join(late, keys, "left_semi")))
    else:
        choice = choices(t)
    choice = work.write(choice, "choice")
    # tokens are made again rather than shuffled with their text
    j = with_tokens(t.drop(TOKENS).join(choice, keys, "left"), text_col)
    chosen = F.map_from_arrays(F.transform("_c", lambda c: c["word"]), F.transform("_c", lambda c: c["to"]))
    res = F.array_join(F.when(F.col("_m").isNull(), F.col("_t")).otherwise(
        F.transform("_t", lambda x: F.coalesce(F.try_element_at("_m", x), x))), " ")
    return j.withColumn("_m", chosen).withColumn(out, res).drop("_c", "_m")


def augment(df: DataFrame, id_col: str, text_col: str, techniques=TECHNIQUES,
            multiplier: int = 1, synonyms: DataFrame | None = None, p: float = 0.1) -> DataFrame:
    """The original row (copy 0, 'original') plus, per copy 1..m and
    per known technique, one variant. Unknown techniques are skipped.
    Output keeps all input columns, plus copy and technique; text replaced. Tokens are made once for all variants, and
    the variants of a text follow each other."""
    known = [t for t in techniques if t in TECHNIQUES and (t != "synonym" or synonyms is not None)]
    columns = [c for c in df.columns if c != TOKENS]
    if not known or multiplier < 1:
        return df.select(*columns, F.lit(0).alias("copy"), F.lit("original").alias("technique"))
    t = with_tokens(df, text_col).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(multiplier))))
    for tech in dict.fromkeys(known):
        if tech == "deletion":
            t = t.withColumn("_v_deletion", _deleted(id_col, text_col, "copy", p))
        elif tech == "swap":
            t = _swapped(t, id_col, text_col, "copy", "_v_swap")
        else:
            t = _replaced(t, id_col, text_col, "copy", synonyms, "_v_synonym")

    def variant(copy, tech: str, text: str) -> Column:
        return F.struct(copy.alias("copy"), F.lit(tech).alias("technique"), F.col(text).alias("text"))

    made = F.array(*[variant(F.col("copy"), tech, f"_v_{tech}") for tech in known])
    made = F.when(F.col("copy") == 1, F.concat(F.array(variant(F.lit(0), "original", text_col)), made)).otherwise(made)
    return t.select(*[c for c in columns if c != text_col], F.explode(made).alias("_v")).select(
        *[F.col("_v.text").alias(text_col) if c == text_col else F.col(c) for c in columns], "_v.copy", "_v.technique")
