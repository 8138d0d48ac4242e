"""Text expressions: cleaning, tokenising, normalising, n-grams.

All regexes are written so that Java (Spark) and RE2 (DuckDB oracle) read
them the same way: explicit Unicode classes instead of ``\\w``/``\\s``/``\\d``,
which are ASCII-only in RE2 and in Java without ``(?U)``.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.isspace() set, i.e. what Python's Unicode ``\s`` and
# ``str.split()`` treat as whitespace.
WS_CLASS = r"\t\n\x{0B}\f\r\x{1C}-\x{1F}\x{85}\p{Z}"
WS = f"[{WS_CLASS}]"
NOT_WS = f"[^{WS_CLASS}]"
WORD = r"[\p{L}\p{N}_]"  # Python's Unicode \w
# Python's string.punctuation as a character class (32 ASCII chars).
PUNCT = r"[!-/:-@\[-`{-~]"

# T5: words, or any single char that is neither a word char nor whitespace.
TOKEN_RE = rf"{WORD}+|[^\p{{L}}\p{{N}}_{WS_CLASS}]"
# Scikit-learn's default token pattern, (?u)\b\w\w+\b.
SK_TOKEN_RE = r"[\p{L}\p{N}_]{2,}"
URL_RE = rf"(?:http|www){NOT_WS}+"
TAG_RE = r"<[^\n]*?>"
DIGITS_RE = r"\p{Nd}+"
PUNCT_DIGITS_RE = r"[!-/:-@\[-`{-~\p{Nd}]+"  # one pass: characters are dropped one by one in either

# The English stop-word list of the NLTK corpus (179 words),
# in the corpus' own order. Operators take the list as a parameter; this is
# the default.
ENGLISH_STOPWORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your "
    "yours yourself yourselves he him his himself she she's her hers herself it "
    "it's its itself they them their theirs themselves what which who whom this "
    "that that'll these those am is are was were be been being have has had "
    "having do does did doing a an the and but if or because as until while of "
    "at by for with about against between into through during before after above "
    "below to from up down in out on off over under again further then once here "
    "there when where why how all any both each few more most other some such no "
    "nor not only own same so than too very s t can will just don don't should "
    "should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't "
    "doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn "
    "mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn "
    "wasn't weren weren't won won't wouldn wouldn't"
).split()

# English target prefixes and the length bound of the
# sentence-pair filter (P10). The bound is compared with ``<``.
PAIR_PREFIXES = (
    "i am", "i m", "he is", "he s", "she is", "she s",
    "you are", "you re", "we are", "we re", "they are", "they re",
)
PAIR_MAX_LENGTH = 15


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _dropped(s: Column, regex: str, *marks: str) -> Column:
    """``s`` without the matches of ``regex``, each of which holds one of the marks: a text without any is only searched for those."""
    def one(x: Column) -> Column:
        found = F.lit(False)
        for m in marks:
            found = found | x.contains(m)
        return F.when(found, F.regexp_replace(x, regex, "")).otherwise(x)

    return F.get(F.transform(F.array(s), one), F.lit(0))


def clean_text(c) -> Column:
    """Lower, drop URLs, tags, punctuation and digits, squeeze spaces."""
    s = _dropped(F.lower(_c(c)), URL_RE, "http", "www")
    s = _dropped(s, TAG_RE, "<")
    s = F.regexp_replace(s, PUNCT_DIGITS_RE, "")
    s = F.regexp_replace(s, f"{WS}+", " ")
    return F.trim(s)


def tokenize(c) -> Column:
    """T5: words and single punctuation marks, in text order."""
    return F.regexp_extract_all(_c(c), F.lit(TOKEN_RE), 0)


def sk_tokenize(c, lowercase: bool = True) -> Column:
    """T15 tokens: runs of two or more word characters."""
    s = F.lower(_c(c)) if lowercase else _c(c)
    return F.regexp_extract_all(s, F.lit(SK_TOKEN_RE), 0)


def split_ws(c) -> Column:
    """``str.split()``: split on any whitespace run, no empty tokens."""
    stripped = F.regexp_replace(_c(c), f"^{WS}+|{WS}+$", "")
    parts = F.split(stripped, f"{WS}+")
    return F.filter(parts, lambda x: x != F.lit(""))


def split_space(c) -> Column:
    """``str.split(' ')``: single-space split, empty tokens kept."""
    return F.split(_c(c), " ", -1)


def remove_stopwords(tokens: Column, stopwords=ENGLISH_STOPWORDS) -> Column:
    """Drop tokens whose lower case is a stop word (hash-set lookup)."""
    words = list(stopwords)
    return F.filter(tokens, lambda x: ~F.lower(x).isin(words))


def _gram_of(tokens: Column, n: int, sep: str):
    # One-argument lambda: F.transform reads a two-argument one as (x, index).
    return lambda i: F.array_join(F.slice(tokens, i, n), sep)


def ngrams(tokens: Column, n_min: int = 1, n_max: int = 1, sep: str = " ") -> Column:
    """All word n-grams with n in [n_min, n_max], grouped by n, in order."""
    parts = []
    for n in range(n_min, n_max + 1):
        if n == 1:
            parts.append(tokens)
            continue
        grams = F.transform(F.sequence(F.lit(1), F.size(tokens) - F.lit(n - 1)),
                            _gram_of(tokens, n, sep))
        parts.append(F.when(F.size(tokens) >= n, grams)
                     .otherwise(F.array().cast("array<string>")))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


@lru_cache(maxsize=1)
def ascii_fold_table() -> tuple[str, str]:
    """T10 as a translation table, built by rule from ``unicodedata``.

    For every code point whose NFD form with non-spacing marks (category Mn)
    removed is a single character, map to that character; where nothing is
    left, delete it. Returns ``(from_chars, to_chars)`` with deletions at the
    end of ``from_chars`` (``translate`` removes unmatched tail characters).
    """
    src, dst, drop = [], [], []
    for cp in range(0x80, 0x30000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        folded = "".join(x for x in unicodedata.normalize("NFD", ch)
                         if unicodedata.category(x) != "Mn")
        if folded == ch:
            continue
        if len(folded) == 1:
            src.append(ch)
            dst.append(folded)
        elif not folded:
            drop.append(ch)
    return "".join(src + drop), "".join(dst)


def unicode_to_ascii(c) -> Column:
    """T10 on the JVM: NFD, then drop Mn marks, via one ``translate``.

    Exact for every character whose folded form has at most one character.
    Characters that fold to several characters (Hangul syllables, a few
    Indic vowel signs) are kept unchanged; none of them folds to ASCII, so
    ``normalize_sentence`` (which turns all non-ASCII letters into spaces) is
    exact. Use ``unicode_to_ascii_exact`` when the folded form itself matters.
    """
    src, dst = ascii_fold_table()
    return F.translate(_c(c), src, dst)


def unicode_to_ascii_exact(c) -> Column:
    """T10 via an Arrow-batched pandas UDF (the slow path)."""
    @F.pandas_udf("string")
    def _fold(s: pd.Series) -> pd.Series:
        def one(x):
            if x is None:
                return None
            return "".join(ch for ch in unicodedata.normalize("NFD", x)
                           if unicodedata.category(ch) != "Mn")
        return s.map(one)

    return _fold(_c(c))


def normalize_sentence(c) -> Column:
    """Lower, strip, ASCII-fold, space before .!?, others to one space.

    No final trim (the reference keeps the trailing space, so a single-space
    split can yield empty tokens).
    """
    s = F.regexp_replace(F.lower(_c(c)), f"^{WS}+|{WS}+$", "")
    s = unicode_to_ascii(s)
    s = F.regexp_replace(s, r"([.!?])", " $1")
    return F.regexp_replace(s, r"[^a-zA-Z.!?]+", " ")


def starts_with_any(c, prefixes) -> Column:
    cond = F.lit(False)
    for p in prefixes:
        cond = cond | _c(c).startswith(p)
    return cond


# ---------------------------------------------------------------- SQL twins
# DuckDB forms of the same expressions, used by the oracle queries.

def sql_clean_text(x: str) -> str:
    s = f"lower({x})"
    s = f"regexp_replace({s}, '{URL_RE}', '', 'g')"
    s = f"regexp_replace({s}, '{TAG_RE}', '', 'g')"
    s = f"regexp_replace({s}, '{PUNCT}', '', 'g')"
    s = f"regexp_replace({s}, '{DIGITS_RE}', '', 'g')"
    s = f"regexp_replace({s}, '{WS}+', ' ', 'g')"
    return f"trim({s})"


def sql_split_ws(x: str) -> str:
    stripped = f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"
    return f"list_filter(regexp_split_to_array({stripped}, '{WS}+'), lambda t: t <> '')"


def sql_quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_string_list(words) -> str:
    return "[" + ", ".join(sql_quote(w) for w in words) + "]"


def sql_unicode_to_ascii(x: str) -> str:
    src, dst = ascii_fold_table()
    return f"translate({x}, {sql_quote(src)}, {sql_quote(dst)})"


def sql_normalize_sentence(x: str) -> str:
    s = f"regexp_replace(lower({x}), '^{WS}+|{WS}+$', '', 'g')"
    s = sql_unicode_to_ascii(s)
    s = f"regexp_replace({s}, '([.!?])', ' \\1', 'g')"
    return f"regexp_replace({s}, '[^a-zA-Z.!?]+', ' ', 'g')"
