"""Registered vocabulary, encoding, sentence-pair, ROUGE, sampling, TF-IDF and
classification-metric queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.functions import text as tx
from kiln.functions.hashing import sql_hash32, sql_unit_hash
from kiln.operators import metrics
from kiln.operators import vocab as vc
from kiln.operators.rouge import rouge_n
from kiln.operators.split import exact_sample, hash_split, pick_k, shuffle_order
from kiln.operators.vectorise import vectorise
from kiln.plans import query
from kiln.sources.tables import load

MIN_FREQ = 2
MAX_LEN = 100
SPLIT_WS = tx.sql_split_ws("text")


def documents(spark, sf_dir):
    return load(spark, sf_dir, "documents", spread=True)


def doc_vocab(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id", tx.split_ws("text").alias("t"))
    return d, vc.build_vocab(d, "doc_id", F.col("t"), min_freq=MIN_FREQ)


SQL_VOCAB = f"""
dt AS (SELECT doc_id, {SPLIT_WS} AS t FROM documents),
dp AS (SELECT doc_id, unnest(t) AS word, generate_subscripts(t, 1) AS pos FROM dt),
st AS (SELECT word, count(*) AS cnt, min(struct_pack(d := doc_id, p := pos)) AS f FROM dp GROUP BY word),
v AS (SELECT word, (row_number() OVER (ORDER BY f.d, f.p) + 1)::BIGINT AS idx, cnt::BIGINT AS cnt
      FROM st WHERE cnt >= {MIN_FREQ})"""

SQL_ENCODE = f"""
e AS (SELECT doc_id, t[1:{MAX_LEN}] AS t FROM dt),
enc AS (
  SELECT p.doc_id, (p.pos - 1)::INTEGER AS pos, coalesce(v.idx, 1)::INTEGER AS token_id
  FROM (SELECT doc_id, unnest(t) AS word, generate_subscripts(t, 1) AS pos FROM e) p
  LEFT JOIN v USING (word)
  UNION ALL
  SELECT doc_id, unnest(range(len(t), {MAX_LEN}))::INTEGER AS pos, 0 AS token_id FROM e)"""


@query("vocab", f"WITH {SQL_VOCAB} SELECT word, idx, cnt FROM v")
def q_vocab(spark, sf_dir):
    return doc_vocab(spark, sf_dir)[1]


@query("encode_pad", f"WITH {SQL_VOCAB}, {SQL_ENCODE} SELECT doc_id, pos, token_id FROM enc")
def q_encode_pad(spark, sf_dir):
    d, v = doc_vocab(spark, sf_dir)
    return vc.encode_padded(d, "doc_id", F.col("t"), v, MAX_LEN)


@query("decode", f"""WITH {SQL_VOCAB}
SELECT dp.doc_id, string_agg(coalesce(v.word, '<unk>'), ' ' ORDER BY dp.pos) AS decoded
FROM dp LEFT JOIN v USING (word) GROUP BY dp.doc_id""")
def q_decode(spark, sf_dir):
    d, v = doc_vocab(spark, sf_dir)
    return vc.decode(vc.encode_padded(d, "doc_id", F.col("t"), v, None), "doc_id", v)


# ------------------------------------------------------------ sentence pairs
def pairs(spark, sf_dir, normalise=True):
    conv = load(spark, sf_dir, "conversations", spread=True)
    u = conv.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("src"))
    a = conv.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("tgt"))
    p = u.join(a, ["conv_id", "turn"])
    if normalise:
        p = p.select("conv_id", "turn", tx.normalize_sentence("src").alias("src"),
                     tx.normalize_sentence("tgt").alias("tgt"))
    return p


SQL_PAIRS_RAW = """
pr AS (SELECT u.conv_id, u.turn, u.text AS src, a.text AS tgt
       FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
       WHERE u.role = 'user' AND a.role = 'assistant')"""
SQL_PAIRS = SQL_PAIRS_RAW + f""",
pn AS (SELECT conv_id, turn, {tx.sql_normalize_sentence('src')} AS src,
              {tx.sql_normalize_sentence('tgt')} AS tgt FROM pr)"""


@query("pair_prepare", f"WITH {SQL_PAIRS} SELECT conv_id, turn, src, tgt FROM pn")
def q_pair_prepare(spark, sf_dir):
    return pairs(spark, sf_dir)


#: Prefixes that occur in the invented prose, next to the published ones.
PAIR_STARTS = (*tx.PAIR_PREFIXES, "the ", "th", "an", "on")
#: The invented turns are long; the published bound is ``tx.PAIR_MAX_LENGTH``.
PAIR_WORDS = 100


def sql_prefix_any(x: str) -> str:
    return "(" + " OR ".join(f"starts_with({x}, {tx.sql_quote(p)})" for p in PAIR_STARTS) + ")"


@query("pair_filter", f"""WITH {SQL_PAIRS}
SELECT conv_id, turn, src, tgt FROM pn
WHERE len(string_split(src, ' ')) < {PAIR_WORDS} AND len(string_split(tgt, ' ')) < {PAIR_WORDS}
  AND {sql_prefix_any('tgt')}""")
def q_pair_filter(spark, sf_dir):
    p = pairs(spark, sf_dir)
    keep = ((F.size(tx.split_space("src")) < PAIR_WORDS) & (F.size(tx.split_space("tgt")) < PAIR_WORDS)
            & tx.starts_with_any("tgt", PAIR_STARTS))
    return p.filter(keep)


@query("encode_eos", f"""WITH {SQL_PAIRS},
sp AS (SELECT conv_id, turn, string_split(src, ' ') AS t FROM pn),
spp AS (SELECT conv_id, turn, unnest(t) AS word, generate_subscripts(t, 1) AS pos FROM sp),
st AS (SELECT word, min(struct_pack(c := conv_id, t := turn, p := pos)) AS f FROM spp GROUP BY word),
v AS (SELECT word, (row_number() OVER (ORDER BY f.c, f.t, f.p) + 1)::BIGINT AS idx FROM st)
SELECT spp.conv_id, spp.turn, (spp.pos - 1)::INTEGER AS pos, v.idx::INTEGER AS token_id
FROM spp JOIN v USING (word)
UNION ALL SELECT conv_id, turn, len(t)::INTEGER, 1 FROM sp""")
def q_encode_eos(spark, sf_dir):
    p = pairs(spark, sf_dir).select("conv_id", "turn", tx.split_space("src").alias("t"))
    v = vc.build_vocab(p, ["conv_id", "turn"], F.col("t"), min_freq=1, first_id=2)
    return vc.encode_strict_eos(p, ["conv_id", "turn"], F.col("t"), v)


ROUGE_TOK = "list_filter(string_split(trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: w <> '')"
EOS_RE = f"{tx.WS}*<EOS>{tx.WS}*$"


ROUGE_SQL = f"""WITH {SQL_PAIRS_RAW},
tk AS (SELECT conv_id, turn,
          {ROUGE_TOK.format(x=f"regexp_replace(src, '{EOS_RE}', '')")} AS p,
          {ROUGE_TOK.format(x='tgt')} AS r FROM pr),
g AS (
  SELECT conv_id, turn, 1 AS n, unnest(p) AS g, 1 AS side FROM tk
  UNION ALL SELECT conv_id, turn, 1, unnest(r), 2 FROM tk
  UNION ALL SELECT conv_id, turn, 2, unnest(list_transform(range(1, len(p)), lambda i: p[i] || ' ' || p[i + 1])), 1 FROM tk
  UNION ALL SELECT conv_id, turn, 2, unnest(list_transform(range(1, len(r)), lambda i: r[i] || ' ' || r[i + 1])), 2 FROM tk),
c AS (SELECT conv_id, turn, n, g, sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS cp,
             sum(CASE WHEN side = 2 THEN 1 ELSE 0 END) AS cr FROM g GROUP BY ALL),
o AS (SELECT conv_id, turn, sum(CASE WHEN n = 1 THEN least(cp, cr) ELSE 0 END) AS o1,
             sum(CASE WHEN n = 2 THEN least(cp, cr) ELSE 0 END) AS o2 FROM c GROUP BY ALL),
b AS (SELECT tk.conv_id, tk.turn, coalesce(o.o1, 0)::DOUBLE AS o1, coalesce(o.o2, 0)::DOUBLE AS o2,
             len(p) AS np1, len(r) AS nr1, greatest(len(p) - 1, 0) AS np2, greatest(len(r) - 1, 0) AS nr2
      FROM tk LEFT JOIN o USING (conv_id, turn)),
s AS (SELECT conv_id, turn,
        CASE WHEN np1 > 0 THEN o1 / np1 ELSE 0.0 END AS r1_precision,
        CASE WHEN nr1 > 0 THEN o1 / nr1 ELSE 0.0 END AS r1_recall,
        CASE WHEN np2 > 0 THEN o2 / np2 ELSE 0.0 END AS r2_precision,
        CASE WHEN nr2 > 0 THEN o2 / nr2 ELSE 0.0 END AS r2_recall FROM b)
SELECT *, CASE WHEN r1_precision + r1_recall > 0
               THEN 2 * r1_precision * r1_recall / (r1_precision + r1_recall) ELSE 0.0 END AS r1_fmeasure,
          CASE WHEN r2_precision + r2_recall > 0
               THEN 2 * r2_precision * r2_recall / (r2_precision + r2_recall) ELSE 0.0 END AS r2_fmeasure
FROM s"""


@query("rouge", ROUGE_SQL)
def q_rouge(spark, sf_dir):
    return rouge_n(pairs(spark, sf_dir, normalise=False), ["conv_id", "turn"], "src", "tgt")


_ROUGE = ("r1_precision", "r1_recall", "r1_fmeasure", "r2_precision", "r2_recall", "r2_fmeasure")


@query("rouge_mean", "SELECT " + ", ".join(f"round(avg({c}), 6) AS {c}" for c in _ROUGE) + f" FROM ({ROUGE_SQL})")
def q_rouge_mean(spark, sf_dir):
    """A17 as reported: the mean over all pairs."""
    return q_rouge(spark, sf_dir).agg(*[F.round(F.avg(c), 6).alias(c) for c in _ROUGE])


# ------------------------------------------------------------ samples
@query("subset_exact", f"""
SELECT doc_id FROM (
  SELECT doc_id, row_number() OVER (ORDER BY h, doc_id) AS rn, count(*) OVER () AS n
  FROM (SELECT doc_id, {sql_hash32('doc_id', "'42'", "'sample'")} AS h FROM documents))
WHERE rn <= floor(n * 0.1::DOUBLE)""")
def q_subset_exact(spark, sf_dir):
    return exact_sample(load(spark, sf_dir, "documents").select("doc_id"), "doc_id", 0.1, 42)


@query("sample_k", f"""
SELECT doc_id FROM (SELECT doc_id, {sql_hash32('doc_id', "'42'", "'pick'")} AS h FROM documents) ORDER BY h, doc_id LIMIT 50""")
def q_sample_k(spark, sf_dir):
    """50 documents drawn without replacement."""
    return pick_k(load(spark, sf_dir, "documents").select("doc_id"), "doc_id", 50, 42)


@query("shuffle_rows", f"""SELECT doc_id, {sql_hash32('doc_id', "'42'", "'shuffle'")} AS shuffle_key FROM documents""")
def q_shuffle_rows(spark, sf_dir):
    """A reproducible order key."""
    return shuffle_order(load(spark, sf_dir, "documents").select("doc_id"), "doc_id", 42)


@query("hash_split", f"""
SELECT doc_id, CASE WHEN {sql_unit_hash('doc_id', "'42'", "'holdout'")} < 0.2::DOUBLE
                    THEN 'test' ELSE 'train' END AS split FROM documents""")
def q_hash_split(spark, sf_dir):
    return hash_split(load(spark, sf_dir, "documents").select("doc_id"), "doc_id", 0.2, 42)


# ------------------------------------------------------------ TF-IDF / top terms
SK_TOK = f"regexp_extract_all(lower(text), '{tx.SK_TOKEN_RE}', 0)"


@query("tfidf", f"""
WITH t AS (SELECT doc_id, unnest({SK_TOK}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
n AS (SELECT count(*)::DOUBLE AS n FROM documents),
w AS (SELECT doc_id, term, tf * (ln((1 + n.n) / (1 + df.df)) + 1) AS w FROM tf JOIN df USING (term) CROSS JOIN n)
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""")
def q_tfidf(spark, sf_dir):
    v = vectorise(documents(spark, sf_dir), "doc_id", "text", weighting="tfidf")
    return v.select("doc_id", "term", F.round("weight", 6).alias("weight"))


SQL_GRAMS = f"""
t AS (SELECT doc_id, list_filter({SK_TOK}, lambda x: NOT list_contains({tx.sql_string_list(tx.ENGLISH_STOPWORDS)}, x)) AS t
      FROM documents),
g AS (SELECT doc_id, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term FROM t),
tf AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY ALL)"""


@query("tfidf_ngrams", f"""WITH {SQL_GRAMS},
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
n AS (SELECT count(*)::DOUBLE AS n FROM documents),
w AS (SELECT doc_id, term, tf * (ln((1 + n.n) / (1 + df.df)) + 1) AS w FROM tf JOIN df USING (term) CROSS JOIN n)
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""")
def q_tfidf_ngrams(spark, sf_dir):
    """T16 as the reference sets it up: (1, 2)-grams without English stop words."""
    v = vectorise(documents(spark, sf_dir), "doc_id", "text", 1, 2, tx.ENGLISH_STOPWORDS, weighting="tfidf")
    return v.select("doc_id", "term", F.round("weight", 6).alias("weight"))


@query("count_vector", f"""WITH {SQL_GRAMS},
top AS (SELECT term FROM tf GROUP BY term ORDER BY sum(tf) DESC, term LIMIT 2000)
SELECT doc_id, term, tf AS count FROM tf JOIN top USING (term)""")
def q_count_vector(spark, sf_dir):
    """T15 with a limit on features."""
    return vectorise(documents(spark, sf_dir), "doc_id", "text", 1, 2, tx.ENGLISH_STOPWORDS, max_features=2000)


@query("top_terms", f"""
SELECT term, count(*) AS cnt FROM (SELECT unnest({SK_TOK}) AS term FROM documents)
GROUP BY term ORDER BY cnt DESC, term LIMIT 100""")
def q_top_terms(spark, sf_dir):
    d = documents(spark, sf_dir)
    return (d.select(F.explode(tx.sk_tokenize("text")).alias("term"))
            .groupBy("term").agg(F.count(F.lit(1)).alias("cnt"))
            .orderBy(F.desc("cnt"), "term").limit(100))


# ------------------------------------------------------------ classification metrics
LONG_DOC = 2000


def quality_predictions(spark, sf_dir):
    lab = load(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    docs = load(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return lab.join(docs, "doc_id").select(
        "label", F.when(F.col("n_chars") >= LONG_DOC, 1).otherwise(0).alias("prediction"))


SQL_PRED = f"""
pr AS (SELECT l.quality AS label, CASE WHEN d.n_chars >= {LONG_DOC} THEN 1 ELSE 0 END AS prediction
       FROM labels l JOIN documents d USING (doc_id)),
cm AS (SELECT label, prediction, count(*) AS n FROM pr GROUP BY ALL),
cls AS (SELECT label AS c FROM cm UNION SELECT prediction FROM cm),
pc AS (SELECT c,
         coalesce((SELECT sum(n) FROM cm WHERE label = c AND prediction = c), 0) AS tp,
         coalesce((SELECT sum(n) FROM cm WHERE label = c), 0) AS support,
         coalesce((SELECT sum(n) FROM cm WHERE prediction = c), 0) AS predicted FROM cls),
pm AS (SELECT c, tp, support,
         CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
         CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM pc),
pf AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                      ELSE 0.0 END AS f1 FROM pm)"""


@query("confusion", f"WITH {SQL_PRED} SELECT label, prediction, n FROM cm")
def q_confusion(spark, sf_dir):
    return metrics.confusion(quality_predictions(spark, sf_dir))


@query("confusion_matrix", f"""WITH {SQL_PRED}
SELECT label, coalesce(sum(n) FILTER (WHERE prediction = 0), 0)::BIGINT AS "0",
       coalesce(sum(n) FILTER (WHERE prediction = 1), 0)::BIGINT AS "1" FROM cm GROUP BY label""")
def q_confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(quality_predictions(spark, sf_dir), [0, 1])


@query("class_report", f"""WITH {SQL_PRED}
SELECT c::VARCHAR AS cls, precision, recall, f1, support::BIGINT AS support FROM pf
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::BIGINT FROM pf
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                 sum(f1 * support) / sum(support), sum(support)::BIGINT FROM pf""")
def q_class_report(spark, sf_dir):
    return metrics.class_report(quality_predictions(spark, sf_dir))


@query("accuracy_weighted", f"""WITH {SQL_PRED}
SELECT sum(tp) / sum(support) AS accuracy, sum(precision * support) / sum(support) AS precision,
       sum(recall * support) / sum(support) AS recall, sum(f1 * support) / sum(support) AS f1 FROM pf""")
def q_accuracy_weighted(spark, sf_dir):
    return metrics.accuracy_weighted(quality_predictions(spark, sf_dir))
