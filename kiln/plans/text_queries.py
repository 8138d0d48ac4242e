"""Registered text queries over ``documents`` (W1): split, clean, Naive Bayes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.functions import text as tx
from kiln.functions.hashing import sql_hash32, sql_unit_hash
from kiln.functions.text import sql_clean_text
from kiln.lineage import Scratch
from kiln.operators import augment as aug
from kiln.operators import metrics
from kiln.operators import naive_bayes as nb
from kiln.operators import vocab as vc
from kiln.operators.split import stratified_split
from kiln.operators.vectorise import document_terms
from kiln.plans import query
from kiln.sources.tables import load

SEED = 42
VAL_FRAC = 0.1
ALPHA = 0.1


def split_documents(spark, sf_dir):
    docs = load(spark, sf_dir, "documents", spread=True).select("doc_id", "text", F.col("lang").alias("label"))
    return stratified_split(docs, "label", "doc_id", VAL_FRAC, SEED)


SQL_SPLIT = f"""
d AS (SELECT doc_id, text, lang AS label, {sql_hash32('doc_id', "'42'", "'split'")} AS h
      FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, doc_id) AS rn,
             count(*) OVER (PARTITION BY label) AS n FROM d),
s AS (SELECT doc_id, text, label,
             CASE WHEN rn <= round(n * {VAL_FRAC}::DOUBLE) THEN 'val' ELSE 'train' END AS split FROM r)"""

SQL_OCC = f"""
tok AS (SELECT doc_id, label, split,
               list_filter(string_split({sql_clean_text('text')}, ' '), lambda x: x <> '') AS t
        FROM s),
occ AS (SELECT doc_id, label, split, unnest(list_concat(list_concat(t,
            list_transform(range(1, len(t)), lambda i: array_to_string(t[i:i+1], ' '))),
            list_transform(range(1, len(t) - 1), lambda i: array_to_string(t[i:i+2], ' ')))) AS term
        FROM tok)"""


@query("stratified_split", f"""
WITH {SQL_SPLIT}
SELECT doc_id, label, split FROM s""")
def q_stratified_split(spark, sf_dir):
    return split_documents(spark, sf_dir).select("doc_id", "label", "split")


def nb_predictions(spark, sf_dir):
    s = split_documents(spark, sf_dir)
    train = s.filter(F.col("split") == "train")
    val = s.filter(F.col("split") == "val").drop("split")
    return nb.fit_predict(train, val, "doc_id", "text", "label", ALPHA)


@query("nb_sql", f"""
WITH {SQL_SPLIT}, {SQL_OCC},
model AS (SELECT term, label, count(*) AS ntc FROM occ WHERE split = 'train' GROUP BY ALL),
vs AS (SELECT count(DISTINCT term)::DOUBLE AS v FROM model),
tot AS (SELECT label, sum(ntc)::DOUBLE AS tot FROM model GROUP BY label),
dc AS (SELECT label, count(*)::DOUBLE AS nc FROM s WHERE split = 'train' GROUP BY label),
ntr AS (SELECT count(*)::DOUBLE AS n FROM s WHERE split = 'train'),
val AS (SELECT doc_id, label FROM s WHERE split = 'val'),
vocc AS (SELECT doc_id, term FROM occ WHERE split = 'val' AND term IN (SELECT term FROM model)),
td AS (SELECT doc_id, count(*) AS t FROM vocc GROUP BY doc_id),
sd AS (SELECT vocc.doc_id, m.label, sum(ln((m.ntc + {ALPHA}) / {ALPHA})) AS sc
       FROM vocc JOIN model m USING (term) GROUP BY ALL),
scores AS (
  SELECT val.doc_id, val.label AS truth, dc.label AS cls,
         ln(dc.nc / ntr.n) + coalesce(td.t, 0) * ln({ALPHA} / (coalesce(tot.tot, 0) + {ALPHA} * vs.v))
           + coalesce(sd.sc, 0) AS score
  FROM val CROSS JOIN dc CROSS JOIN ntr CROSS JOIN vs
  LEFT JOIN tot ON tot.label = dc.label
  LEFT JOIN td ON td.doc_id = val.doc_id
  LEFT JOIN sd ON sd.doc_id = val.doc_id AND sd.label = dc.label),
pred AS (SELECT doc_id, truth, first(cls ORDER BY score DESC, cls) AS prediction
         FROM scores GROUP BY doc_id, truth)
SELECT truth AS label, prediction, count(*) AS n FROM pred GROUP BY ALL""")
def q_nb_sql(spark, sf_dir):
    return metrics.confusion(nb_predictions(spark, sf_dir), "label", "prediction")


# ------------------------------------------------------------ cleaning / tokens
TOK = f"regexp_extract_all(text, '{tx.TOKEN_RE}', 0)"
SK_TOK = f"regexp_extract_all(lower(text), '{tx.SK_TOKEN_RE}', 0)"


def documents(spark, sf_dir):
    return load(spark, sf_dir, "documents", spread=True)


@query("clean_text", f"SELECT doc_id, {sql_clean_text('text')} AS clean FROM documents")
def q_clean_text(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", tx.clean_text("text").alias("clean"))


@query("tokenize", f"""
SELECT doc_id, len(t)::BIGINT AS n_tokens, array_to_string(t, ' ') AS tokens
FROM (SELECT doc_id, {TOK} AS t FROM documents)""")
def q_tokenize(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id", tx.tokenize("text").alias("t"))
    return d.select("doc_id", F.size("t").cast("bigint").alias("n_tokens"),
                    F.array_join("t", " ").alias("tokens"))


@query("stopwords", f"""
SELECT doc_id, array_to_string(list_filter({TOK},
         lambda x: NOT list_contains({tx.sql_string_list(tx.ENGLISH_STOPWORDS)}, lower(x))), ' ')
       AS text_nostop
FROM documents""")
def q_stopwords(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id", tx.tokenize("text").alias("t"))
    return d.select("doc_id", F.array_join(tx.remove_stopwords(F.col("t")), " ").alias("text_nostop"))


def lemma_table(tokens_df):
    """(word, lemma): a lower-case word ending in 's' maps to its stem when the
    stem is itself a word of the corpus (a rule-derived lemma table)."""
    words = Scratch(tokens_df.sparkSession, "lemmas").write(
        tokens_df.select(F.explode("t").alias("w")).distinct().filter(F.col("w").rlike(r"^\p{Ll}+$")), "words")
    plural = (words.filter((F.length("w") >= 4) & F.col("w").endswith("s"))
              .withColumn("stem", F.expr("substring(w, 1, length(w) - 1)")))
    return plural.join(words.withColumnRenamed("w", "stem"), "stem") \
        .select(F.col("w").alias("word"), F.col("stem").alias("lemma"))


SQL_TOKENS_CTE = f"tok AS (SELECT doc_id, text, {TOK} AS t FROM documents)"


@query("lemmatize", f"""
WITH {SQL_TOKENS_CTE},
v AS (SELECT DISTINCT unnest(t) AS w FROM tok),
lv AS (SELECT w FROM v WHERE regexp_full_match(w, '\\p{{Ll}}+')),
lem AS (SELECT a.w AS word, b.w AS lemma FROM lv a JOIN lv b ON b.w = left(a.w, length(a.w) - 1)
        WHERE length(a.w) >= 4 AND suffix(a.w, 's')),
pos AS (SELECT doc_id, unnest(t) AS word, generate_subscripts(t, 1) AS p FROM tok),
agg AS (SELECT pos.doc_id, string_agg(coalesce(lem.lemma, pos.word), ' ' ORDER BY pos.p) AS s
        FROM pos LEFT JOIN lem ON lem.word = pos.word GROUP BY pos.doc_id)
SELECT tok.doc_id, coalesce(agg.s, '') AS lemmatized FROM tok LEFT JOIN agg USING (doc_id)""")
def q_lemmatize(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id", tx.tokenize("text").alias("t"))
    lem = lemma_table(d)
    m = vc.map_tokens(d, "doc_id", F.col("t"), lem, "word", "lemma", out="m")
    return m.select("doc_id", F.array_join("m", " ").alias("lemmatized"))


@query("preprocess", f"""
WITH tok AS (SELECT doc_id, list_filter(list_filter(string_split({sql_clean_text('text')}, ' '), lambda x: x <> ''),
               lambda x: NOT list_contains({tx.sql_string_list(tx.ENGLISH_STOPWORDS)}, x)) AS t FROM documents),
v AS (SELECT DISTINCT unnest(t) AS w FROM tok),
lv AS (SELECT w FROM v WHERE regexp_full_match(w, '\\p{{Ll}}+')),
lem AS (SELECT a.w AS word, b.w AS lemma FROM lv a JOIN lv b ON b.w = left(a.w, length(a.w) - 1)
        WHERE length(a.w) >= 4 AND suffix(a.w, 's')),
pos AS (SELECT doc_id, unnest(t) AS word, generate_subscripts(t, 1) AS p FROM tok),
agg AS (SELECT pos.doc_id, string_agg(coalesce(lem.lemma, pos.word), ' ' ORDER BY pos.p) AS s
        FROM pos LEFT JOIN lem ON lem.word = pos.word GROUP BY pos.doc_id)
SELECT tok.doc_id, coalesce(agg.s, '') AS processed FROM tok LEFT JOIN agg USING (doc_id)""")
def q_preprocess(spark, sf_dir):
    """T4 with both switches on."""
    d = documents(spark, sf_dir)
    return vc.preprocess(d.select("doc_id", "text"), "doc_id", "text", tx.ENGLISH_STOPWORDS, lemma_table, out="processed") \
        .select("doc_id", "processed")


@query("ngrams", f"""
WITH t AS (SELECT doc_id, {SK_TOK} AS t FROM documents),
g AS (SELECT doc_id, 1 AS n, unnest(t) AS gram FROM t
      UNION ALL
      SELECT doc_id, 2 AS n, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) FROM t),
dg AS (SELECT doc_id, n, gram, count(*) AS c FROM g GROUP BY ALL)
SELECT n, gram, count(*) AS doc_freq, sum(c)::BIGINT AS term_freq FROM dg GROUP BY n, gram""")
def q_ngrams(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id", tx.sk_tokenize("text").alias("t"))
    per_doc = document_terms(d, "doc_id", F.col("t"), 1, 2).select("n", F.col("term").alias("gram"), F.col("count").alias("c"))
    return (per_doc.groupBy("n", "gram")
            .agg(F.count(F.lit(1)).alias("doc_freq"), F.sum("c").cast("bigint").alias("term_freq")))


# ------------------------------------------------------------ augmentation
def _h(*parts):
    return sql_hash32(*parts)


def sql_deletion(src: str, copy: int, p: float = 0.1) -> str:
    return f"""(SELECT doc_id, CASE WHEN len(t) <= 1 THEN text
        WHEN len(kept) = 0 THEN t[({_h('doc_id', str(copy), "'delpick'")} % len(t)) + 1]
        ELSE array_to_string(kept, ' ') END AS aug_text
      FROM (SELECT doc_id, text, t, list_filter(t, lambda x, i:
              {sql_unit_hash('doc_id', str(copy), "'del'", 'i - 1')} > {p}) AS kept FROM {src}))"""


def sql_swap(src: str, copy: int) -> str:
    return f"""(SELECT doc_id, CASE WHEN n < 2 THEN text ELSE array_to_string(list_transform(t, lambda x, k:
            CASE WHEN k - 1 = i0 THEN t[j0 + 1] WHEN k - 1 = j0 THEN t[i0 + 1] ELSE x END), ' ') END AS aug_text
      FROM (SELECT *, CASE WHEN n < 2 THEN 0 ELSE
                 (i0 + 1 + {_h('doc_id', str(copy), "'swap2'")} % (n - 1)) % n END AS j0
            FROM (SELECT doc_id, text, t, len(t) AS n,
                    CASE WHEN len(t) < 2 THEN 0 ELSE {_h('doc_id', str(copy), "'swap1'")} % len(t) END AS i0
                  FROM {src})))"""


SQL_SYNONYMS = """
v AS (SELECT DISTINCT unnest(t) AS word FROM tok),
lv AS (SELECT word FROM v WHERE regexp_full_match(word, '\\p{Ll}+') AND length(word) >= 5),
nb AS (SELECT word, lag(word) OVER w AS a, lead(word) OVER w AS b FROM lv
       WINDOW w AS (PARTITION BY left(word, 5) ORDER BY word)),
syn AS (SELECT word, list_sort(list_distinct(list(s))) AS syns FROM (
          SELECT word, a AS s FROM nb WHERE a IS NOT NULL
          UNION ALL SELECT word, b FROM nb WHERE b IS NOT NULL) GROUP BY word)"""


def sql_synonym(src: str, copy: int) -> str:
    return f"""(SELECT s.doc_id, array_to_string(list_transform(s.t, lambda x:
              CASE WHEN x = c.w THEN c.s ELSE x END), ' ') AS aug_text
      FROM {src} s LEFT JOIN (
        SELECT doc_id, w, syns[({_h('doc_id', str(copy), "'synpick'")} % len(syns)) + 1] AS s FROM (
          SELECT doc_id, first(word ORDER BY h, word) AS w, first(syns ORDER BY h, word) AS syns FROM (
            SELECT cd.doc_id, cd.word, syn.syns, {_h('cd.doc_id', str(copy), "'synword'", 'cd.word')} AS h
            FROM (SELECT DISTINCT doc_id, unnest(t) AS word FROM {src}) cd JOIN syn USING (word)
            WHERE regexp_full_match(cd.word, '[\\p{{L}}\\p{{N}}]+'))
          GROUP BY doc_id)) c USING (doc_id))"""


def synonym_table(words: DataFrame, word_col: str = "word", prefix_len: int = 5) -> DataFrame:
    """Fixture: a (word, synonym) table derived from a vocabulary by a rule: among
    alphabetic lower-case words of length >= prefix_len sharing their first
    ``prefix_len`` letters, each word's neighbours in sorted order are its
    synonyms (at most two per word; never all pairs of a group)."""
    w = (words.select(F.col(word_col).alias("word")).distinct()
         .filter(F.col("word").rlike(r"^\p{Ll}+$") & (F.length("word") >= prefix_len))
         .withColumn("_g", F.substring("word", 1, prefix_len)))
    o = Window.partitionBy("_g").orderBy("word")
    n = w.select("word", F.lag("word").over(o).alias("a"), F.lead("word").over(o).alias("b"))
    return (n.select("word", F.explode(F.array("a", "b")).alias("synonym"))
            .filter(F.col("synonym").isNotNull()))


def _aug_base(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", "text").withColumn("copy", F.lit(1))


def _synonyms_from(df):
    return synonym_table(df.select(F.explode(tx.tokenize("text")).alias("word")))


@query("aug_deletion", f"WITH {SQL_TOKENS_CTE} SELECT * FROM {sql_deletion('tok', 1)}")
def q_aug_deletion(spark, sf_dir):
    return aug.random_deletion(_aug_base(spark, sf_dir), "doc_id", "text", "copy").select("doc_id", "aug_text")


@query("aug_swap", f"WITH {SQL_TOKENS_CTE} SELECT * FROM {sql_swap('tok', 1)}")
def q_aug_swap(spark, sf_dir):
    return aug.random_swap(_aug_base(spark, sf_dir), "doc_id", "text", "copy").select("doc_id", "aug_text")


@query("aug_synonym", f"WITH {SQL_TOKENS_CTE}, {SQL_SYNONYMS} SELECT * FROM {sql_synonym('tok', 1)}")
def q_aug_synonym(spark, sf_dir):
    base = _aug_base(spark, sf_dir)
    syn = _synonyms_from(base)
    return aug.synonym_replacement(base, "doc_id", "text", "copy", syn).select("doc_id", "aug_text")


@query("aug_union", f"""
WITH {SQL_SPLIT},
tok AS (SELECT doc_id, text, label, {TOK} AS t FROM s WHERE split = 'train'),
{SQL_SYNONYMS.replace('FROM tok', 'FROM (SELECT {TOK} AS t FROM documents)'.replace('{TOK}', TOK), 1)}
SELECT doc_id, 0 AS copy, 'original' AS technique, text, label FROM tok
UNION ALL SELECT doc_id, 1, 'synonym', aug_text, label FROM {sql_synonym('tok', 1)} JOIN tok USING (doc_id)
UNION ALL SELECT doc_id, 1, 'deletion', aug_text, label FROM {sql_deletion('tok', 1)} JOIN tok USING (doc_id)
UNION ALL SELECT doc_id, 1, 'swap', aug_text, label FROM {sql_swap('tok', 1)} JOIN tok USING (doc_id)""")
def q_aug_union(spark, sf_dir):
    # the four output branches read one written copy of the tokenised train split
    s = split_documents(spark, sf_dir)
    train = Scratch(spark, "aug-union").write(
        s.filter(F.col("split") == "train").select("doc_id", "text", "label").withColumn(aug.TOKENS, tx.tokenize("text")), "train")
    syn = _synonyms_from(documents(spark, sf_dir))
    out = aug.augment(train, "doc_id", "text", aug.TECHNIQUES, 1, syn)
    return out.select("doc_id", "copy", "technique", "text", "label")
