"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWER.format(x="text") + r", '[^\x20\x09-\x0D]+')"
_GRAMS = "unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' ')))"

#: Escaping adds one backslash for each control string of a text.
CHAT_FORMAT = r"""
WITH src AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(4 + length(role) + 1 + length(text) + len(regexp_extract_all(text, '### |</turn>')) + 9)::BIGINT AS formatted_chars
FROM src GROUP BY conv_id"""

#: Minimal runs of at least 25 characters that start or end at each line; the first copy of each stays.
LINE_DEDUP = r"""
WITH ln AS (
  SELECT doc_id, generate_subscripts(ls, 1) - 1 AS n, unnest(ls) AS raw FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
tl AS (SELECT doc_id, n, trim(raw, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS t FROM ln),
li AS (SELECT doc_id, n, t, row_number() OVER w AS i, sum(length(t)) OVER w AS s FROM tl WHERE t <> ''
       WINDOW w AS (PARTITION BY doc_id ORDER BY n)),
sp AS (SELECT a.doc_id, a.i, min(b.i) AS j FROM li a JOIN li b ON b.doc_id = a.doc_id AND b.i BETWEEN a.i AND a.i + 24
       WHERE b.s - a.s + length(a.t) >= 25 GROUP BY ALL
       UNION SELECT b.doc_id, max(a.i), b.i FROM li a JOIN li b ON b.doc_id = a.doc_id AND b.i BETWEEN a.i AND a.i + 24
       WHERE b.s - a.s + length(a.t) >= 25 GROUP BY b.doc_id, b.i),
rn AS (SELECT sp.doc_id, min(li.n) AS f, max(li.n) AS l, string_agg(li.t, chr(10) ORDER BY li.i) AS k
       FROM sp JOIN li ON li.doc_id = sp.doc_id AND li.i BETWEEN sp.i AND sp.j GROUP BY sp.doc_id, sp.i, sp.j),
og AS (SELECT k, min(struct_pack(d := doc_id, f := f)) AS o FROM rn GROUP BY k),
gone AS (SELECT DISTINCT rn.doc_id, unnest(range(rn.f, rn.l + 1)) AS n FROM rn JOIN og USING (k)
         WHERE rn.doc_id > og.o.d OR (rn.doc_id = og.o.d AND rn.f > og.o.f))
SELECT ln.doc_id, count(*) AS n_lines, count(gone.n) AS n_deleted,
       coalesce(string_agg(ln.raw, chr(10) ORDER BY ln.n) FILTER (WHERE gone.n IS NULL), '') AS text
FROM ln LEFT JOIN gone ON gone.doc_id = ln.doc_id AND gone.n = ln.n GROUP BY ln.doc_id"""

EMBEDDING_NEAR_DUP = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm
                     FROM embeddings),
ed AS (SELECT a.vec_id AS s, b.vec_id AS d FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
       WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93),
reach(src, dst) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.src, ed.d FROM reach r JOIN ed ON ed.s = r.dst),
n AS (SELECT s, count(*) AS n FROM ed GROUP BY s)
SELECT src AS vec_id, coalesce(any_value(n.n), 0)::BIGINT AS n_links, min(dst) AS component_id, src = min(dst) AS kept
FROM reach LEFT JOIN n ON n.s = src GROUP BY src"""

MINHASH_NEAR_DUP = f"""
WITH RECURSIVE sp AS (SELECT doc_id, {_WORDS} AS w FROM documents),
gr AS (SELECT DISTINCT doc_id, {_GRAMS} AS g FROM sp WHERE len(w) > 0),
sz AS (SELECT doc_id, count(*) AS n FROM gr GROUP BY doc_id),
sh AS (SELECT a.doc_id AS s, b.doc_id AS d, count(*) AS c FROM gr a JOIN gr b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
ed AS (SELECT s, d FROM sh JOIN sz x ON x.doc_id = s JOIN sz y ON y.doc_id = d WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach(src, dst) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.src, ed.d FROM reach r JOIN ed ON ed.s = r.dst)
SELECT src AS doc_id, coalesce(any_value(sz.n), 0)::BIGINT AS n_shingles, min(dst) AS component_id, src = min(dst) AS kept
FROM reach LEFT JOIN sz ON sz.doc_id = src GROUP BY src"""

#: Exact containment by plain joins of all shingles.
DECONTAMINATE = f"""
WITH words AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
sp AS (SELECT side, id, {_WORDS} AS w FROM words),
gr AS (SELECT DISTINCT side, id, {_GRAMS} AS g FROM sp WHERE len(w) > 0),
items AS (SELECT id, g, count(*) OVER (PARTITION BY id) AS n FROM gr WHERE side = 'b')
SELECT d.id AS doc_id, i.id AS item_id, i.n AS n_item, count(*) AS n_shared
FROM gr d JOIN items i USING (g) WHERE d.side = 'd'
GROUP BY ALL HAVING count(*) * 100 >= i.n * 80"""

RANKED_SEARCH = (r"""
WITH d AS (SELECT doc_id, regexp_extract_all({lower}, '{term}') AS t FROM documents),
s AS (SELECT count(*)::BIGINT AS docs, sum(len(t))::BIGINT AS words FROM d WHERE len(t) > 0),
tf AS (SELECT doc_id, len(t) AS n, term, count(*) AS tf FROM (SELECT doc_id, t, unnest(t) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT item_id, term, count(*) AS reps FROM (SELECT item_id, unnest(regexp_extract_all({lower}, '{term}')) AS term FROM benchmark)
      GROUP BY ALL),
sc AS (
  SELECT item_id, doc_id,
         sum(reps * floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT
             * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // words))))::BIGINT AS score
  FROM q JOIN df USING (term) JOIN tf USING (term) CROSS JOIN s GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM sc WHERE score > 0)
WHERE rank <= 10""".replace("{lower}", _LOWER.format(x="coalesce(text, '')"))
                 .replace("{term}", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))

FILL_IN_MIDDLE = r"""
WITH u AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w,
         sha256('1:' || doc_id::VARCHAR) AS h FROM documents),
c AS (
  SELECT *, len(w) AS n, ('0x' || h[1:8])::BIGINT % (len(w) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(w) + 1) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (
  SELECT doc_id, n, form, text, array_to_string(w[1:least(a, b)], '') AS prefix,
         array_to_string(w[least(a, b) + 1:greatest(a, b)], '') AS middle, array_to_string(w[greatest(a, b) + 1:n], '') AS suffix FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p"""
