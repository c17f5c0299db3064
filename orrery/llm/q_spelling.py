"""op12: spelling variants of the words of whole documents, with its SQL."""

from __future__ import annotations

from orrery.llm import spelling
from orrery.llm.base import query, table

#: unsigned CRC-32 (reversed polynomial 0xEDB88320) of a string's UTF-8 bytes, in DuckDB
CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, strlen({0}) + 1), lambda i:
    CAST('0x' || substr(hex({0}), CAST(2 * i - 1 AS INT), 2) AS BIGINT))), lambda acc, byte:
    list_reduce(list_prepend(xor(acc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, zero:
      xor(x >> 1, (x & 1) * 3988292384::BIGINT))), 4294967295::BIGINT)"""


@query("op12_spelling_variants", f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[A-Za-zÀ-ÿ]+')) AS w FROM documents),
-- a shorter run gives no word
counted AS (SELECT id, w, id || ':' || w AS s, count(*) AS c FROM runs WHERE length(w) >= 7 GROUP BY id, w),
hashed AS (SELECT w, c, {CRC32.format('s')} AS h FROM counted),
v AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word,
         CAST(sum(c) AS BIGINT) AS n FROM hashed GROUP BY 1 HAVING length(word) >= 7 AND sum(c) >= 2),
cut AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
del AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM cut),
pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM del a JOIN del b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM del a JOIN v b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM del a JOIN v b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, min({{'m': -near_n, 'near': near}}) AS b FROM pairs GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.m >= 10 * n THEN b.near END AS form,
             CASE WHEN -b.m >= 10 * n THEN -b.m END AS form_n FROM v LEFT JOIN best ON best.word = v.word),
chain AS (
  SELECT word, coalesce(form, word) AS root, form IS NULL AS done FROM f
  UNION ALL SELECT c.word, coalesce(f.form, c.root), f.form IS NULL FROM chain c JOIN f ON f.word = c.root WHERE NOT c.done)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM f JOIN chain c ON c.word = f.word AND c.done
""")
def op12_spelling_variants(spark, sf):
    words = spelling.vocabulary(table(spark, sf, "documents").select("doc_id", "text"), min_length=7, min_count=2, damage=31)
    return spelling.variants(words, ratio=10).select("word", "form", "root", "n", "n_near", "form_n")
