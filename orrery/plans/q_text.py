"""Text queries over ``documents``, ``conversations``, ``customer`` and
``pages`` (SURVEY 2.8, SRC-7, WIN-3, JN-8).  Whole texts are processed;
outputs carry a length and an MD5 digest instead of megabytes of text."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.functions import text as TX
from orrery.functions.constants import ASCII_PUNCTUATION, stopwords
from orrery.operators import textops as TO
from orrery.plans.registry import query
from orrery.session import cut_lineage
from orrery.sources.tables import table


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


NL2 = "chr(10) || chr(13)"
P = q(ASCII_PUNCTUATION)
CLEAN_SQL = f"lower(translate(regexp_replace(translate(text, {NL2}, '  '), '<[^>]+>', '', 'g'), {P}, ''))"
CLEAN_CODED_SQL = f"lower(regexp_replace(translate(translate(text, {NL2}, '  '), {P}, ''), '<[^>]+>', '', 'g'))"


def tokens_sql(expr: str) -> str:
    return f"list_filter(regexp_split_to_array({expr}, '\\s+'), lambda t: t <> '')"


SEQ_TOKENS_SQL = (f"regexp_extract_all(translate(regexp_replace(text, {q(TX.SKIP_RE)}, '', 'g'), '>', ''), "
                  f"{q(TX.SEQ_TOKEN_RE)}, 0)")
STOP_SQL = "[" + ", ".join(q(w) for w in stopwords()) + "]"


def _docs(spark, sf):
    return table(spark, sf, "documents")


# ------------------------------------------------------------------ SRC-7 --

@query("src7_paragraphs", f"""
WITH s AS (SELECT doc_id, source, string_split(text, chr(10) || chr(10)) AS parts FROM documents),
u AS (SELECT doc_id, source, unnest(generate_series(0, len(parts) - 1)) AS para_no, unnest(parts) AS p FROM s),
t AS (SELECT doc_id, source, para_no, trim(p, ' ' || chr(10) || chr(9) || chr(13)) AS p FROM u)
SELECT doc_id, para_no, length(par) AS n_chars, md5(par) AS digest FROM (
  SELECT doc_id, para_no, '<|' || source || '|> ' || p || ' <END>' AS par FROM t WHERE p <> '') x
""")
def src7(spark, sf):
    d = _docs(spark, sf)
    tag = F.concat(F.lit("<|"), F.col("source"), F.lit("|>"))
    p = TO.paragraphs(d, "doc_id", "text", tag)
    return p.select("doc_id", "para_no", F.length("paragraph").cast("long").alias("n_chars"),
                    F.md5("paragraph").alias("digest"))


# -------------------------------------------------------------- STR-1..3 --

@query("str1_clean_text", f"""
SELECT doc_id, length(c) AS n_chars, md5(c) AS digest FROM (SELECT doc_id, {CLEAN_SQL} AS c FROM documents) t
""")
def str1(spark, sf):
    c = _docs(spark, sf).select("doc_id", TX.clean_text("text").alias("c"))
    return c.select("doc_id", F.length("c").cast("long").alias("n_chars"), F.md5("c").alias("digest"))


@query("str1_clean_text_as_coded", f"""
SELECT doc_id, length(c) AS n_chars, md5(c) AS digest FROM (SELECT doc_id, {CLEAN_CODED_SQL} AS c FROM documents) t
""")
def str1b(spark, sf):
    c = _docs(spark, sf).select("doc_id", TX.clean_text("text", as_coded=True).alias("c"))
    return c.select("doc_id", F.length("c").cast("long").alias("n_chars"), F.md5("c").alias("digest"))


@query("str2_tokenize", f"""
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, md5(array_to_string(t, ' ')) AS digest
FROM (SELECT doc_id, {tokens_sql(CLEAN_SQL)} AS t FROM documents) x
""")
def str2(spark, sf):
    t = _docs(spark, sf).select("doc_id", TX.tokenize("text").alias("t"))
    return t.select("doc_id", F.size("t").cast("long").alias("n_tokens"),
                    F.md5(F.array_join("t", " ")).alias("digest"))


@query("str3_sequence_tokenize", f"""
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, md5(array_to_string(t, ' ')) AS digest
FROM (SELECT doc_id, {SEQ_TOKENS_SQL} AS t FROM documents) x
""")
def str3(spark, sf):
    t = _docs(spark, sf).select("doc_id", TX.sequence_tokens("text").alias("t"))
    return t.select("doc_id", F.size("t").cast("long").alias("n_tokens"),
                    F.md5(F.array_join("t", " ")).alias("digest"))


# ------------------------------------------------------------- STR-4..10 --

_EMAIL_USER = "([a-z]+)\\.\\d+@"


@query("str4_find_all", f"""
SELECT doc_id, list_sort(list_distinct(regexp_extract_all(text, {q(_EMAIL_USER)}, 1))) AS mail_users
FROM documents
""")
def str4(spark, sf):
    d = _docs(spark, sf)
    return d.select("doc_id", F.array_sort(TX.find_all("text", _EMAIL_USER, 1)).alias("mail_users"))


_PHONE = "\\(\\d{3}\\) \\d{3}-\\d{4}"
_PHONE_PARTS = "\\((\\d{3})\\) (\\d{3})-(\\d{4})"


@query("str5_phone_normalise", f"""
WITH p AS (SELECT doc_id, regexp_extract_all(text, {q(_PHONE)}, 0) AS ph FROM documents),
d AS (SELECT doc_id, list_transform(ph, lambda x: regexp_replace(x, {q(_PHONE_PARTS)}, '\\1-\\2-\\3')) AS dashed,
             list_transform(ph, lambda x: right(x, 8)) AS short FROM p WHERE len(ph) > 0)
SELECT doc_id,
  list_transform(dashed, lambda x: CASE WHEN len(string_split(x, '-')) = 3
      THEN '(' || string_split(x, '-')[1] || ') ' || string_split(x, '-')[2] || '-' || string_split(x, '-')[3]
      ELSE '' END) AS normalised,
  list_transform(short, lambda x: CASE WHEN len(string_split(x, '-')) = 3
      THEN '(' || string_split(x, '-')[1] || ') ' || string_split(x, '-')[2] || '-' || string_split(x, '-')[3]
      ELSE '' END) AS short_normalised,
  list_transform(dashed, lambda x: '(' || trim(string_split(x, '-')[1]) || ') ' || trim(string_split(x, '-')[2]) || '-'
      || trim(string_split(x, '-')[3])) AS spaced_normalised
FROM d
""")
def str5(spark, sf):
    """Phone numbers found in the texts, rewritten as a-b-c and normalised
    back; the 7-digit tail (two parts) exercises the empty-string rule, the
    form with blanks around the dashes the trimming of the parts."""
    d = _docs(spark, sf).select("doc_id", F.regexp_extract_all("text", F.lit(_PHONE), 0).alias("ph"))
    d = d.filter(F.size("ph") > 0)
    dashed = F.transform("ph", lambda x: F.regexp_replace(x, _PHONE_PARTS, "$1-$2-$3"))
    short = F.transform("ph", lambda x: F.substring(x, -8, 8))
    spaced = F.transform("ph", lambda x: F.regexp_replace(x, _PHONE_PARTS, " $1- $2 - $3 "))
    return d.select("doc_id", F.transform(dashed, TX.normalise_phone).alias("normalised"),
                    F.transform(short, TX.normalise_phone).alias("short_normalised"),
                    F.transform(spaced, TX.normalise_phone).alias("spaced_normalised"))


@query("str6_xor_decode", """
SELECT c_custkey, c_name AS decoded, CAST(2 + 2 * length(c_name) AS BIGINT) AS n_hex FROM customer
""")
def str6(spark, sf):
    """Round trip: names are XOR-obfuscated to hex with a per-row key (first
    byte) and decoded again with the STR-6 expression."""
    c = table(spark, sf, "customer")
    key = (F.pmod(F.col("c_custkey"), F.lit(97)) + 1).cast("int")
    enc = c.select("c_custkey", F.lit(None).alias("_"), "c_name")
    enc = c.select("c_custkey", F.expr("pmod(c_custkey, 97) + 1").cast("int").alias("k"), "c_name")
    enc = enc.select("c_custkey", _encode_per_row("c_name", "k").alias("hex"))
    return enc.select("c_custkey", TX.xor_hex_decode("hex").alias("decoded"),
                      F.length("hex").cast("long").alias("n_hex"))


def _encode_per_row(name: str, key: str):
    s, k = F.col(name), F.col(key)
    body = F.transform(F.sequence(F.lit(1), F.length(s)),
                       lambda i: F.lpad(F.hex(F.ascii(F.substring(s, i, 1)).bitwiseXOR(k)), 2, "0"))
    return F.lower(F.concat(F.lpad(F.hex(k), 2, "0"), F.array_join(body, "")))


_URL_PATH = "^[a-z]+://[^/]+(/.*)$"


@query("str7_url_to_key", f"""
SELECT page_id, translate(regexp_replace(regexp_extract(url, {q(_URL_PATH)}, 1), '^/', ''), '/?=', '___') AS cache_key
FROM pages
""")
def str7(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", TX.url_to_key(F.regexp_extract("url", _URL_PATH, 1)).alias("cache_key"))


@query("str8_label_from_name", """
SELECT page_id, TRY_CAST(regexp_extract(url, 'page=(\\d+)', 1) AS INTEGER) AS label FROM pages
""")
def str8(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", TX.label_from_name("url", "page=(\\d+)").try_cast("int").alias("label"))


@query("str9_window_around_match", """
SELECT doc_id, CAST(instr(text, 'the') AS BIGINT) AS pos, length(w) AS n_chars, md5(w) AS digest FROM (
  SELECT doc_id, text, CASE WHEN instr(text, 'the') > 0 THEN
     substring(text, greatest(1, instr(text, 'the') - 100), instr(text, 'the') + 500 - greatest(1, instr(text, 'the') - 100))
  END AS w FROM documents) t
""")
def str9(spark, sf):
    d = _docs(spark, sf).select("doc_id", "text", TX.window_around("text", "the").alias("w"))
    return d.select("doc_id", F.instr("text", "the").cast("long").alias("pos"),
                    F.length("w").cast("long").alias("n_chars"), F.md5("w").alias("digest"))


@query("str10_delimited_line", """
SELECT c_custkey, concat_ws(', ', c_custkey, c_name, c_nationkey, c_mktsegment) AS line FROM customer
""")
def str10(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", TX.delimited("c_custkey", "c_name", "c_nationkey", "c_mktsegment").alias("line"))


# ------------------------------------------------------------ TXT / JN-8 --

_DOC_TOKENS_SQL = f"(SELECT doc_id, {tokens_sql(CLEAN_SQL)} AS t FROM documents)"
_VOCAB_SQL = f"""
vocab AS (SELECT term, cnt, row_number() OVER (ORDER BY cnt DESC, term) - 1 AS idx FROM (
  SELECT term, count(*) AS cnt FROM (SELECT unnest(t) AS term FROM {_DOC_TOKENS_SQL} d) u
  WHERE NOT list_contains({STOP_SQL}, term) GROUP BY term) c
  ORDER BY cnt DESC, term LIMIT 1000)
"""


def _doc_tokens_nostop(spark, sf):
    d = _docs(spark, sf).select("doc_id", TX.tokenize("text").alias("t"))
    return d.select("doc_id", TO.drop_stopwords("t").alias("t"))


@query("txt1_vocabulary", f"WITH {_VOCAB_SQL} SELECT term, cnt, idx FROM vocab")
def txt1(spark, sf):
    return TO.vocabulary(_doc_tokens_nostop(spark, sf), "t", size=1000)


@query("txt2_bag_of_words", f"""
WITH {_VOCAB_SQL}
SELECT d.doc_id, v.idx, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM {_DOC_TOKENS_SQL} x) d
JOIN vocab v ON d.term = v.term GROUP BY d.doc_id, v.idx
""")
def txt2(spark, sf):
    terms = TO.document_terms(_doc_tokens_nostop(spark, sf), "doc_id", "t")
    return TO.bag_of_words(terms, "doc_id", cut_lineage(TO.vocabulary_of(terms, 1000)))


@query("txt2_binary_bag", f"""
WITH {_VOCAB_SQL}
SELECT DISTINCT d.doc_id, v.idx, CAST(1 AS BIGINT) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM {_DOC_TOKENS_SQL} x) d
JOIN vocab v ON d.term = v.term
""")
def txt2b(spark, sf):
    terms = TO.document_terms(_doc_tokens_nostop(spark, sf), "doc_id", "t")
    return TO.bag_of_words(terms, "doc_id", cut_lineage(TO.vocabulary_of(terms, 1000)), binary=True)


@query("jn8_stopword_vocab_filter", f"""
WITH {_VOCAB_SQL},
u AS (SELECT doc_id, unnest(t) AS term FROM {_DOC_TOKENS_SQL} x)
SELECT d.doc_id, CAST(len(d.t) AS BIGINT) AS n_tokens,
       (SELECT count(*) FROM u WHERE u.doc_id = d.doc_id AND NOT list_contains({STOP_SQL}, u.term)) AS n_non_stop,
       (SELECT count(*) FROM u JOIN vocab v ON u.term = v.term WHERE u.doc_id = d.doc_id) AS n_in_vocab
FROM {_DOC_TOKENS_SQL} d
""")
def jn8(spark, sf):
    """Stop-word exclusion and the in-vocabulary test, on the counts of each
    document's terms: against the fixed list, and against the top V terms (V
    is a parameter, so the broadcast table is bounded)."""
    d = _docs(spark, sf).select("doc_id", TX.tokenize("text").alias("t"))
    terms = TO.document_terms(d, "doc_id", "t").withColumn("kept", ~F.col("term").isin(stopwords()))
    vocab = cut_lineage(TO.vocabulary_of(terms.filter("kept"), 1000)).select("term", F.lit(True).alias("known"))
    known = terms.join(F.broadcast(vocab), "term", "left")  # at most V rows
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    per = known.groupBy("doc_id").agg(F.sum("n").alias("n_tokens"), count(F.col("kept")).alias("n_non_stop"),
                                      count(F.col("known") & F.col("kept")).alias("n_in_vocab"))
    # a document without tokens has no terms
    return _docs(spark, sf).select("doc_id").join(per, "doc_id", "left").fillna(0, ["n_tokens", "n_non_stop", "n_in_vocab"])


_CONV_TOK_SQL = f"(SELECT conv_id, turn, {SEQ_TOKENS_SQL} AS t FROM conversations)"


def _conv_tokens(spark, sf):
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", TX.sequence_tokens("text").alias("t"))


@query("txt3_token_id_sequences", f"""
WITH ct AS {_CONV_TOK_SQL},
u AS (SELECT conv_id, turn, unnest(generate_series(0, len(t) - 1)) AS pos, unnest(t) AS term FROM ct),
vocab AS (SELECT term, row_number() OVER (ORDER BY cnt DESC, term) - 1 AS idx
          FROM (SELECT term, count(*) AS cnt FROM u GROUP BY term) c),
ids AS (SELECT u.conv_id, u.turn, u.pos, v.idx FROM u JOIN vocab v ON u.term = v.term)
SELECT a.conv_id, a.turn, a.pos AS start, list(b.idx ORDER BY b.pos) AS ids
FROM ids a JOIN ids b ON a.conv_id = b.conv_id AND a.turn = b.turn AND b.pos BETWEEN a.pos AND a.pos + 5
GROUP BY a.conv_id, a.turn, a.pos HAVING count(*) = 6
""")
def txt3(spark, sf):
    """Token ids (full vocabulary, count desc then term) and training
    sequences of 5 context ids + 1 label id inside each turn."""
    toks = _conv_tokens(spark, sf)
    vocab = TO.vocabulary(toks, "t")
    return TO.id_sequences(toks, ["conv_id", "turn"], "t", vocab, 5)


@query("win3_token_windows", f"""
WITH ct AS {_CONV_TOK_SQL}
SELECT conv_id, turn, CAST(s - 1 AS BIGINT) AS start, t[s:s + 5] AS window
FROM (SELECT conv_id, turn, t, unnest(generate_series(1, len(t) - 5)) AS s FROM ct WHERE len(t) > 5) x
""")
def win3(spark, sf):
    """Sliding windows of 6 tokens, stride 1, built in-row per turn."""
    toks = _conv_tokens(spark, sf)
    w = toks.select("conv_id", "turn", F.posexplode(TO.token_windows("t", 5)).alias("start", "window"))
    return w.withColumn("start", F.col("start").cast("long"))


@query("txt4_next_token_table", f"""
WITH ct AS {_CONV_TOK_SQL},
w AS (SELECT array_to_string(t[s:s + 4], ' ') AS context, t[s + 5] AS next_token
      FROM (SELECT t, unnest(generate_series(1, len(t) - 5)) AS s FROM ct WHERE len(t) > 5) x),
c AS (SELECT context, next_token, count(*) AS cnt FROM w GROUP BY 1, 2)
SELECT context, next_token, cnt,
       round(pow(cnt, 2.0) / sum(pow(cnt, 2.0)) OVER (PARTITION BY context), 6) AS prob FROM c
""")
def txt4(spark, sf):
    """Count-based next-token table at temperature 0.5."""
    t = TO.next_token_table(_conv_tokens(spark, sf), "t", 5, temperature=0.5)
    return t.withColumn("prob", F.round("prob", 6))
