"""Corpus operators: paragraphs, vocabularies, bags of words, token-id
sequences and next-token tables (SRC-7, TXT-1..4, WIN-3, JN-8).

Scale notes
* Term counts are partial aggregates, so a very frequent term ("the") is
  combined map-side and never lands in one task as raw rows.
* A top-V vocabulary has a parameter-bounded size and is broadcast; a full
  vocabulary is joined without a hint (AQE picks the strategy at run time).
* Global term ids are assigned by a range-partitioned sort plus per-partition
  offsets (a distributed ``zipWithIndex``), never by an unpartitioned window.
* Token windows are built either in-row (the document is already one row)
  or, when ids are needed, by fanning each token out to the N+1 windows it
  belongs to and grouping by (document, start) - groups of at most N+1 rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.functions import text as TX
from orrery.functions.constants import stopwords
from orrery.session import bounded_broadcast, cut_lineage

VOCAB_ROWS = 200_000


def paragraphs(df: DataFrame, doc_id: str, text: str, tag: Column | None = None,
               end_marker: str = "<END>") -> DataFrame:
    """SRC-7: split on blank lines, trim, drop empties, tag with the source
    and close with an end marker.  Returns (doc_id, para_no, paragraph)."""
    ex = df.select(doc_id, *( [tag.alias("_tag")] if tag is not None else []),
                   F.posexplode(F.split(F.col(text), "\n\n")).alias("para_no", "_p"))
    ex = ex.withColumn("_p", F.regexp_replace(F.col("_p"), r"(?U)^\s+|\s+$", "")).filter(F.col("_p") != "")
    parts = ([F.col("_tag"), F.lit(" ")] if tag is not None else []) + [F.col("_p"), F.lit(" " + end_marker)]
    return ex.select(doc_id, F.col("para_no").cast("long").alias("para_no"),
                     F.concat(*parts).alias("paragraph"))


def drop_stopwords(tokens, words: list[str] | None = None) -> Column:
    """JN-8: in-row stop-word removal against a fixed, small list (no join,
    duplicates kept, unlike ``array_except``).  ``isin`` over more than ten
    literals is planned as a hashed ``InSet``, one lookup per token."""
    stop = list(words if words is not None else stopwords())
    col = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.filter(col, lambda t: ~t.isin(stop))


def explode_terms(df: DataFrame, tokens, *keep: str) -> DataFrame:
    """One row per token.  ``explode`` would make Catalyst add a
    ``size(tokens) > 0`` filter that re-evaluates the whole tokenizer
    expression; ``explode_outer`` plus a NULL filter yields the same rows
    with one evaluation (tokens themselves are never NULL)."""
    col = F.col(tokens) if isinstance(tokens, str) else tokens
    return df.select(*keep, F.explode_outer(col).alias("term")).filter(F.col("term").isNotNull())


def term_counts(df: DataFrame, tokens: str) -> DataFrame:
    return explode_terms(df, tokens).groupBy("term").agg(F.count(F.lit(1)).alias("cnt"))


def global_index(df: DataFrame, order: list[Column], out: str = "idx",
                 partitions: int | None = None) -> DataFrame:
    """Dense 0-based position of every row under a total order.

    Range-partition + local sort, then ``monotonically_increasing_id`` gives
    the in-partition position; per-partition counts (one row per partition)
    are turned into offsets and broadcast back.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
           .withColumn("_pid", F.spark_partition_id())
           .withColumn("_mid", F.monotonically_increasing_id()))
    s = s.withColumn("_local", F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33))
    s = cut_lineage(s)  # range bounds are sampled: both readers below need the same sort
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)))
    # one row for each of the ``n`` partitions
    return (s.join(F.broadcast(offs.select("_pid", "_off")), "_pid")
             .withColumn(out, F.col("_off") + F.col("_local"))
             .drop("_pid", "_mid", "_local", "_off"))


def vocabulary(df: DataFrame, tokens: str, size: int | None = None) -> DataFrame:
    """TXT-1: (term, cnt, idx) ordered by count desc then term asc.

    With ``size`` only the top terms are kept (TakeOrderedAndProject, V
    rows); without it every term gets an id via :func:`global_index`.
    """
    return ranked_terms(term_counts(df, tokens), size)


def ranked_terms(cnt: DataFrame, size: int | None = None) -> DataFrame:
    """(term, cnt) with ``idx`` by count desc, then term asc: the top ``size``
    of them, or all."""
    order = [F.desc("cnt"), F.asc("term")]
    if size is not None:
        top = cnt.orderBy(*order).limit(size)
        w = Window.orderBy(*order)  # over at most ``size`` rows
        return top.withColumn("idx", (F.row_number().over(w) - 1).cast("long"))
    return global_index(cnt, order, "idx")


def document_terms(df: DataFrame, doc_id: str, tokens: str) -> DataFrame:
    """(doc_id, term, n): how often each document has each term, written
    once.  Vocabulary and bag both come from this table, so that texts are
    cleaned and split a single time."""
    return cut_lineage(explode_terms(df, tokens, doc_id).groupBy(doc_id, "term").agg(F.count(F.lit(1)).alias("n")))


def vocabulary_of(terms: DataFrame, size: int | None = None) -> DataFrame:
    """TXT-1 from ``document_terms``."""
    return ranked_terms(terms.groupBy("term").agg(F.sum("n").alias("cnt")), size)


def bag_of_words(terms: DataFrame, doc_id: str, vocab: DataFrame, binary: bool = False) -> DataFrame:
    """TXT-2: (doc_id, idx, tf) for the vocabulary terms of every document
    (counts, or 1 when ``binary``), from ``document_terms``.  A vocabulary of
    up to ``VOCAB_ROWS`` terms is broadcast, a larger one joined by a shuffle."""
    j = terms.join(bounded_broadcast(vocab.select("term", "idx"), VOCAB_ROWS), "term")
    return j.select(doc_id, "idx", (F.lit(1).cast("long") if binary else F.col("n")).alias("tf"))


def token_windows(tokens, n: int) -> Column:
    """WIN-3 in-row: every run of n+1 consecutive tokens (stride 1)."""
    col = F.col(tokens) if isinstance(tokens, str) else tokens
    wins = F.transform(F.sequence(F.lit(1), F.size(col) - n),
                       lambda i: F.slice(col, i, n + 1))
    return F.when(F.size(col) > n, wins).otherwise(F.array().cast("array<array<string>>"))


def id_sequences(df: DataFrame, keys: list[str], tokens: str, vocab: DataFrame,
                 n: int) -> DataFrame:
    """TXT-3: windows of n+1 token ids inside each document.

    Tokens are exploded with their position and mapped to ids by an
    equi-join; each id is fanned out to the n+1 windows that contain it and
    the windows are regrouped by (document, start): every group has at most
    n+1 rows however long the document is.
    """
    ex = df.select(*keys, F.posexplode(tokens).alias("pos", "term"))
    ids = ex.join(vocab.select("term", "idx"), "term")
    fan = ids.select(*keys, "pos", "idx", F.explode(F.sequence(F.lit(0), F.lit(n))).alias("off"))
    fan = fan.withColumn("start", F.col("pos") - F.col("off")).filter(F.col("start") >= 0)
    g = fan.groupBy(*keys, "start").agg(
        F.array_sort(F.collect_list(F.struct(F.col("off"), F.col("idx")))).alias("_w"))
    g = g.filter(F.size("_w") == n + 1)
    return g.select(*keys, F.col("start").cast("long").alias("start"),
                    F.transform("_w", lambda s: s["idx"]).alias("ids"))


def next_token_table(df: DataFrame, tokens: str, n: int, temperature: float = 1.0) -> DataFrame:
    """TXT-4: for every n-token context, counts of the following token and
    its sampling probability at a temperature: cnt^(1/T) / sum over the
    context.  The context total is a partial aggregate joined back."""
    w = df.select(F.explode(token_windows(tokens, n)).alias("w"))
    w = w.select(F.array_join(F.slice("w", 1, n), " ").alias("context"),
                 F.element_at("w", n + 1).alias("next_token"))
    cnt = w.groupBy("context", "next_token").agg(F.count(F.lit(1)).alias("cnt"))
    cnt = cnt.withColumn("_s", F.pow(F.col("cnt").cast("double"), 1.0 / temperature))
    tot = cnt.groupBy("context").agg(F.sum("_s").alias("_tot"))
    return (cnt.join(tot, "context")
               .select("context", "next_token", "cnt", (F.col("_s") / F.col("_tot")).alias("prob")))
