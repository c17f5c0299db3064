"""Mixing sources to target weights by Pareto order sampling (native).

Every document of a source is to appear ``e`` times on average, where the
source's rate scales the documents' own relative weights (1 by default) so
that the source yields its target number of words.  The whole part of ``e``
is certain: so many copies are taken at once.  The fractional part ``p`` is
an inclusion probability: each document draws a uniform number u from its
id, and the documents of a source are ranked by their random odds divided
by their inclusion odds, (u / (1 - u)) / (p / (1 - p)).  The sample is of
fixed size: the ranking is cut where the words of the documents above the
cut come nearest to what is left of the target.

The cut needs no global sort.  The rank statistic, mapped to (0, 1), is put
into ``cells`` equal cells; words per (source, cell) show in which cell the
cut falls, and only that cell's documents are ranked by a window; the rank
of the last document that is in becomes the source's threshold, so the
documents themselves are never shuffled.

Targets: sources are ordered by code point (null last) and weigh 5, 2, 1,
repeating; targets share the words of all documents by weight, capped at
``cap`` times a source's own words, and the excess goes to the others by
weight until none is above.  Solved in closed form over the table of
sources, which is one row per source and the only thing sorted whole.

Defined results: null text has no words; a document without words is never
taken (0 copies); equal draws are cut in the order of doc_id (null first) and
text digest, so reruns agree; repeated rows (id and text) share a draw and
are taken or left together; an empty table gives no rows; other columns are
carried along, but ones named size, source_size, target or copies are
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.base import cut_lineage, text_or_empty, words
from orrery.session import bounded_broadcast

CAP = 3.0
CELLS = 4096
WEIGHTS = (5.0, 2.0, 1.0)
#: tables of sources are broadcast up to this many rows, joined by a shuffle beyond
SMALL_TABLE = 20_000


def size_of(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """(source, source_size) -> the same with ``target``."""
    ring = F.array(*[F.lit(float(w)) for w in weights])
    order = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    # sources reach their cap in this order
    by_cap = Window.orderBy("_at", F.col("source").asc_nulls_last())
    s = (sources.withColumn("_w", F.element_at(ring, (F.row_number().over(order) - 1) % len(weights) + 1))
         .withColumn("_cap", F.col("source_size") * F.lit(cap)).withColumn("_at", F.col("_cap") / F.col("_w"))
         .withColumn("_total", F.sum("source_size").over(every).cast("double")))
    upto = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # the common level when all sources before this one are at their caps
    s = s.withColumn("_level", (F.col("_total") - F.coalesce(F.sum("_cap").over(upto), F.lit(0.0)))
                     / F.sum("_w").over(after))
    level = F.min(F.when(F.col("_level") <= F.col("_at"), F.struct("_at", "_level"))).over(every)["_level"]
    return (s.withColumn("_lambda", level)
            .withColumn("target", F.coalesce(F.least("_cap", F.col("_lambda") * F.col("_w")), F.col("_cap")))
            .select("source", "source_size", "target"))


def uniform(seed: int, key: Column) -> Column:
    """A number in (0, 1) with 52 random bits, from the digest of seed and key."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def _rates(narrow: DataFrame, per_source: DataFrame, cap: float) -> DataFrame:
    """(source, weight) -> expected copies ``_e``: rate x weight, ``cap`` at
    most, where the rate makes the source's expected words its target."""
    per = narrow.groupBy("source", "_g").agg(F.sum("size").cast("double").alias("_words"))
    t = per_source.select(F.col("source").alias("_s"), "source_size", "target")
    per = per.join(t, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    heavy = Window.partitionBy("source").orderBy(F.col("_g").desc())
    upto = heavy.rowsBetween(Window.unboundedPreceding, -1)
    after = heavy.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    per = per.withColumn("_rate", F.try_divide(
        F.col("target") - F.lit(cap) * F.coalesce(F.sum("_words").over(upto), F.lit(0.0)),
        F.sum(F.col("_words") * F.col("_g")).over(after)))
    # from the heaviest weight down documents are at the cap until one fits under it
    fits = F.max(F.when(F.col("_rate") * F.col("_g") <= cap, F.struct("_g", "_rate"))
                 ).over(Window.partitionBy("source"))["_rate"]
    return per.select("source", "_g", "source_size", "target",
                      F.least(F.lit(cap), F.coalesce(fits * F.col("_g"), F.lit(0.0))).alias("_e"))


def _draw(d: DataFrame, seed: int, cells: int) -> DataFrame:
    """Adds the certain copies and the rank statistic with its cell."""
    p = F.col("_e") - F.floor("_e")
    u = uniform(seed, F.col("doc_id"))
    return (d.withColumn("_whole", F.when(F.col("size") > 0, F.floor("_e")).otherwise(F.lit(0)).cast("long"))
            .withColumn("_q", F.when((F.col("size") > 0) & (p > 0), (u / (1 - u)) / (p / (1 - p))))
            .withColumn("_cell", F.least(F.floor(F.col("_q") / (1 + F.col("_q")) * cells), F.lit(cells - 1)))
            .withColumn("_rank", F.when(F.col("_q").isNotNull(), F.struct("_q", "_id", "_h"))))


def mix(docs: DataFrame, seed: int = 7, weights=WEIGHTS, cap: float = CAP, cells: int = CELLS,
        weight_col: str | None = None, size_col: str | None = None) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with ``size``, ``source_size``,
    ``target`` and ``copies`` (0 to ``cap``) added.  ``weight_col``: a
    document's relative weight within its source (positive, kept in steps of
    1/16; default 1).  ``size_col``: a column that has the sizes already."""
    g = F.lit(1.0) if weight_col is None else F.greatest(F.round(F.col(weight_col).cast("double") * 16) / 16, F.lit(1 / 16))
    # the row itself goes along in one column, so no name of its own can clash
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", "source",
                    (F.col(size_col).cast("long") if size_col else size_of(text_or_empty())).alias("size"),
                    F.coalesce(g, F.lit(1.0)).alias("_g"),
                    F.coalesce(F.col("doc_id").cast("long"), F.lit(-2**63)).alias("_id"),
                    (F.xxhash64(text_or_empty()) if "text" in docs.columns else F.lit(0).cast("long")).alias("_h"))
    # what the cut is found from: a few numbers of each document, read once
    narrow = cut_lineage(d.select("doc_id", "source", "size", "_g", "_id", "_h"))
    per_source = targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    rates = cut_lineage(_rates(narrow, per_source, cap)).select(
        F.col("source").alias("_s"), F.col("_g").alias("_k"), "source_size", "target", "_e")

    def rated(side: DataFrame) -> DataFrame:
        small = bounded_broadcast(rates, SMALL_TABLE)
        return side.join(small, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_g") == F.col("_k"))).drop("_s", "_k")

    drawn = _draw(rated(narrow), seed, cells)
    per_cell = (drawn.groupBy("source", "_cell")
                .agg(F.sum("size").alias("_words"), F.sum(F.col("_whole") * F.col("size")).alias("_sure"),
                     F.max("target").alias("_t")))
    of_source = Window.partitionBy("source")
    run = of_source.orderBy(F.col("_cell").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    ranked_words = F.when(F.col("_cell").isNotNull(), F.col("_words"))
    reached = (per_cell.withColumn("_need", F.col("_t") - F.sum("_sure").over(of_source))
               .withColumn("_left", F.col("_need") - F.coalesce(F.sum(ranked_words).over(run), F.lit(0)))
               .filter(F.col("_cell").isNotNull() & (F.col("_left") > 0)))
    # the cell that the cut falls into, and the words still wanted from it
    cut = cut_lineage(reached.groupBy("source").agg(F.max("_cell").alias("_at"),
                                                    F.max_by("_left", "_cell").alias("_left")))
    side = bounded_broadcast(cut.select(F.col("source").alias("_s"), "_at", "_left"), SMALL_TABLE)
    edge = drawn.join(side, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_cell") == F.col("_at")))
    upto = Window.partitionBy("source").orderBy("_rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # nearest: a document is in if the cut lies past its middle
    last = (edge.withColumn("_in", F.sum("size").over(upto) - F.col("size") / 2 <= F.col("_left"))
            .filter("_in").groupBy("source").agg(F.max("_rank").alias("_last")))
    cut = cut_lineage(cut.join(last.withColumnRenamed("source", "_s"),
                               F.col("source").eqNullSafe(F.col("_s")), "left")
                      .select(F.col("source").alias("_s"), "_at", "_last"))
    out = _draw(rated(d), seed, cells).join(bounded_broadcast(cut, SMALL_TABLE),
                                            F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    extra = F.coalesce((F.col("_cell") < F.col("_at")) | (F.col("_rank") <= F.col("_last")), F.lit(False))
    keep = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies")]
    return out.select(*[F.col("_row")[c].alias(c) for c in keep], "size", "source_size", "target",
                      (F.col("_whole") + extra.cast("long")).alias("copies"))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text", "source")
    mixed = mix(whole, **options).filter("copies > 0")
    return (mixed.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
            .select(*[F.col("row")[c].alias(c) for c in docs.columns]))
