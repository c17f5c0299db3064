"""Document fingerprints: bottom-k sketches of shingle hashes (native).

A document's words (lower case) give overlapping shingles of five words,
each hashed to 64 bits; the sketch is the ``k`` smallest distinct hashes in
ascending order.  Sketches are mergeable: the sketch of a union is the
bottom k of the united sketches (``merge``, ``merge_parts``).  From two
sketches follow estimates of resemblance (Jaccard) and containment, from
one the number of distinct shingles; all are exact while a document has at
most ``k`` distinct shingles.

A shingle's hash is the chained XXH64 of its words' XXH64 values, so no
shingle string is ever built.  Everything is a row-wise expression: the
whole text counts, nothing is shuffled.

Defined results: null text is empty; fewer than five words are one shingle,
no words none (empty sketch); two empty sketches resemble and contain each
other fully (1.0), an empty and another one not at all; equal texts have
equal sketches; the count of an empty sketch is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.base import cut_lineage, shuffle_partitions, text_or_empty

K = 128
SHINGLE = 5


#: the six ASCII white-space characters (fixed value)
WHITE = " \t\n\x0b\f\r"


def _bottom(hashes: Column, k: int) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def _word_hashes(text: Column) -> Column:
    trimmed = F.trim(F.lower(text), F.lit(WHITE))
    found = F.when(F.length(trimmed) > 0, F.split(trimmed, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>"))
    return F.transform(found, lambda w: F.xxhash64(w))


def _shingles(h: Column, n: int) -> Column:
    """Hashes of the runs of ``n`` words (fewer words: of the whole; none: none)."""
    whole = F.filter(F.array(F.aggregate(h, F.lit(42).cast("long"), lambda a, w: F.xxhash64(a, w))),
                     lambda _: F.size(h) > 0)
    return F.when(F.size(h) < n, whole).otherwise(_full_shingles(h, n))


def _full_shingles(h: Column, n: int) -> Column:
    return F.transform(F.slice(h, 1, F.greatest(F.size(h) - (n - 1), F.lit(0))),
                       lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, n)]))


def _bottom_of_words(h: Column, k: int, n: int) -> Column:
    # a one-element array binds the word hashes, so that they are made once
    return _bottom(F.flatten(F.transform(F.array(h), lambda x: _shingles(x, n))), k)


def sketch(text: Column, k: int = K, n: int = SHINGLE) -> Column:
    """Bottom-k sketch (array<bigint>) of a text column."""
    return _bottom_of_words(_word_hashes(text), k, n)


def _last_word(head: Column) -> Column:
    """The last word of a beginning, with a space if the beginning goes on
    behind it: what the words of any continuation start with."""
    piece = F.substring_index(F.rtrim(head, F.lit(WHITE)), " ", -1)
    return F.concat(F.element_at(F.split(piece, r"[\x20\x09-\x0D]+"), -1),
                    F.when(F.substring(head, -1, 1).isin(list(WHITE)), " ").otherwise(""))


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two documents' (or parts') shingles."""
    return _bottom(F.concat(a, b), k)


def merge_parts(parts: DataFrame, key: str, col: str, k: int = K) -> DataFrame:
    """One sketch per key from the sketches of its parts.  Parts are first
    merged within salted sub-groups, so a hot key is no single group; every
    group holds at most its parts' ``k`` smallest values."""
    salted = (parts.select(F.col(key), F.explode(col).alias("_v"))
              .groupBy(key, "_v").agg(F.lit(1))
              .withColumn("_s", F.pmod(F.xxhash64("_v"), F.lit(64))))
    low = Window.partitionBy(key, "_s").orderBy("_v")
    kept = salted.withColumn("_r", F.row_number().over(low)).filter(F.col("_r") <= k)
    found = kept.groupBy(key).agg(F.slice(F.sort_array(F.collect_list("_v")), 1, k).alias("_m"))
    keys = parts.select(key).distinct()
    return (keys.join(found.withColumnRenamed(key, "_k"), F.col(key).eqNullSafe(F.col("_k")), "left")
            .select(key, F.coalesce("_m", F.array().cast("array<bigint>")).alias(col)))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard resemblance: the share of the union's bottom k that
    is in both sketches."""
    both, total = F.array_intersect(a, b), F.size(a) + F.size(b)
    size = F.least(F.lit(k), total - F.size(both))
    shared = F.size(F.array_intersect(both, merge(a, b, k)))
    return (shared + (total == 0).cast("int")) / F.greatest(size, F.lit(1))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, otherwise
    (k - 1) over the k-th smallest hash's place in the range of hashes."""
    place = (F.element_at(a, k).cast("double") + F.lit(float(1 << 63))) / F.lit(float(1 << 64))
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(k - 1.0) / place)


def containment(a: Column, b: Column, k: int = K, near: Column | None = None) -> Column:
    """Estimated share of a's shingles that b has too.  ``near``: their
    resemblance, where it is known."""
    j = resemblance(a, b, k) if near is None else near
    union = F.element_at(F.transform(F.array(merge(a, b, k)), lambda u: distinct_count(u, k)), 1)
    own = distinct_count(a, k)
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when(F.size(a) == 0, F.lit(0.0))
            .otherwise(F.least(F.lit(1.0), j * union / own)))


def as_text(a: Column) -> Column:
    """A sketch as one string: 16 hex digits for each hash."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def _bucket(col: Column, splits: list[int]) -> Column:
    """Number of the range of ``col`` among sorted splits, by two short
    look-ups (a null is in range 0)."""
    if not splits:
        return F.lit(0)
    step = max(1, int(len(splits) ** 0.5))
    tables = [splits[i:i + step] for i in range(0, len(splits), step)]
    below = lambda arr: F.size(F.filter(arr, lambda s: s <= col))
    heads = F.array(*[F.lit(t[0]) for t in tables])
    fine = F.array(*[F.array(*[F.lit(x) for x in t]) for t in tables])
    first = below(heads)
    return F.when(first == 0, F.lit(0)).otherwise((first - 1) * step + below(F.element_at(fine, F.greatest(first, F.lit(1)))))


def dealt_in_order(docs: DataFrame, order_cols: list[str], id_col: str = "doc_id",
                   buckets: int | None = None) -> tuple[DataFrame, Window]:
    """Rows dealt into buckets of consecutive ids, and the window over them
    in which ``lead`` is the next row in ascending ``id_col``, ties by
    ``order_cols`` (after the last row: the first).

    The buckets' bounds are quantiles of the ids (one narrow pass; at most
    ``buckets`` numbers reach the driver).  Each bucket also gets a copy,
    marked ``_end`` = 1, of the first row of the bucket that follows, so the
    rows are shuffled once and no bucket looks at another."""
    spark = docs.sparkSession
    n = buckets or 4 * shuffle_partitions(spark)
    q = docs.select(F.percentile_approx(id_col, [i / n for i in range(1, n)], 20 * n).alias("q")).first()["q"]
    bucket = _bucket(F.col(id_col), sorted(set(q or [])))
    order = [F.col(id_col).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order_cols]]
    rows = docs.withColumn("_b", bucket)
    # first id of every bucket and the bucket before it: at most ``buckets`` rows
    firsts = cut_lineage(docs.select(id_col).withColumn("_b", bucket)
                         .groupBy("_b").agg(F.min(F.struct(id_col)).alias("_f")))
    down = Window.orderBy(F.col("_b").desc())
    last = F.first("_b").over(down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    firsts = firsts.select(F.col("_b").alias("_fb"), F.col("_f")[id_col].alias("_first"),
                           F.coalesce(F.lead("_b").over(down), last).alias("_to"))
    heads = rows.join(F.broadcast(firsts), (F.col("_b") == F.col("_fb")) & F.col(id_col).eqNullSafe(F.col("_first")))
    one = Window.partitionBy("_b").orderBy(*order)
    heads = (heads.withColumn("_r", F.row_number().over(one)).filter("_r = 1")
             .drop("_r", "_b", "_fb", "_first").withColumnRenamed("_to", "_b"))
    together = rows.withColumn("_end", F.lit(0)).unionByName(heads.withColumn("_end", F.lit(1)))
    return together.repartition(F.col("_b")), Window.partitionBy("_b").orderBy("_end", *order)


def edited_pairs(docs: DataFrame, k: int = K, n: int = SHINGLE) -> DataFrame:
    """For (doc_id, text): sketches of every text, of its edited text (the
    last quarter replaced by the beginning of the next document), and the
    estimated resemblance to both the edited text and the next document.

    Text and edited text share three quarters: their words are split and
    hashed once, and both sketches are merged from that part's."""
    base = docs.select("doc_id", text_or_empty().alias("text"))
    rows, in_order = dealt_in_order(base, ["text"])
    rows = (rows.withColumn("n_chars", F.length("text").cast("long"))
            .withColumn("_cut", F.floor(F.col("n_chars") / 4).cast("int"))
            .withColumn("_keep", (F.col("n_chars") - F.col("_cut")).cast("int")))
    head, tail = F.substring("text", F.lit(1), F.col("_keep")), F.substring("text", F.col("_keep") + 1, F.col("_cut"))
    h, before = F.col("_h"), F.col("_before")
    # the sketch of the words that both texts begin with (the last word may go on behind the cut), and the last of them
    rows = (rows.withColumn("_h", _word_hashes(head)).withColumn("_h", F.slice(h, 1, F.greatest(F.size(h) - 1, F.lit(0))))
            .withColumn("_begin", _bottom(F.flatten(F.transform(F.array(h), lambda x: _full_shingles(x, n))), k))
            .withColumn("_before", F.slice(h, F.greatest(F.size(h) - (n - 2), F.lit(1)), n - 1))
            .withColumn("_last", _last_word(head)))

    def continued(rest: Column) -> Column:
        return merge(F.col("_begin"), _bottom_of_words(F.concat(before, _word_hashes(F.concat("_last", rest))), k, n), k)

    nxt = (rows.withColumn("sketch", continued(tail))
           .withColumn("next", F.lead(F.struct("text", "sketch")).over(in_order))
           .filter("_end = 0"))
    new = F.substring("next.text", F.lit(1), F.col("_cut"))
    edited = F.concat(F.substring("text", F.lit(1), F.col("_keep")), new)
    return (nxt.withColumn("edited_sketch", continued(new))
            .select("doc_id", "n_chars", F.sha2(edited, 256).alias("edited_sha256"), "sketch", "edited_sketch",
                    resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
                    resemblance(F.col("sketch"), F.col("next.sketch"), k).alias("near_next")))
