"""Projection, filter, null, ordering, set and grouping operators.

All functions are DataFrame -> DataFrame (or Column builders) and stay
inside Catalyst: no Python UDFs, no collects.  Group statistics are always
computed with a partial (map-side) aggregate and joined back, never with a
window over an unbounded partition, so one hot key cannot pin a third of
the data in a single task.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.session import small_side


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- PRJ ----

def keep_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """PRJ-1: keep a list of columns, in the given order."""
    return df.select(*cols)


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """PRJ-2: drop columns (unknown names are ignored, as Spark does)."""
    return df.drop(*cols)


def columns_except(df: DataFrame, excluded: Iterable[str]) -> DataFrame:
    """PRJ-3: every column not in ``excluded``, original order."""
    ex = set(excluded)
    return df.select(*[c for c in df.columns if c not in ex])


def columns_by_position(df: DataFrame, start: int | None = None,
                        stop: int | None = None) -> DataFrame:
    """PRJ-4: positional column slice with Python slice semantics
    (``stop=-1`` is all but last, ``start=-1`` is the last column)."""
    return df.select(*df.columns[slice(start, stop)])


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """PRJ-5: rename several columns at once."""
    return df.withColumnsRenamed(dict(mapping))


def truncate_int(c) -> Column:
    """PRJ-6: double -> int truncating toward zero (12.9 -> 12, -1.5 -> -1)."""
    return _c(c).cast("int")


def round_narrow(c, dtype: str = "short") -> Column:
    """PRJ-6: round half away from zero, then narrow (uint8 fits ``short``)."""
    return F.round(_c(c), 0).cast(dtype)


def recode(c, mapping: Mapping) -> Column:
    """PRJ-7: dictionary recode; values not in the mapping become NULL."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), _c(c))


def lump_levels(c, keep: Sequence, other: str = "other") -> Column:
    """PRJ-8: keep the listed levels, everything else (NULL too) -> other."""
    col = _c(c)
    return F.when(col.isin(list(keep)), col).otherwise(F.lit(other))


def lump_by_count(df: DataFrame, col: str, min_count: int,
                  other: str = "other", out: str | None = None) -> DataFrame:
    """PRJ-8 variant: keep levels seen at least ``min_count`` times.

    The level table has at most ``rows / min_count`` entries; while it is
    small it is broadcast, so the rows are not shuffled by a few levels.
    """
    out = out or col
    common = (df.groupBy(col).count().filter(F.col("count") >= min_count)
              .select(F.col(col).alias("_lvl"), F.lit(True).alias("_keep")))
    j = df.join(small_side(common), F.col(col).eqNullSafe(F.col("_lvl")), "left")
    return (j.withColumn(out, F.when(F.col("_keep") & F.col(col).isNotNull(), F.col(col))
                         .otherwise(F.lit(other)))
             .drop("_lvl", "_keep"))


def binarise(c, threshold, strict: bool = False, hi=1, lo=0) -> Column:
    """PRJ-9: ``>= t -> hi`` (or ``> t`` when strict), else lo."""
    col = _c(c)
    cond = col > threshold if strict else col >= threshold
    return F.when(cond, F.lit(hi)).otherwise(F.lit(lo))


def align_columns(df: DataFrame, fitted: Iterable[str], fill=0) -> DataFrame:
    """PRJ-10: project onto a fitted column list sorted by name; missing
    columns are added as ``fill``; extra columns are dropped."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(fill).alias(c)
                       for c in sorted(fitted)])


# ---------------------------------------------------------------- FLT ----

def filter_in(df: DataFrame, col: str, values) -> DataFrame:
    """FLT-1: equality (single value) or membership filter; pushed to scan."""
    if isinstance(values, (list, tuple, set)):
        return df.filter(F.col(col).isin(list(values)))
    return df.filter(F.col(col) == values)


def any_null(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def rows_with_any_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """FLT-2: rows with at least one NULL."""
    return df.filter(any_null(cols or df.columns))


def drop_any_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """FLT-2: ``dropna()``."""
    return df.na.drop("any", subset=cols)


def exact_else_prefix(df: DataFrame, col: str, text: str) -> DataFrame:
    """FLT-3: rows equal to ``text`` if any exist, else rows starting with it.

    A priority is attached per row and the global minimum (a one-row
    aggregate, broadcast by construction) selects the tier.
    """
    pr = (F.when(F.col(col) == text, 1)
          .when(F.col(col).startswith(text), 2))
    cand = df.withColumn("_prio", pr).filter(F.col("_prio").isNotNull())
    best = cand.agg(F.min("_prio").alias("_best"))
    return (cand.join(F.broadcast(best), F.col("_prio") == F.col("_best"))
                .drop("_prio", "_best"))


def split_by(df: DataFrame, cond: Column) -> tuple[DataFrame, DataFrame]:
    """FLT-4: accepted / rejected frames for an envelope check."""
    flag = F.coalesce(cond, F.lit(False))
    return df.filter(flag), df.filter(~flag)


# ---------------------------------------------------------------- NUL ----

def fill_constant(df: DataFrame, value, cols: Sequence[str] | None = None) -> DataFrame:
    """NUL-1: ``fillna(value)``."""
    return df.na.fill(value, subset=cols)


def group_stat(df: DataFrame, keys: Sequence[str], value: str,
               fn=F.avg, name: str = "_gstat") -> DataFrame:
    """WIN-5: a group aggregate attached to every row of the group.

    Computed as partial+final aggregate and an equi-join back instead of a
    window, so a hot group never has to sit in one task; while the groups
    are few they are broadcast and the rows stay where they are.
    """
    stats = df.groupBy(*keys).agg(fn(value).alias(name))
    return df.join(small_side(stats), on=list(keys), how="left")


def fill_group_mean(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """NUL-2: fill NULL with the mean of the same group."""
    j = group_stat(df, keys, value, F.avg, "_gmean")
    return j.withColumn(value, F.coalesce(F.col(value), F.col("_gmean"))).drop("_gmean")


# ---------------------------------------------------------------- AG ----

def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """AG-1: NULL count per column, all columns in one pass, long form."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "null_count")


def value_counts(df: DataFrame, col: str, name: str = "cnt") -> DataFrame:
    """AG-2: level frequencies, NULLs left out, count desc then level asc."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias(name))
              .orderBy(F.desc(name), F.asc(col)))


def majority_label(df: DataFrame, keys: Sequence[str], label: str,
                   out: str = "majority") -> DataFrame:
    """AG-6: most frequent label per group; ties go to the smallest label.

    Two aggregates (counts, then ``min_by`` on (-count, label)) instead of a
    window: partial aggregation keeps a hot group spread across tasks.
    """
    cnt = df.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("_n"))
    return cnt.groupBy(*keys).agg(
        F.min_by(F.col(label), F.struct(-F.col("_n"), F.col(label))).alias(out))


def vote3(a, b, c) -> Column:
    """AG-7: majority of three answers; if all differ the third one wins."""
    a, b, c = _c(a), _c(b), _c(c)
    return (F.when(a == b, a).when(a == c, a).when(b == c, b).otherwise(c))


def long_to_wide(df: DataFrame, keys: Sequence[str], name_col: str,
                 value_col: str, names: Sequence[str]) -> DataFrame:
    """AG-19: pivot chosen stat names into columns (first value wins after
    a dedupe upstream).  The name list is given so no extra job runs to
    discover it and the output schema is fixed."""
    return (df.groupBy(*keys).pivot(name_col, list(names))
              .agg(F.first(value_col, ignorenulls=True)))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """AG-5: first row per key under an explicit order (``min_by`` over a
    struct of the order columns, so no window partition holds a hot key)."""
    others = [c for c in df.columns if c not in keys]
    order_struct = F.struct(*order)
    agg = df.groupBy(*keys).agg(
        F.min_by(F.struct(*[F.col(c) for c in others]), order_struct).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])


def distinct_values_all_columns(df: DataFrame, cols: Sequence[str],
                                out: str = "value") -> DataFrame:
    """AG-5: distinct values over several columns together (stack + distinct)."""
    stacked = df.select(F.explode(F.array(*[F.col(c).cast("string") for c in cols])).alias(out))
    return stacked.distinct()


# ---------------------------------------------------------------- ORD ----

def top_n(df: DataFrame, n: int, keys: Sequence[Column]) -> DataFrame:
    """ORD-1 / ORD-5: order + limit -> TakeOrderedAndProject (per-partition
    top-n, then a merge of n rows per partition)."""
    return df.orderBy(*keys).limit(n)


def sort_nulls_last(df: DataFrame, col: str, ascending: bool = True,
                    tiebreak: Sequence[str] = ()) -> DataFrame:
    """ORD-2: full sort, NULLs last in both directions (library order)."""
    k = F.col(col).asc_nulls_last() if ascending else F.col(col).desc_nulls_last()
    return df.orderBy(k, *tiebreak)


def hash_order(key, seed: int) -> Column:
    """A repeatable pseudo-random number in [0, 1000003): the first 32 bits
    of the MD5 digest of ``seed:key``, which any SQL engine can compute.
    The digest mixes, so seeds give independent orders and no two keys are
    tied to each other."""
    return hash_number(F.concat(F.lit(f"{seed}:"), _c(key).cast("string")))


def hash_order_sql(key: str, seed: int) -> str:
    """The same number in the SQL of engines that cast hexadecimal text."""
    return f"(CAST('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) % 1000003)"


def hash_number(text: Column) -> Column:
    """First 32 bits of the MD5 digest of a text, modulo 1000003."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 1000003


def random_order(df: DataFrame, seed: int = 0, key: str | None = None) -> DataFrame:
    """ORD-4: random order; with a key the order is repeatable."""
    if key is None:
        return df.orderBy(F.rand(seed))
    return df.orderBy(hash_order(key, seed), F.col(key))


# ---------------------------------------------------------------- SET ----

def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """SET-1: union all by column name (missing columns -> NULL)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_union(a: DataFrame, b: DataFrame, col: str, out: str = "value") -> DataFrame:
    """SET-2: sorted distinct union of two value sets."""
    return (a.select(F.col(col).alias(out)).union(b.select(F.col(col).alias(out)))
             .distinct().orderBy(out))
