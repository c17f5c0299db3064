"""Feature engineering (FE-1..13, AG-8, AG-9, AG-20).

Fitted state is small (a few numbers per feature, a level list, a
dictionary) and is computed in one aggregate pass; applying it is a pure
projection.  Semantics follow the library defaults the analyses rely on:
population statistics (n, not n - 1) for scaling and variance thresholds,
0 for a constant column under min-max scaling, centred PCA, all-zero rows
for unseen levels.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.session import cut_lineage, small_side

# ---------------------------------------------------------------- FE-1/2 --

@dataclass
class MinMaxModel:
    cols: list
    mins: list
    maxs: list

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        """(x - min) / (max - min) with train statistics (test values may
        leave [0, 1]); a constant train column maps to 0; NULL stays NULL."""
        out = {}
        for c, lo, hi in zip(self.cols, self.mins, self.maxs):
            rng = (hi - lo) if hi is not None and lo is not None else None
            if not rng:
                out[c + suffix] = F.when(F.col(c).isNotNull(), F.lit(0.0))
            else:
                out[c + suffix] = (F.col(c) - F.lit(lo)) / F.lit(rng)
        return df.withColumns(out)


def minmax_fit(df: DataFrame, cols: Sequence[str]) -> MinMaxModel:
    row = df.agg(*[F.min(c).alias(f"mn_{i}") for i, c in enumerate(cols)],
                 *[F.max(c).alias(f"mx_{i}") for i, c in enumerate(cols)]).first()
    return MinMaxModel(list(cols), [row[f"mn_{i}"] for i in range(len(cols))],
                       [row[f"mx_{i}"] for i in range(len(cols))])


@dataclass
class StandardModel:
    cols: list
    means: list
    stds: list

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        """(x - mean) / population std; a zero std leaves x - mean."""
        out = {}
        for c, m, s in zip(self.cols, self.means, self.stds):
            centred = F.col(c) - F.lit(m)
            out[c + suffix] = centred / F.lit(s) if s else centred
        return df.withColumns(out)


def standard_fit(df: DataFrame, cols: Sequence[str]) -> StandardModel:
    row = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(cols)]).first()
    return StandardModel(list(cols), [row[f"m_{i}"] for i in range(len(cols))],
                         [row[f"s_{i}"] for i in range(len(cols))])


# ------------------------------------------------------------------ FE-3 --

def level_table(df: DataFrame, col: str) -> DataFrame:
    """FE-3: (level, n) of every non-NULL level, a table of any length."""
    return df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("level")).agg(F.count(F.lit(1)).alias("n"))


def fit_levels(df: DataFrame, col: str, n: int) -> list:
    """The ``n`` commonest levels (ties: the smaller one), sorted: a list
    that the caller's number bounds, to be named columns.  ``one_hot_pipeline``
    and ``level_table`` take any number of levels."""
    return sorted(r["level"] for r in level_table(df, col).orderBy(F.desc("n"), F.asc("level")).limit(n).collect())


def one_hot(col: str, levels: Sequence, prefix: str | None = None) -> list[Column]:
    """FE-3: one named 0/1 column for each of the levels that the caller
    lists; any other level or NULL gives all zeros
    (``handle_unknown='ignore'``)."""
    p = prefix if prefix is not None else col
    return [F.coalesce((F.col(col) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{p}_{v}") for v in levels]


def one_hot_pipeline(col: str, out: str):
    """FE-3, the general path for any number of levels: ML stages producing
    a sparse vector: alphabetical indexer that
    keeps unknowns in an extra last slot, encoder that drops that slot, so
    unseen levels and NULL encode as all zeros (T3)."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    idx = StringIndexer(inputCol=col, outputCol=f"{col}__idx", handleInvalid="keep",
                        stringOrderType="alphabetAsc")
    enc = OneHotEncoder(inputCol=f"{col}__idx", outputCol=out, dropLast=True, handleInvalid="error")
    return [idx, enc]


# ------------------------------------------------------------------ FE-4 --

def global_dictionary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FE-4: (value, idx) over every value seen in any of ``cols``, sorted;
    built by stacking columns, ``distinct`` and a distributed index."""
    from orrery.operators.textops import global_index
    vals = (df.select(F.explode(F.array(*[F.col(c).cast("string") for c in cols])).alias("value"))
              .filter(F.col("value").isNotNull()).distinct())
    return global_index(vals, [F.col("value")], "idx")


def dictionary_codes(df: DataFrame, key: str, cols: Sequence[str], dictionary: DataFrame) -> DataFrame:
    """FE-4 apply: long form (key, column, slot) where slot = column position
    x dictionary size + value index; unseen values give no slot (zeros)."""
    size = dictionary.count()
    longf = df.select(key, F.posexplode(F.array(*[F.col(c).cast("string") for c in cols])).alias("col_pos", "value"))
    j = longf.join(dictionary, "value", "left")
    names = F.array(*[F.lit(c) for c in cols])
    return j.select(key, F.element_at(names, F.col("col_pos") + 1).alias("column"),
                    (F.col("col_pos") * size + F.col("idx")).alias("slot"))


# ------------------------------------------------------------------ FE-5 --

def target_encoding_fit(df: DataFrame, col: str, target: str, m: float = 1.0) -> tuple[DataFrame, float]:
    """FE-5: m-estimate per level, (m * prior + sum y) / (m + n)."""
    prior = df.agg(F.avg(target)).first()[0]
    stats = df.groupBy(col).agg(F.sum(target).alias("_s"), F.count(F.lit(1)).alias("_n"))
    enc = stats.select(col, ((F.lit(m * prior) + F.col("_s")) / (F.lit(m) + F.col("_n"))).alias("_enc"))
    return enc, prior


def target_encoding_apply(df: DataFrame, col: str, enc: DataFrame, prior: float,
                          out: str) -> DataFrame:
    """Test rows take the train encoding; unseen levels take the prior."""
    return (df.join(small_side(enc), col, "left")
              .withColumn(out, F.coalesce(F.col("_enc"), F.lit(prior))).drop("_enc"))


def target_encoding_out_of_fold(df: DataFrame, col: str, target: str, fold: str, out: str, m: float = 1.0) -> DataFrame:
    """FE-5 for training rows: each row takes the m-estimate of its level
    over the other folds.  One small table of (level, fold) sums gives all:
    a fold's own sums are taken off the totals."""
    per = df.groupBy(col, fold).agg(F.sum(target).alias("_s"), F.count(F.lit(1)).alias("_n"))
    per = small_side(per)
    level = Window.partitionBy(col)
    rest = per.select(col, fold, (F.sum("_s").over(level) - F.col("_s")).alias("_os"), (F.sum("_n").over(level) - F.col("_n")).alias("_on"))
    by_fold = per.groupBy(fold).agg(F.sum("_s").alias("_fs"), F.sum("_n").alias("_fn"))
    every = Window.partitionBy()  # one row for each fold
    prior = by_fold.select(fold, F.try_divide(F.sum("_fs").over(every) - F.col("_fs"), F.sum("_fn").over(every) - F.col("_fn")).alias("_p"))
    enc = (rest.join(prior, fold).select(F.col(col).alias("_c"), F.col(fold).alias("_f"),
           F.when(F.col("_on") > 0, (m * F.col("_p") + F.col("_os")) / (m + F.col("_on"))).otherwise(F.col("_p")).alias(out)))
    return (df.join(small_side(enc), df[col].eqNullSafe(F.col("_c")) & df[fold].eqNullSafe(F.col("_f")), "left").drop("_c", "_f"))


def _shrunk(n, s, q, prior, spread) -> Column:
    """Empirical-Bayes estimate of a level from its count, sum and sum of
    squares: its mean and the prior, weighted by n * spread and the level's own
    variance (``spread``: the variance of all targets)."""
    mean = s / n
    weight = F.try_divide(n * spread, n * spread + F.greatest(q / n - mean * mean, F.lit(0.0)))
    return F.coalesce(weight * mean + (1 - weight) * prior, prior)


def target_encoding_auto(train: DataFrame, test: DataFrame, col: str, target: str, out: str) -> DataFrame:
    """FE-5 with the smoothing chosen per level: a level that scatters little
    or has many rows keeps its own mean, others move to the prior.  Unseen
    levels take the prior; NULL is a level."""
    base = train.agg(F.avg(target)).first()[0]
    y = F.col(target).cast("double") - F.lit(base)  # squares of centred targets do not cancel
    per = small_side(train.groupBy(F.col(col).alias("_c")).agg(
        F.sum(y).alias("_s"), F.sum(y * y).alias("_q"), F.count(target).cast("double").alias("_n")).filter("_n > 0"))
    every = per.agg(F.sum("_s").alias("s"), F.sum("_q").alias("q"), F.sum("_n").alias("n")).first()
    if not every["n"]:
        return test.withColumn(out, F.lit(None).cast("double"))
    prior = every["s"] / every["n"]
    spread = F.lit(max(0.0, every["q"] / every["n"] - prior * prior))
    enc = per.select("_c", (F.lit(base) + _shrunk(F.col("_n"), F.col("_s"), F.col("_q"), F.lit(prior), spread)).alias("_enc"))
    return (test.join(small_side(enc), F.col(col).eqNullSafe(F.col("_c")), "left")
            .withColumn(out, F.coalesce("_enc", F.lit(base + prior))).drop("_c", "_enc"))


def target_encoding_auto_out_of_fold(df: DataFrame, col: str, target: str, fold: str, out: str) -> DataFrame:
    """The same for training rows, from the other folds: a fold's own sums
    are taken off the totals of its level and of all levels."""
    base = df.agg(F.avg(target)).first()[0]
    y = F.col(target).cast("double") - F.lit(base)
    per = small_side(df.groupBy(F.col(col).alias("_c"), F.col(fold).alias("_f")).agg(
        F.sum(y).alias("s"), F.sum(y * y).alias("q"), F.count(target).cast("double").alias("n")))
    level = Window.partitionBy("_c")
    rest = per.select("_c", "_f", *[(F.sum(x).over(level) - F.col(x)).alias("_" + x) for x in "sqn"])
    folds = per.groupBy("_f").agg(*[F.sum(x).alias(x) for x in "sqn"])
    every = Window.partitionBy()  # one row for each fold
    folds = folds.select("_f", *[(F.sum(x).over(every) - F.col(x)).alias("a" + x) for x in "sqn"])
    prior = F.try_divide("as", "an")
    spread = F.greatest(F.try_divide("aq", "an") - prior * prior, F.lit(0.0))
    known = F.when(F.col("_n") > 0, _shrunk(F.col("_n"), F.col("_s"), F.col("_q"), prior, spread)).otherwise(prior)
    enc = small_side(rest.join(folds, "_f").select("_c", "_f", (F.lit(base) + known).alias(out)))
    return (df.join(enc, F.col(col).eqNullSafe(F.col("_c")) & F.col(fold).eqNullSafe(F.col("_f")), "left").drop("_c", "_f"))


# ------------------------------------------------------------------ FE-6 --

def polynomial(col: str, degree: int, include_bias: bool = False, prefix: str | None = None) -> list[Column]:
    p = prefix or col
    cols = [F.lit(1.0).alias(f"{p}_0")] if include_bias else []
    return cols + [F.pow(F.col(col), F.lit(float(k))).alias(f"{p}_{k}") for k in range(1, degree + 1)]


# ------------------------------------------------------- AG-8/9/20, FE-9.. --

#: columns of a block of the Gram matrix, and block pairs a task sums at a time
GRAM_BLOCK, GRAM_PAIRS = 256, 64
#: what is summed over the rows in which both columns are known
_MOMENTS = ("n", "sa", "sb", "saa", "sbb", "sab")


def _partial_grams(p: int, pairs: list[tuple[int, int]], block: int, shift: list[float]):
    """Rows (v) -> for each block pair its sums, one row a moment."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        at = {i: slice(i * block, min(p, (i + 1) * block)) for i in {k for ab in pairs for k in ab}}
        total = {}
        for b in batches:
            if not b.num_rows:
                continue
            flat = b.column("v").flatten()
            x = np.asarray(flat.fill_null(np.nan) if flat.null_count else flat, float).reshape(-1, p) - np.array(shift)
            known = ~np.isnan(x)
            x, m = np.where(known, x, 0.0), known.astype(float)
            for i, j in pairs:
                a, c, ma, mc = x[:, at[i]], x[:, at[j]], m[:, at[i]], m[:, at[j]]
                new = np.stack([ma.T @ mc, a.T @ mc, ma.T @ c, (a * a).T @ mc, ma.T @ (c * c), a.T @ c])
                total[i, j] = total[i, j] + new if (i, j) in total else new
        rows = [(i, j, k, s[k].ravel().tolist()) for (i, j), s in total.items() for k in range(len(_MOMENTS))]
        cols = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.float64())))],
                                         names=["i", "j", "k", "s"])
    return run


def _sum_blocks(t):
    import numpy as np
    import pyarrow as pa
    s = t.column("s").combine_chunks()
    whole = np.asarray(s.flatten()).reshape(len(s), -1).sum(0)
    return pa.table({c: t.column(c).slice(0, 1).cast(pa.int32()) for c in "ijk"} | {"s": pa.array([whole.tolist()], pa.list_(pa.float64()))})


def _block_correlations(p: int, block: int):
    def run(t):
        import numpy as np
        import pyarrow as pa
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        wide = min(p, (j + 1) * block) - j * block
        s = {k: np.array(v).reshape(-1, wide) for k, v in zip(t.column("k").to_pylist(), t.column("s").to_pylist())}
        n, sa, sb, saa, sbb, sab = (s[k] for k in range(len(_MOMENTS)))
        with np.errstate(all="ignore"):
            n_ = np.maximum(n, 1)
            r = (sab - sa * sb / n_) / np.sqrt((saa - sa * sa / n_) * (sbb - sb * sb / n_))
        r = np.where((n > 0) & np.isfinite(r), np.clip(r, -1, 1), np.nan)
        a, b = (x.ravel() for x in np.meshgrid(i * block + np.arange(n.shape[0]), j * block + np.arange(wide), indexing="ij"))
        keep = a < b
        a, b, r = a[keep], b[keep], r.ravel()[keep]
        both = [np.concatenate(x) for x in ((a, b), (b, a), (r, r))]
        return pa.table({"a": pa.array(both[0], pa.int32()), "b": pa.array(both[1], pa.int32()),
                         "corr": pa.array(both[2], mask=np.isnan(both[2]))})
    return run


def correlation_long(df: DataFrame, cols: Sequence[str], block: int = GRAM_BLOCK) -> DataFrame:
    """AG-8: Pearson correlation of every ordered pair (incl. the diagonal)
    over the rows in which both are known; long form (feature_a, feature_b,
    corr).

    The columns are cut into blocks and the moments of a pair of blocks are
    matrix products: a task adds its rows up, the tasks' sums are added in two
    steps, and the correlations are made where the sums are.  A task holds
    ``GRAM_PAIRS`` block pairs; more of them take further passes, so neither
    the plan nor a task grows with the square of the columns."""
    spark, p = df.sparkSession, len(cols)
    v = df.select(F.array(*[F.col(c).cast("double") for c in cols]).alias("v"))
    # sums about a point near the means do not cancel: those of some rows will do
    some = v.limit(1000).select(F.posexplode("v").alias("p", "x")).groupBy("p").agg(F.avg("x").alias("x")).collect()
    shift = [0.0] * p
    for r in some:
        shift[r["p"]] = r["x"] if r["x"] is not None and math.isfinite(r["x"]) else 0.0
    blocks = range(-(-p // block))
    pairs, found = [(i, j) for i in blocks for j in blocks if i <= j], None
    for s in range(0, len(pairs), GRAM_PAIRS):
        kind = "i int, j int, k int, s array<double>"
        part = v.mapInArrow(_partial_grams(p, pairs[s:s + GRAM_PAIRS], block, shift), kind)
        part = part.withColumn("salt", F.spark_partition_id() % 16)
        part = part.groupBy("i", "j", "k", "salt").applyInArrow(_sum_blocks, kind).groupBy("i", "j", "k").applyInArrow(_sum_blocks, kind)
        corr = part.groupBy("i", "j").applyInArrow(_block_correlations(p, block), "a int, b int, corr double")
        found = corr if found is None else found.unionByName(corr)
    names = spark.createDataFrame([(i, c) for i, c in enumerate(cols)], "n int, name string")
    diagonal = names.select(F.col("name").alias("feature_a"), F.col("name").alias("feature_b"), F.lit(1.0).alias("corr"))
    if p < 2:
        return diagonal
    found = (cut_lineage(found).join(F.broadcast(names.toDF("a", "feature_a")), "a").join(F.broadcast(names.toDF("b", "feature_b")), "b")
             .select("feature_a", "feature_b", "corr"))
    return found.unionByName(diagonal)


def top_partners(corr_long: DataFrame, n: int = 2) -> DataFrame:
    """AG-9: the n largest correlations of every feature (self included,
    as a plain descending sort does), ties by partner name."""
    from pyspark.sql import Window
    w = Window.partitionBy("feature_a").orderBy(F.desc("corr"), F.asc("feature_b"))
    return corr_long.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= n)


def prune_second_largest(corr_long: DataFrame, threshold: float) -> DataFrame:
    """FE-9: features whose 2nd-largest signed correlation exceeds the
    threshold (both members of a pair go: the matrix is not recomputed)."""
    second = top_partners(corr_long, 2).filter(F.col("rank") == 2)
    return second.filter(F.col("corr") > threshold).select(F.col("feature_a").alias("feature"))


def prune_greedy(cols: Sequence[str], corr_long: DataFrame, threshold: float) -> list[str]:
    """FE-10: upper triangle, |corr| > t: drop the later column j unless the
    earlier i is already dropped.  Works on the p x p result (driver-side,
    p^2 numbers)."""
    pos = {c: i for i, c in enumerate(cols)}
    hits = (corr_long.filter(F.abs("corr") > threshold)
                     .select("feature_a", "feature_b").collect())
    pairs = sorted((pos[a], pos[b]) for a, b in hits if pos[a] < pos[b])
    dropped: set[int] = set()
    for i, j in pairs:
        if i not in dropped:
            dropped.add(j)
    return [cols[j] for j in sorted(dropped)]


def variances(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AG-20: population variance of every feature, one pass, long form."""
    wide = df.agg(*[F.var_pop(c).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "feature", "variance")


def variance_threshold(df: DataFrame, cols: Sequence[str], t: float) -> DataFrame:
    """FE-12: features with population variance strictly above t."""
    return variances(df, cols).filter(F.col("variance") > t)


def target_correlations(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """FE-11: corr(feature, target) for every feature, one pass."""
    wide = df.agg(*[F.corr(c, target).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "feature", "corr")


def feature_importances(model, names: Sequence[str]) -> list[tuple[str, float]]:
    """FE-13: (name, importance) from a fitted tree ensemble, descending."""
    imp = model.featureImportances.toArray()
    return sorted(zip(names, [float(abs(x)) for x in imp]), key=lambda t: (-t[1], t[0]))


# --------------------------------------------------------------- FE-7/8 --

def pca_fit(df: DataFrame, vec: str, k: int):
    """FE-7: centre the vectors (library behaviour, T5), then fit Spark PCA.
    Returns (centred frame, PCAModel)."""
    from pyspark.ml.feature import PCA, StandardScaler
    sc = StandardScaler(inputCol=vec, outputCol=f"{vec}__c", withMean=True, withStd=False).fit(df)
    centred = sc.transform(df)
    model = PCA(k=k, inputCol=f"{vec}__c", outputCol="pca").fit(centred)
    return centred, model, sc


def components_for_fraction(explained: Sequence[float], fraction: float) -> int:
    """FE-8: fewest leading components whose cumulative ratio reaches f."""
    total = 0.0
    for i, v in enumerate(explained, 1):
        total += v
        if total >= fraction - 1e-12:
            return i
    return len(explained)
