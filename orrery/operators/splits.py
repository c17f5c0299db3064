"""Train / test splitting (SPL-1..5), repeatable and partition-independent.

Randomness comes from a mixing hash of the row key and a seed, so the
same rows are chosen whatever the partitioning.  Exact-size splits rank rows
with a distributed index (range partitioning + per-partition offsets), and
stratified splits rank inside each class the same way, so no class - even
one holding a third of the rows - is gathered into a single task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.operators.relational import hash_number, hash_order
from orrery.session import cut_lineage, small_side


def group_index(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                out: str = "rank", partitions: int | None = None) -> DataFrame:
    """0-based position of every row within its key group under ``order``.

    Rows are range-partitioned on (keys, order) and sorted locally; each row
    gets its in-partition position, and per (partition, key) counts give the
    offsets contributed by earlier partitions.  The count table has at most
    partitions x keys rows.  The sorted rows are written once: range bounds
    are sampled, so the two readers must not sort for themselves."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kcols = [F.col(k) for k in keys]
    s = (df.repartitionByRange(n, *kcols, *order).sortWithinPartitions(*kcols, *order)
           .withColumn("_pid", F.spark_partition_id())
           .withColumn("_mid", F.monotonically_increasing_id()))
    s = s.withColumn("_loc", F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33))
    s = cut_lineage(s)
    cnt = s.groupBy("_pid", *keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_loc").alias("_first"))
    w = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    cnt = cnt.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    cnt = cnt.select(F.col("_pid").alias("_p"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_off", "_first")
    j = s.join(small_side(cnt), [F.col("_pid") == F.col("_p"), *same]).drop("_p", *[f"_k{i}" for i in range(len(keys))])
    return (j.withColumn(out, F.col("_off") + F.col("_loc") - F.col("_first"))
             .drop("_pid", "_mid", "_loc", "_off", "_first"))


def split_exact(df: DataFrame, key: str, test_size: float, seed: int = 0) -> DataFrame:
    """SPL-1: adds ``is_test``; exactly round(n * test_size) test rows,
    chosen by hash order of the key."""
    n = df.count()
    n_test = int(round(n * test_size))
    ranked = group_index(df.withColumn("_g", F.lit(0)), ["_g"],
                         [hash_order(key, seed), F.col(key)], "_r")
    return ranked.withColumn("is_test", F.col("_r") < n_test).drop("_g", "_r")


def split_approx(df: DataFrame, key: str, test_size: float, seed: int = 0) -> DataFrame:
    """SPL-1 approximate: per-row hash threshold, no ranking pass."""
    return df.withColumn("is_test", hash_order(key, seed) < F.lit(int(test_size * 1000003)))


def split_stratified(df: DataFrame, key: str, label: str, test_size: float,
                     seed: int = 0) -> DataFrame:
    """SPL-2: in every class the first round(n_class * test_size) rows by
    hash order are test rows, so class shares are kept."""
    ranked = group_index(df, [label], [hash_order(key, seed), F.col(key)], "_r")
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    j = ranked.join(sizes, label)
    return j.withColumn("is_test", F.col("_r") < F.round(F.col("_n") * test_size)).drop("_r", "_n")


def split_positional(df: DataFrame, key: str, n_train: int) -> DataFrame:
    """SPL-3: the first n rows by key are training rows."""
    ranked = group_index(df.withColumn("_g", F.lit(0)), ["_g"], [F.col(key)], "_r")
    return ranked.withColumn("is_train", F.col("_r") < n_train).drop("_g", "_r")


def stratified_folds(df: DataFrame, key: str, label: str, k: int, seed: int = 0) -> DataFrame:
    """SPL-4: fold = (rank inside the class by hash order) mod k, so every
    fold holds about 1/k of each class; usable as ``CrossValidator.foldCol``."""
    ranked = group_index(df, [label], [hash_order(key, seed), F.col(key)], "_r")
    return ranked.withColumn("fold", (F.col("_r") % k).cast("int")).drop("_r")


def shuffle_splits(df: DataFrame, key: str, n_splits: int, test_size: float,
                   seed: int = 0) -> DataFrame:
    """SPL-5: n independent seeded splits, long form (split, row, is_test);
    each row is expanded in place, no join."""
    ex = df.withColumn("split", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))))
    h = hash_number(F.concat_ws(":", F.lit(str(seed)), F.col("split"), F.col(key)))
    return ex.withColumn("is_test", h < F.lit(int(test_size * 1000003)))
