"""Evaluation metrics and model choice (AG-10..13, AG-18, WIN-4).

Every metric is an aggregate over a (label, prediction) frame, computed
with partial aggregation; per-class tables have one row per class.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def accuracy(df: DataFrame, label: str, pred: str) -> Column:
    """AG-10: share of rows where prediction equals label."""
    return F.avg((F.col(label) == F.col(pred)).cast("double"))


def mse(label: str, pred: str) -> Column:
    """AG-13: mean squared error."""
    return F.avg(F.pow(F.col(label) - F.col(pred), 2))


def class_counts(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per class: tp, number predicted (tp + fp), support (tp + fn), over
    the union of label and prediction values."""
    lab = df.groupBy(F.col(label).alias("cls")).agg(F.count(F.lit(1)).alias("support"))
    prd = df.groupBy(F.col(pred).alias("cls")).agg(F.count(F.lit(1)).alias("predicted"))
    tp = (df.filter(F.col(label) == F.col(pred)).groupBy(F.col(label).alias("cls"))
            .agg(F.count(F.lit(1)).alias("tp")))
    j = lab.join(prd, "cls", "full").join(tp, "cls", "left")
    return j.select("cls", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("tp", "predicted", "support")])


def _ratio(num, den, zero_division: float) -> Column:
    return F.when(den == 0, F.lit(float(zero_division))).otherwise(num / den)


def classification_report(df: DataFrame, label: str, pred: str, zero_division: float = 0.0) -> DataFrame:
    """AG-11: rows (class, precision, recall, f1, support) for every class,
    then ``accuracy``, ``macro avg`` and ``weighted avg``.  Undefined ratios
    become ``zero_division`` (the library's 0 by default, 1 on request)."""
    c = class_counts(df, label, pred)
    p = _ratio(F.col("tp"), F.col("predicted"), zero_division)
    r = _ratio(F.col("tp"), F.col("support"), zero_division)
    per = c.select(F.col("cls").cast("string").alias("class"), p.alias("precision"), r.alias("recall"),
                   "support", "tp", "predicted")
    # F1 = 2 tp / (2 tp + fp + fn); the denominator is positive for every
    # class in the union of labels and predictions
    per = per.withColumn("f1", 2 * F.col("tp") / (F.col("predicted") + F.col("support")))
    tot = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"),
                  F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                  (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
                  (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
                  (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"))
    acc = (F.col("tp") / F.col("n"))
    summary = tot.select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("class"), acc.alias("precision"), acc.alias("recall"),
                 acc.alias("f1"), F.col("n").alias("support")),
        F.struct(F.lit("macro avg").alias("class"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                 F.col("mf").alias("f1"), F.col("n").alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), F.col("wp").alias("precision"),
                 F.col("wr").alias("recall"), F.col("wf").alias("f1"), F.col("n").alias("support")))).alias("s"))
    summary = summary.select("s.*")
    return per.select("class", "precision", "recall", "f1", "support").unionByName(summary)


def confusion_matrix(df: DataFrame, label: str, pred: str, labels: Sequence) -> DataFrame:
    """AG-12: rows = true label, columns = predicted label, over the sorted
    union of labels (given, so the output schema is fixed); zeros filled."""
    labels = sorted(labels)
    cm = df.groupBy(label).pivot(pred, list(labels)).count()
    allrows = df.sparkSession.createDataFrame([(v,) for v in labels], [label])
    names = [str(v) for v in labels]
    return (allrows.join(cm, label, "left").na.fill(0, names)
                   .select(label, *[F.col(n).cast("long").alias(n) for n in names]))


def arg_best(df: DataFrame, keys: Sequence[str], item: str, score: str, ordinal: str,
             lowest: bool = False, out: str = "best") -> DataFrame:
    """AG-18: item with the best score per group; ties go to the first item
    (smallest ordinal), as ``max`` over a list keeps the first maximum."""
    if lowest:
        agg = F.min_by(F.col(item), F.struct(F.col(score), F.col(ordinal)))
    else:
        agg = F.max_by(F.col(item), F.struct(F.col(score), -F.col(ordinal)))
    return df.groupBy(*keys).agg(agg.alias(out))


def rank_desc(df: DataFrame, score: str, out: str = "rank") -> DataFrame:
    """WIN-4: competition rank by descending score over a small result
    table (parameter settings), as ``rank_test_score`` is defined."""
    return df.withColumn(out, F.rank().over(Window.orderBy(F.desc(score))).cast("long"))
