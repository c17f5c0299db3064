"""Metric queries (AG-10..13, AG-18, WIN-4) over prediction frames derived
from the tables by fixed rules, so that SQL can reproduce them."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.operators import metrics as M
from orrery.plans.registry import query
from orrery.session import small_side
from orrery.sources.tables import table


def R(c, d: int = 6):
    return F.round(F.col(c) if isinstance(c, str) else c, d)


_PRED3 = "CASE WHEN l_linestatus = 'F' THEN 'A' WHEN l_discount > 0.05 THEN 'N' ELSE 'R' END"
_PRED2 = "CASE WHEN l_linestatus = 'F' THEN 'A' ELSE 'N' END"


def _flag_predictions(spark, sf, rule: str):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("label"),
                     F.expr(rule).alias("prediction"))


@query("ag10_accuracy", f"""
SELECT round(avg(CASE WHEN l_returnflag = {_PRED3} THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM lineitem
""")
def ag10(spark, sf):
    p = _flag_predictions(spark, sf, _PRED3)
    return p.agg(R(M.accuracy(p, "label", "prediction")).alias("accuracy"))


@query("ag10_accuracy_binary", """
SELECT round(avg(CASE WHEN l.quality = CASE WHEN d.n_chars > 2000 THEN 1 ELSE 0 END THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM labels l JOIN documents d ON l.doc_id = d.doc_id
""")
def ag10b(spark, sf):
    lab = table(spark, sf, "labels")
    d = table(spark, sf, "documents").select("doc_id", (F.col("n_chars") > 2000).cast("int").alias("prediction"))
    p = lab.join(d, "doc_id")
    return p.agg(R(M.accuracy(p, "quality", "prediction")).alias("accuracy"))


def _report_sql(rule: str, zd: float) -> str:
    return f"""
WITH p AS (SELECT l_returnflag AS label, {rule} AS prediction FROM lineitem),
cls AS (SELECT label AS cls FROM p UNION SELECT prediction FROM p),
c AS (SELECT cls.cls,
             (SELECT count(*) FROM p WHERE p.label = cls.cls AND p.prediction = cls.cls) AS tp,
             (SELECT count(*) FROM p WHERE p.prediction = cls.cls) AS predicted,
             (SELECT count(*) FROM p WHERE p.label = cls.cls) AS support FROM cls),
per AS (SELECT cls AS class,
               CASE WHEN predicted = 0 THEN {zd} ELSE tp / predicted END AS precision,
               CASE WHEN support = 0 THEN {zd} ELSE tp / support END AS recall,
               2.0 * tp / (predicted + support) AS f1, support, tp FROM c)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM per
UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6),
                 round(sum(tp) / sum(support), 6), sum(support) FROM per
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support) FROM per
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
                 round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
                 sum(support) FROM per
"""


def _report(spark, sf, rule, zd):
    p = _flag_predictions(spark, sf, rule)
    r = M.classification_report(p, "label", "prediction", zero_division=zd)
    return r.select("class", R("precision").alias("precision"), R("recall").alias("recall"),
                    R("f1").alias("f1"), F.col("support").cast("long").alias("support"))


@query("ag11_classification_report", _report_sql(_PRED3, 0.0))
def ag11(spark, sf):
    return _report(spark, sf, _PRED3, 0.0)


@query("ag11_classification_report_zero_division_1", _report_sql(_PRED2, 1.0))
def ag11b(spark, sf):
    """Class R is never predicted: its precision is undefined and reported
    as 1 under ``zero_division=1``."""
    return _report(spark, sf, _PRED2, 1.0)


@query("ag12_confusion_matrix", f"""
WITH p AS (SELECT l_returnflag AS label, {_PRED3} AS prediction FROM lineitem),
lab AS (SELECT * FROM (VALUES ('A'), ('N'), ('R')) v(label))
SELECT lab.label,
       (SELECT count(*) FROM p WHERE p.label = lab.label AND p.prediction = 'A') AS A,
       (SELECT count(*) FROM p WHERE p.label = lab.label AND p.prediction = 'N') AS N,
       (SELECT count(*) FROM p WHERE p.label = lab.label AND p.prediction = 'R') AS R
FROM lab
""")
def ag12(spark, sf):
    p = _flag_predictions(spark, sf, _PRED3)
    return M.confusion_matrix(p, "label", "prediction", ["A", "N", "R"])


@query("ag13_mse", """
WITH f AS (SELECT l_returnflag, regr_slope(l_extendedprice, l_quantity) AS m,
                  regr_intercept(l_extendedprice, l_quantity) AS b FROM lineitem GROUP BY 1)
SELECT round(avg(pow(l.l_extendedprice - (f.m * l.l_quantity + f.b), 2)), 2) AS mse
FROM lineitem l JOIN f ON l.l_returnflag = f.l_returnflag
""")
def ag13(spark, sf):
    """MSE of the per-flag fitted lines against the actual prices."""
    li = table(spark, sf, "lineitem")
    y, x = F.col("l_extendedprice"), F.col("l_quantity")
    fit = li.groupBy("l_returnflag").agg(F.regr_slope(y, x).alias("m"), F.regr_intercept(y, x).alias("b"))
    p = li.join(small_side(fit), "l_returnflag").withColumn("pred", F.col("m") * x + F.col("b"))
    return p.agg(R(M.mse("l_extendedprice", "pred"), 2).alias("mse"))


_MODEL_ORDER = ["click", "error", "purchase", "signup", "view"]
_ORD_SQL = "CASE event_type " + " ".join(f"WHEN '{m}' THEN {i}" for i, m in enumerate(_MODEL_ORDER)) + " END"


@query("ag18_arg_best", f"""
WITH s AS (SELECT user_id, event_type, avg(value) AS score, {_ORD_SQL} AS ordinal FROM events GROUP BY 1, 2)
SELECT user_id, event_type AS best FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, ordinal) AS rn FROM s) t WHERE rn = 1
""")
def ag18(spark, sf):
    """Per user, the event type ("model") with the best mean value; ties go
    to the earliest in the fixed model order."""
    e = table(spark, sf, "events")
    s = e.groupBy("user_id", "event_type").agg(F.avg("value").alias("score"))
    ordinal = F.array_position(F.array(*[F.lit(m) for m in _MODEL_ORDER]), F.col("event_type"))
    s = s.withColumn("ordinal", ordinal)
    return M.arg_best(s, ["user_id"], "event_type", "score", "ordinal")


@query("win4_rank_by_mean_score", """
SELECT event_type, round(avg(value), 6) AS mean_score, rank() OVER (ORDER BY avg(value) DESC) AS rank
FROM events GROUP BY event_type
""")
def win4(spark, sf):
    e = table(spark, sf, "events")
    s = e.groupBy("event_type").agg(F.avg("value").alias("mean_score"))
    return M.rank_desc(s, "mean_score").select("event_type", R("mean_score").alias("mean_score"), "rank")
