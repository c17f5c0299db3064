"""Exact trees, multinomial boosting, normal equations and wide correlations
against written-out references."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orrery.operators import features as FE
from orrery.operators import models as ML
from orrery.operators import trees as TR


def labelled(spark, x, y, kind="int"):
    return spark.createDataFrame([(i, list(map(float, v)), c if isinstance(c, str) else int(c)) for i, (v, c) in enumerate(zip(x, y))], f"id long, v array<double>, y {kind}").repartition(3)


# ---- ML-6 ----------------------------------------------------------------------

def brute_tree(x, y, depth, min_leaf, node=1, out=None):
    """Every threshold of every feature, one by one."""
    out = {} if out is None else out
    classes = sorted(set(y_all))
    counts = [int((y == c).sum()) for c in classes]
    best = None
    if depth and max(counts) < len(y) and len(y) >= max(2, 2 * min_leaf):
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for lo, hi in zip(values, values[1:]):
                left = y[x[:, f] <= lo]
                if min(len(left), len(y) - len(left)) < min_leaf:
                    continue
                c = np.array([(left == k).sum() for k in classes])
                r = np.array(counts) - c
                g = float((c * c).sum()) / len(left) + float((r * r).sum()) / (len(y) - len(left))
                if best is None or g > best[0]:
                    best = g, f, lo / 2 + hi / 2
    out[node] = (counts, best[1:] if best else None)
    if best:
        at = x[:, best[1]] <= best[2]
        brute_tree(x[at], y[at], depth - 1, min_leaf, 2 * node, out)
        brute_tree(x[~at], y[~at], depth - 1, min_leaf, 2 * node + 1, out)
    return out


@pytest.mark.parametrize("min_leaf,ranges", [(1, 64), (5, 3), (1, 1)])
def test_exact_tree(spark, min_leaf, ranges):
    global y_all
    rng = np.random.default_rng(0)
    x = np.round(rng.normal(size=(220, 3)), 1)  # many equal values and ties
    y_all = y = (x[:, 0] + x[:, 1] * x[:, 2] > 0.3).astype(int) + 2 * (rng.random(220) < 0.15)
    df = labelled(spark, x, y).unionByName(spark.createDataFrame([(900, None, 1), (901, [0.0, 0.0, 0.0], None)], "id long, v array<double>, y int"))
    tree = TR.exact_tree(df, "v", "y", 4, min_leaf=min_leaf, ranges=ranges)
    want = brute_tree(x, y, 4, min_leaf)
    assert tree.counts == {n: c for n, (c, _) in want.items()}
    assert tree.splits == {n: (s[0], pytest.approx(s[1], abs=0)) for n, (_, s) in want.items() if s}
    got = df.filter("id < 900").select("id", tree.predict("v").alias("p"), tree.node("v").alias("n")).collect()
    for r in got:
        counts = want[r["n"]][0]
        assert want[r["n"]][1] is None and tree.classes[counts.index(max(counts))] == r["p"]


def test_exact_tree_of_one_class_strings_and_nothing(spark):
    one = TR.exact_tree(labelled(spark, [[1], [2]], ["a", "a"], "string"), "v", "y", 3)
    assert not one.splits and one.label(1) == "a"
    two = TR.exact_tree(labelled(spark, [[1], [2], [2]], ["a", "b", "b"], "string"), "v", "y", 3)
    assert two.splits == {1: (0, 1.5)} and [two.label(n) for n in (2, 3)] == ["a", "b"]
    assert TR.exact_tree(labelled(spark, [[1]], ["a"], "string").limit(0), "v", "y", 3).counts == {}


# ---- ML-8 ----------------------------------------------------------------------

def brute_boost(x, y, cuts, rounds, depth, rate):
    """Scores after all rounds, and the deviance before each, row by row."""
    k = y.max() + 1
    score = np.tile(np.log(np.bincount(y) / len(y)), (len(y), 1))
    deviance = []

    def tree(at, r, left):
        h = np.abs(r[at]) * (1 - np.abs(r[at]))
        value = (k - 1) / k * r[at].sum() / h.sum() if h.sum() else 0.0
        best = None
        if left:
            for f, c in enumerate(cuts):
                for t in c:
                    a, b = at[x[at, f] <= t], at[x[at, f] > t]
                    if len(a) and len(b):
                        g = r[a].sum() ** 2 / len(a) + r[b].sum() ** 2 / len(b) - r[at].sum() ** 2 / len(at)
                        if best is None or g > best[0] + 1e-10:
                            best = g, a, b
        if best and best[0] > 1e-10:
            return tree(best[1], r, left - 1) + tree(best[2], r, left - 1)
        return [(at, value)]
    for _ in range(rounds):
        p = np.exp(score) / np.exp(score).sum(1, keepdims=True)
        deviance.append(-np.log(p[np.arange(len(y)), y]).mean())
        for c in range(k):
            for at, value in tree(np.arange(len(y)), (y == c) - p[:, c], depth):
                score[at, c] += rate * value
    return score, deviance


@pytest.mark.parametrize("classes", [3, 7])
def test_boosting(spark, classes):
    rng = np.random.default_rng(classes)
    x = rng.normal(size=(210, 4))
    y = np.digitize(x[:, 0] + 0.5 * x[:, 1], np.linspace(-1.2, 1.2, classes - 1))
    df = labelled(spark, x, y)
    model = TR.boost(df, "v", "y", rounds=6, max_depth=2, rate=0.3, bins=8, keep_every=4)
    assert len(model.rounds) == 6 and all(len(c) <= 7 for c in model.cuts)
    assert all(b < a for a, b in zip(model.deviance, model.deviance[1:]))
    score, deviance = brute_boost(x, y, model.cuts, 6, 2, 0.3)
    assert np.allclose(model.deviance, deviance)
    assert np.allclose(model.score(x), score)
    got = {r["id"]: r["prediction"] for r in model.predict(df, "v").select("id", "prediction").collect()}
    assert [got[i] for i in range(len(x))] == score.argmax(1).tolist()
    assert np.mean([got[i] == y[i] for i in range(len(x))]) > 0.6


def test_boosting_with_nothing_to_split(spark):
    flat = TR.boost(labelled(spark, [[1, 1]] * 6, ["a", "b", "c"] * 2, "string"), "v", "y", rounds=2)
    assert flat.predict(labelled(spark, [[5, 5]], ["a"], "string"), "v").first()["prediction"] == "a"
    assert np.allclose(flat.score(np.ones((1, 2))), math.log(1 / 3), atol=1e-9)
    one = TR.boost(labelled(spark, [[1.0]], ["z"], "string"), "v", "y")
    assert one.predict(labelled(spark, [[5]], ["a"], "string"), "v").first()["prediction"] == "z"


# ---- ML-3, ML-4 ------------------------------------------------------------------

def test_polynomials_and_dependent_columns(spark):
    rng = np.random.default_rng(2)
    x = rng.uniform(900, 1000, 400)  # far from 0
    y = 3 + (x - 950) ** 2 / 50 + rng.normal(size=400)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)] + [(None, 1.0), (2.0, None)], "x double, y double")
    for n, coef, r2 in ML.polynomial_fits(df, "x", "y", [1, 2, 3]):
        fit = np.polynomial.Polynomial.fit(x, y, n)
        assert np.allclose(np.polyval(coef, x), fit(x), atol=1e-4)
        assert r2 == pytest.approx(1 - ((y - fit(x)) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert ML.polynomial_fits(df.limit(0), "x", "y", [1]) == []
    a = rng.normal(size=(50, 3))
    a[:, 2] = a[:, 0] + a[:, 1]
    b = ML.eliminate(a.T @ a, a.T @ y[:50])
    assert b[2] == 0 and np.allclose(a @ b, a @ np.linalg.lstsq(a, y[:50], rcond=None)[0])


def test_linear_fit_with_levels(spark):
    rng = np.random.default_rng(3)
    rows = [(float(rng.uniform(5, 9)), str(rng.choice(["u", "v", "w"])), None) for _ in range(200)]
    rows = [(a, c, 2 * a + {"u": 0, "v": 5, "w": -3}[c]) for a, c, _ in rows]
    df = spark.createDataFrame(rows + [(None, "u", 1.0), (6.0, None, 1.0)], "a double, c string, y double")
    fitted = ML.linear_fit(df, ["a"], ["c"], "y")
    new = spark.createDataFrame([(5.0, "w"), (20.0, "v"), (6.0, "unknown")], "a double, c string")
    assert [r["p"] for r in new.select(fitted.alias("p")).collect()] == pytest.approx([7.0, 45.0, 12.0])


# ---- AG-8 --------------------------------------------------------------------------

def test_correlations_with_nulls_in_blocks(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 7)) + 1e6
    x[:, 3] = x[:, 0] * 2 + rng.normal(size=300)
    x[:, 5] = 4.0  # no variance
    x[rng.random(x.shape) < 0.2] = np.nan
    cols = [f"c{i}" for i in range(7)]
    rows = [[None if math.isnan(v) else float(v) for v in r] for r in x]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(5)
    want = pd.DataFrame(x, columns=cols).corr()
    for block in (2, 3, 256):
        got = {(r[0], r[1]): r[2] for r in FE.correlation_long(df, cols, block).collect()}
        assert len(got) == 49
        for (a, b), r in got.items():
            assert r == 1.0 if a == b else (r is None and "c5" in (a, b)) or r == pytest.approx(want.loc[a, b], abs=1e-6)


def test_two_thousand_columns(spark):
    p = 2000
    cols = [f"c{i}" for i in range(p)]
    df = spark.range(300).select(*[(F.xxhash64("id", F.lit(i % 1500)) % 1000 / 10.0).alias(c) for i, c in enumerate(cols)])
    top = FE.correlation_long(df, cols)
    assert top.filter("abs(corr) > 0.9999").count() == p + 2 * 500  # the columns that repeat, and the diagonal


def test_best_setting_is_refitted_on_all_rows(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import ParamGridBuilder
    rng = np.random.default_rng(5)
    x = rng.normal(size=(120, 3))
    y = (x[:, 0] > 0).astype(int)
    df = ML.array_features(labelled(spark, x, y), "v").withColumnRenamed("y", "label").withColumn("fold", (F.col("id") % 3).cast("int")).cache()
    lr = ML.classifier("logistic", maxIter=50)
    grid = ParamGridBuilder().addGrid(lr.regParam, [10.0, 0.01]).addGrid(lr.elasticNetParam, [1.0]).build()
    cv = ML.cross_validate(lr, grid, MulticlassClassificationEvaluator(metricName="accuracy"), df, fold_col="fold", folds=3)
    assert cv.avgMetrics[1] > cv.avgMetrics[0]
    again = lr.copy(grid[1]).fit(df)
    assert np.allclose(cv.bestModel.coefficients.toArray(), again.coefficients.toArray())
    got = cv.bestModel.transform(df).select("label", "prediction").collect()
    assert np.mean([r["label"] == r["prediction"] for r in got]) > 0.95
    df.unpersist()
