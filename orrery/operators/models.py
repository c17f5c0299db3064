"""Model fitting, scoring and model choice (ML-1..11, ML-18..21, SNK-3).

Models are ``pyspark.ml`` estimators: their training passes are
distributed tree-aggregates over the cached feature frame.  Closed-form and
iterative line fits reduce the data to sufficient statistics in one pass.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import os
import random
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# ------------------------------------------------------------- ML-1/2 --

def line_fit(df: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """ML-1: least-squares slope, intercept and R^2 (per group)."""
    ys, xs = F.col(y), F.col(x)
    aggs = [F.regr_slope(ys, xs).alias("slope"), F.regr_intercept(ys, xs).alias("intercept"),
            F.regr_r2(ys, xs).alias("r2"), F.count(F.lit(1)).alias("n")]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def gradient_descent_line(df: DataFrame, x: str, y: str, alpha: float = 0.01,
                          iterations: int = 1000) -> DataFrame:
    """ML-2: batch gradient descent for y = t1 * x + t0 from (0, 0) with
    simultaneous updates.  The gradient only needs n, sum x, sum y, sum x^2
    and sum xy, so the data is read once; the iterations run inside one
    ``aggregate`` expression over those five numbers."""
    xs, ys = F.col(x), F.col(y)
    stats = df.agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum(xs).alias("sx"), F.sum(ys).alias("sy"),
                   F.sum(xs * xs).alias("sxx"), F.sum(xs * ys).alias("sxy"))
    a = F.lit(float(alpha))

    def step(acc, _):
        t0, t1 = acc["t0"], acc["t1"]
        e0 = (F.col("n") * t0 + t1 * F.col("sx") - F.col("sy")) / F.col("n")
        e1 = (t0 * F.col("sx") + t1 * F.col("sxx") - F.col("sxy")) / F.col("n")
        return F.struct((t0 - a * e0).alias("t0"), (t1 - a * e1).alias("t1"))

    init = F.struct(F.lit(0.0).alias("t0"), F.lit(0.0).alias("t1"))
    res = F.aggregate(F.sequence(F.lit(1), F.lit(iterations)), init, step)
    return stats.select(res["t1"].alias("slope"), res["t0"].alias("intercept"))


# ----------------------------------------------------------- ML-3/4 --

def eliminate(gram: np.ndarray, right: np.ndarray, tolerance: float = 1e-12) -> np.ndarray:
    """Solution of the normal equations by elimination.  A column that depends
    on those before it (its pivot has vanished) gets coefficient 0."""
    g, n = np.column_stack([gram, right]).astype(float), len(right)
    size, used = np.diag(gram).copy(), []
    for i in range(n):
        if g[i, i] <= tolerance * max(size[i], 1e-300):
            continue
        g[i] /= g[i, i]
        for r in range(n):
            if r != i:
                g[r] -= g[r, i] * g[i]
        used.append(i)
    out = np.zeros(n)
    out[used] = g[used, n]
    return out


def normal_equations(df: DataFrame, xs: Sequence[Column], y: Column):
    """X'X, X'y and y'y of the design columns ``xs``, in one aggregate whose
    partial sums merge on the executors; (p + 1)^2 / 2 numbers come back."""
    cols = [*xs, y]
    pairs = list(itertools.combinations_with_replacement(range(len(cols)), 2))
    names = [f"d{i}" for i in range(len(cols))]
    d = df.select(*[c.cast("double").alias(n) for n, c in zip(names, cols)])
    row = d.agg(*[F.sum(F.col(names[i]) * F.col(names[j])).alias(f"s{i}_{j}") for i, j in pairs]).first()
    full = np.zeros((len(cols), len(cols)))
    for i, j in pairs:
        full[i, j] = full[j, i] = row[f"s{i}_{j}"] or 0.0
    return full[:-1, :-1], full[:-1, -1], full[-1, -1]


def polynomial_fits(df: DataFrame, x: str, y: str, degrees: Sequence[int]) -> list[tuple]:
    """ML-3: polynomial least squares for several degrees from the same sums:
    (degree, coefficients highest power first and intercept last, R^2).

    The sums are those of powers of (x - mean) / deviation, which keeps the
    equations well conditioned; the coefficients are expanded afterwards."""
    d = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).filter("x is not null and y is not null")
    m = d.agg(F.avg("x").alias("x"), F.stddev_pop("x").alias("s"), F.avg("y").alias("y")).first()
    if m["x"] is None:
        return []
    s, top = m["s"] or 1.0, max(degrees)
    z, c = (F.col("x") - m["x"]) / s, F.col("y") - m["y"]
    sums = d.select(z.alias("z"), c.alias("c")).agg(
        *[F.sum(F.pow("z", F.lit(float(k)))).alias(f"z{k}") for k in range(2 * top + 1)],
        *[F.sum(F.pow("z", F.lit(float(k))) * F.col("c")).alias(f"c{k}") for k in range(top + 1)], F.sum(F.col("c") * F.col("c")).alias("cc")).first()
    out = []
    for n in degrees:
        gram = np.array([[sums[f"z{i + j}"] for j in range(n + 1)] for i in range(n + 1)])
        right = np.array([sums[f"c{k}"] for k in range(n + 1)])
        b = eliminate(gram, right)
        coef = np.zeros(n + 1)
        for k in range(n + 1):
            for j in range(k + 1):
                coef[j] += b[k] * math.comb(k, j) * (-m["x"]) ** (k - j) / s ** k
        coef[0] += m["y"]
        r2 = float(b @ right / sums["cc"]) if sums["cc"] else 1.0
        out.append((n, [float(v) for v in coef[::-1]], r2))
    return out


def linear_fit(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str):
    """ML-4: min-max scaled numeric inputs and one-hot levels (the first in
    order is the reference; an unknown level is taken as it) -> linear least
    squares by the normal equations.  Returns the prediction as an expression
    over the same columns.  Rows with a null among them are not fitted."""
    d = df.dropna(subset=[*numeric, *categorical, label])
    ends = d.agg(*[f(c).alias(f"{n}_{i}") for i, c in enumerate(numeric) for n, f in (("lo", F.min), ("hi", F.max))],
                 *[F.sort_array(F.collect_set(c)).alias(f"levels_{i}") for i, c in enumerate(categorical)]).first()
    xs = [F.lit(1.0)]
    for i, c in enumerate(numeric):
        lo, hi = float(ends[f"lo_{i}"] or 0), float(ends[f"hi_{i}"] or 0)
        xs.append((F.col(c).cast("double") - lo) / (hi - lo) if hi > lo else F.lit(0.0))
    for i, c in enumerate(categorical):
        xs += [F.when(F.col(c) == level, 1.0).otherwise(0.0) for level in ends[f"levels_{i}"][1:]]
    gram, right, _ = normal_equations(d, xs, F.col(label))
    b = [float(v) for v in eliminate(gram, right)]
    return sum([x * v for x, v in zip(xs[1:], b[1:])], F.lit(b[0]))


# ------------------------------------------------------------ ML-5..11 --

def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(df)


def array_features(df: DataFrame, arr: str, out: str = "features") -> DataFrame:
    from pyspark.ml.functions import array_to_vector
    return df.withColumn(out, array_to_vector(F.col(arr).cast("array<double>")))


def fit_threads(wanted: int) -> int:
    """How many models may be fitted at once from driver threads.

    Parallel fits (``OneVsRest``, ``CrossValidator``) run on Python threads
    that inherit the session's local properties.  Unless
    ``spark.localProperties.clone`` is on, a child thread sees the parent's
    properties live, and a query id removed in between makes a job fail
    ("Cannot parse null string").  Without the setting, fits run one by one."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    if spark is None:
        return 1
    clone = spark.sparkContext.getConf().get("spark.localProperties.clone", "false")
    return wanted if str(clone).lower() == "true" else 1


def classifier(kind: str, n_train: int | None = None, seed: int = 7, **kw):
    """Classifier stage by name, with the library-like defaults spelled out:
    logistic regression has an L2 penalty equal to C = 1 (lambda = 1 / n),
    trees and forests take explicit depths, boosting goes one-vs-rest so
    more than two classes work."""
    from pyspark.ml import classification as C
    if kind == "logistic":
        reg = kw.pop("regParam", 1.0 / n_train if n_train else 0.0)
        return C.LogisticRegression(maxIter=kw.pop("maxIter", 1000), regParam=reg, elasticNetParam=0.0,
                                    family=kw.pop("family", "auto"), **kw)
    if kind == "tree":
        return C.DecisionTreeClassifier(seed=seed, maxDepth=kw.pop("maxDepth", 10), **kw)
    if kind == "forest":
        return C.RandomForestClassifier(seed=seed, numTrees=kw.pop("numTrees", 20),
                                        maxDepth=kw.pop("maxDepth", 10), **kw)
    if kind == "gbt":
        base = C.GBTClassifier(seed=seed, maxIter=kw.pop("maxIter", 10), maxDepth=kw.pop("maxDepth", 3),
                               stepSize=kw.pop("stepSize", 0.1), subsamplingRate=kw.pop("subsamplingRate", 1.0), **kw)
        return C.OneVsRest(classifier=base, parallelism=fit_threads(8))
    if kind == "mlp":
        return C.MultilayerPerceptronClassifier(seed=seed, layers=kw.pop("layers"), maxIter=kw.pop("maxIter", 200),
                                                blockSize=kw.pop("blockSize", 128), **kw)
    if kind == "svm":
        return C.OneVsRest(classifier=C.LinearSVC(regParam=kw.pop("regParam", 0.01),
                                                  maxIter=kw.pop("maxIter", 100), **kw),
                           parallelism=fit_threads(8))
    raise ValueError(kind)


def random_fourier_features(df: DataFrame, vec_arr: str, dim: int, n_features: int, gamma: float,
                            seed: int = 0, out: str = "rff") -> DataFrame:
    """ML-11: RBF kernel approximation z(x) = sqrt(2/D) cos(W x + b) with
    W ~ N(0, 2 gamma), b ~ U(0, 2 pi) (Rahimi and Recht, 2007).  W is a
    seeded D x d matrix of fixed size (not data-sized) shipped with the
    function; rows are mapped in Arrow batches with one matrix product."""
    rng = np.random.default_rng(seed)
    W = rng.normal(0.0, np.sqrt(2 * gamma), size=(n_features, dim))
    b = rng.uniform(0, 2 * np.pi, size=n_features)
    scale = float(np.sqrt(2.0 / n_features))

    @F.pandas_udf("array<double>")
    def rff(v: pd.Series) -> pd.Series:
        if len(v) == 0:
            return pd.Series([], dtype=object)
        X = np.vstack(v.to_numpy()).astype(np.float64)
        Z = scale * np.cos(X @ W.T + b)
        return pd.Series(list(Z))

    return df.withColumn(out, rff(F.col(vec_arr).cast("array<double>")))


# --------------------------------------------------------- ML-18..21 --

def cross_validate(estimator, grid, evaluator, df: DataFrame, fold_col: str | None = None,
                   folds: int = 5, parallelism: int = 4, seed: int = 0):
    """ML-18: grid search with k-fold cross-validation; the best setting is
    refit on all rows.  With ``fold_col`` the folds are the given
    (stratified) assignment instead of random ones."""
    from pyspark.ml.tuning import CrossValidator
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator,
                        parallelism=fit_threads(parallelism), seed=seed)
    cv = cv.setNumFolds(folds)
    if fold_col:
        cv = cv.setFoldCol(fold_col)
    return cv.fit(df)


def sample_grid(grid: list, n_iter: int, seed: int = 0) -> list:
    """ML-19: a seeded sample of ``n_iter`` settings out of a full grid."""
    if n_iter >= len(grid):
        return list(grid)
    rnd = random.Random(seed)
    return [grid[i] for i in sorted(rnd.sample(range(len(grid)), n_iter))]


def _settings(stage) -> str:
    """A stage's class and parameters, stages inside it included, without
    the random names of instances."""
    def shown(v):
        return _settings(v) if hasattr(v, "extractParamMap") else [shown(x) for x in v] if isinstance(v, (list, tuple)) else repr(v)
    params = {p.name: shown(v) for p, v in stage.extractParamMap().items()}
    own = {k: v for k, v in params.items() if stage.uid not in str(v)}  # columns named after the instance
    return f"{type(stage).__name__}{sorted(own.items())}"


def training_digest(pipeline, df: DataFrame) -> str:
    """Digest of a pipeline's settings and of the rows it is fitted on, in
    any order and partitioning: one pass of row hashes."""
    h = F.xxhash64(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns])
    row = df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.sum(F.pmod(h, F.lit(1_000_003))).alias("s")).first()
    return hashlib.sha256(f"{_settings(pipeline)} {df.schema.simpleString()} {tuple(row)}".encode()).hexdigest()[:32]


def fit_or_load(pipeline, df: DataFrame, path: str):
    """SNK-3: the ``PipelineModel`` saved under ``path`` for these settings
    and these training rows, if there is one; else fit and save it.  ``path``
    should be on shared storage; each digest has a folder of its own."""
    from pyspark.ml import PipelineModel
    path = f"{path}/{training_digest(pipeline, df)}"
    jvm_fs = df.sparkSession._jvm.org.apache.hadoop.fs
    hpath = jvm_fs.Path(path)
    fs = hpath.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    if fs.exists(jvm_fs.Path(path + "/metadata")):
        return PipelineModel.load(path), True
    model = pipeline.fit(df)
    model.write().overwrite().save(path)
    return model, False
