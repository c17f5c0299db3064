"""Model queries.

Closed-form fits have oracle SQL; trained classifiers are checked by
properties (row counts, label domain, accuracy bounds) in the tests."""

from __future__ import annotations

import hashlib
import math
import os

from pyspark.sql import functions as F

from orrery.operators import metrics as M
from orrery.operators import models as ML
from orrery.operators import relational as rel
from orrery.operators import splits as SP
from orrery.operators import trees as TR
from orrery.plans.registry import query
from orrery.session import cut_lineage, ensure_checkpoint_dir
from orrery.sources.tables import table


def R(c, d: int = 6):
    return F.round(F.col(c) if isinstance(c, str) else c, d)


# ------------------------------------------------------------ ML-1..3 --

@query("ml1_linear_regression_model", """
SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept,
       round(regr_r2(l_extendedprice, l_quantity), 6) AS r2
FROM lineitem
""")
def ml1b(spark, sf):
    """The same line as ``ml1_linefit_by_flag`` for the whole table, fitted
    with the ML estimator (normal equations) instead of SQL aggregates."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    li = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice")
    d = VectorAssembler(inputCols=["l_quantity"], outputCol="f").transform(li)
    m = LinearRegression(featuresCol="f", labelCol="l_extendedprice", solver="normal").fit(d)
    return spark.createDataFrame(
        [(round(float(m.coefficients[0]), 4), round(float(m.intercept), 2), round(float(m.summary.r2), 6))],
        "slope double, intercept double, r2 double")


@query("ml2_gradient_descent_line", """
WITH RECURSIVE s AS (
  SELECT CAST(count(*) AS DOUBLE) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy
  FROM (SELECT l_discount * 100 AS x, l_quantity / 5 AS y FROM lineitem) t),
gd(i, t0, t1) AS (
  SELECT 0, CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE)
  UNION ALL
  SELECT i + 1, t0 - 0.02 * ((n * t0 + t1 * sx - sy) / n), t1 - 0.02 * ((t0 * sx + t1 * sxx - sxy) / n)
  FROM gd, s WHERE i < 1000)
SELECT round(t1, 6) AS slope, round(t0, 6) AS intercept FROM gd WHERE i = 1000
""")
def ml2(spark, sf):
    """Gradient descent (alpha 0.02, 1000 steps, start 0) for quantity / 5
    against discount in percent: one data pass, iterations in-plan."""
    li = table(spark, sf, "lineitem").select((F.col("l_discount") * 100).alias("x"),
                                             (F.col("l_quantity") / 5).alias("y"))
    g = ML.gradient_descent_line(li, "x", "y", alpha=0.02, iterations=1000)
    return g.select(R("slope").alias("slope"), R("intercept").alias("intercept"))


def _eliminate_sql(src: str, p: int, name: str) -> str:
    """CTEs that solve the p equations in the list of rows ``m`` (p + 1
    numbers each) of ``src``; the last one, ``name``, keeps all its columns."""
    out, last = [], src
    for i in range(1, p + 1):
        step = f"{name}{i}" if i < p else name
        out.append(f"""{step} AS (SELECT * REPLACE (list_transform(range(1, {p} + 1), lambda r: CASE WHEN r = {i}
  THEN list_transform(m[{i}], lambda x: x / m[{i}][{i}])
  ELSE list_transform(range(1, {p} + 2), lambda c: m[r][c] - m[r][{i}] * m[{i}][c] / m[{i}][{i}]) END) AS m) FROM {last})""")
        last = step
    return ", ".join(out)


def _polynomial_sql(n: int) -> str:
    rows = ", ".join("[" + ", ".join([f"z{i + j}" for j in range(n + 1)] + [f"c{i}"]) + "]" for i in range(n + 1))
    b = lambda k: f"m[{k + 1}][{n + 2}]"
    coef = [" + ".join(f"{b(k)} * {math.comb(k, j)} * pow(-mx, {k - j}) / pow(sx, {k})" for k in range(j, n + 1)) for j in range(n, -1, -1)]
    coef[-1] += " + my"
    r2 = " + ".join(f"{b(k)} * c{k}" for k in range(n + 1))
    return f"""SELECT {n} AS degree, [{', '.join(f'round({c}, 6)' for c in coef)}] AS coefficients, round(({r2}) / cc, 6) AS r2
FROM (WITH s0 AS (SELECT *, [{rows}] AS m FROM s), {_eliminate_sql('s0', n + 1, 'g')} SELECT * FROM g) q"""


@query("ml3_polynomial_regression", f"""
WITH d AS (SELECT l_quantity / 10 AS x, l_extendedprice / 1000 AS y FROM lineitem),
k AS (SELECT avg(x) AS mx, stddev_pop(x) AS sx, avg(y) AS my FROM d),
z AS (SELECT (x - mx) / sx AS z, y - my AS c FROM d, k),
s AS (SELECT any_value(mx) AS mx, any_value(sx) AS sx, any_value(my) AS my, sum(c * c) AS cc,
      {', '.join(f'sum(pow(z, {i})) AS z{i}' for i in range(9))}, {', '.join(f'sum(pow(z, {i}) * c) AS c{i}' for i in range(5))} FROM z, k)
{' UNION ALL '.join(_polynomial_sql(n) for n in (1, 2, 3, 4))}
""")
def ml3(spark, sf):
    """Polynomial least squares of price (thousands) on quantity (tens),
    degrees 1-4 from one set of sums: coefficients (highest power first) and
    R^2."""
    li = table(spark, sf, "lineitem").select((F.col("l_quantity") / 10).alias("x"),
                                             (F.col("l_extendedprice") / 1000).alias("y"))
    rows = [(d, [round(c, 6) for c in coef], round(r2, 6)) for d, coef, r2 in ML.polynomial_fits(li, "x", "y", (1, 2, 3, 4))]
    return spark.createDataFrame(rows, "degree int, coefficients array<double>, r2 double")


# -------------------------------------------------------------- ML-4 --

def _li_split(spark, sf):
    li = table(spark, sf, "lineitem")
    is_test = rel.hash_order("l_orderkey", 3) % 5 == 0
    return li.filter(~is_test), li.filter(is_test)


_DESIGN = ["1.0", *[f"(CAST({c} AS DOUBLE) - lo_{c}) / (hi_{c} - lo_{c})" for c in ("l_quantity", "l_discount", "l_tax")],
           "CASE WHEN l_returnflag = 'N' THEN 1.0 ELSE 0.0 END", "CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END",
           "CASE WHEN l_linestatus = 'O' THEN 1.0 ELSE 0.0 END"]


@query("ml4_multi_feature_regression", f"""
WITH tr AS (SELECT * FROM lineitem WHERE NOT ({rel.hash_order_sql('l_orderkey', 3)} % 5 = 0)),
te AS (SELECT * FROM lineitem WHERE {rel.hash_order_sql('l_orderkey', 3)} % 5 = 0),
mm AS (SELECT {', '.join(f'CAST(min({c}) AS DOUBLE) AS lo_{c}, CAST(max({c}) AS DOUBLE) AS hi_{c}' for c in ('l_quantity', 'l_discount', 'l_tax'))} FROM tr),
d AS (SELECT {', '.join(f'CAST({x} AS DOUBLE) AS x{i}' for i, x in enumerate(_DESIGN))}, CAST(l_extendedprice AS DOUBLE) AS y FROM tr, mm),
s AS (SELECT [{', '.join('[' + ', '.join([f'sum(x{i} * x{j})' for j in range(7)] + [f'sum(x{i} * y)']) + ']' for i in range(7))}] AS m FROM d),
{_eliminate_sql('s', 7, 'g')}
SELECT l_orderkey, l_linenumber, l_extendedprice, round({' + '.join(f'g.m[{i + 1}][8] * ({x})' for i, x in enumerate(_DESIGN))}, 4) AS prediction
FROM te, mm, g
""")
def ml4(spark, sf):
    """Scaled numeric + one-hot categorical inputs -> linear regression of
    the price; predictions for the held-out rows."""
    train, test = _li_split(spark, sf)
    fitted = ML.linear_fit(train, ["l_quantity", "l_discount", "l_tax"], ["l_returnflag", "l_linestatus"], "l_extendedprice")
    return test.select("l_orderkey", "l_linenumber", "l_extendedprice", R(fitted, 4).alias("prediction"))


# ------------------------------------------------------------ ML-5..11 --

def _emb(spark, sf):
    e = table(spark, sf, "embeddings")
    e = ML.array_features(e, "embedding")
    is_test = rel.hash_order("vec_id", 11) % 5 == 0
    return e.filter(~is_test), e.filter(is_test)


def _predict(model, test, key="vec_id"):
    return model.transform(test).select(key, "label", F.col("prediction").cast("int").alias("prediction"))


@query("ml5_logistic_multinomial")
def ml5(spark, sf):
    train, test = _emb(spark, sf)
    n = train.count()
    m = ML.classifier("logistic", n_train=n, family="multinomial").fit(train)
    return _predict(m, test)


@query("ml5_logistic_binary")
def ml5b(spark, sf):
    """Binary quality from document length and language (one-hot)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
    lab = table(spark, sf, "labels")
    d = table(spark, sf, "documents").select("doc_id", "lang", F.log1p("n_chars").alias("log_chars"))
    df = lab.join(d, "doc_id").withColumnRenamed("quality", "label")
    is_test = rel.hash_order("doc_id", 13) % 5 == 0
    train, test = df.filter(~is_test), df.filter(is_test)
    pipe = Pipeline(stages=[
        StringIndexer(inputCol="lang", outputCol="lang_i", handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCol="lang_i", outputCol="lang_v"),
        VectorAssembler(inputCols=["log_chars", "lang_v"], outputCol="features"),
        ML.classifier("logistic", n_train=train.count())])
    m = pipe.fit(train)
    return m.transform(test).select("doc_id", "label", F.col("prediction").cast("int").alias("prediction"))


@query("ml6_decision_tree")
def ml6(spark, sf):
    train, test = _emb(spark, sf)
    return _predict(ML.classifier("tree", maxDepth=6, minInstancesPerNode=2).fit(train), test)


_CLASSES = range(10)


def _level_sql(k: int) -> str:
    """CTEs of one level of the exact tree: from r{k} (id, label, v, node) the
    best split b{k} of every node and the rows r{k+1} with their new nodes."""
    c = lambda p, s=", ": s.join(f"{p}{i}" for i in _CLASSES)
    left = " + ".join(f"l{i} * l{i}" for i in _CLASSES)
    right = " + ".join(f"(t{i} - l{i}) * (t{i} - l{i})" for i in _CLASSES)
    return f"""
u{k} AS (SELECT node, label, unnest(range(1, len(v) + 1)) AS f, unnest(v) AS x FROM r{k}),
c{k} AS (SELECT node, f, x, {', '.join(f'count(*) FILTER (WHERE label = {i}) AS c{i}' for i in _CLASSES)} FROM u{k} GROUP BY node, f, x),
w{k} AS (SELECT node, f, x, lead(x) OVER o AS nx, {', '.join(f'CAST(sum(c{i}) OVER o AS BIGINT) AS l{i}' for i in _CLASSES)},
               {', '.join(f'CAST(sum(c{i}) OVER (PARTITION BY node, f) AS BIGINT) AS t{i}' for i in _CLASSES)}
        FROM c{k} WINDOW o AS (PARTITION BY node, f ORDER BY x)),
s{k} AS (SELECT node, f, CASE WHEN x / 2 + nx / 2 < nx THEN x / 2 + nx / 2 ELSE x END AS thr,
               CAST({left} AS DOUBLE) / ({c('l', ' + ')}) + CAST({right} AS DOUBLE) / ({c('t', ' + ')} - ({c('l', ' + ')})) AS g
        FROM w{k} WHERE nx IS NOT NULL AND greatest({c('t')}) < {c('t', ' + ')}),
b{k} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY g DESC, f, thr) AS n FROM s{k}) z WHERE n = 1),
r{k + 1} AS (SELECT r.vec_id, r.label, r.v, CASE WHEN b.f IS NULL THEN r.node WHEN r.v[b.f] <= b.thr THEN 2 * r.node ELSE 2 * r.node + 1 END AS node
        FROM r{k} r LEFT JOIN b{k} b ON b.node = r.node)"""


_E_TEST = rel.hash_order_sql("vec_id", 11) + " % 5 = 0"


@query("ml6_exact_tree", f"""
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
r0 AS (SELECT *, 1 AS node FROM e WHERE NOT ({_E_TEST})), {_level_sql(0)}, {_level_sql(1)},
leaf AS (SELECT node, label FROM (SELECT node, label, row_number() OVER (PARTITION BY node ORDER BY count(*) DESC, label) AS n
         FROM r2 GROUP BY node, label) z WHERE n = 1),
t AS (SELECT e.*, b0.f AS f0, b0.thr AS h0 FROM e LEFT JOIN b0 ON true WHERE {_E_TEST}),
t1 AS (SELECT *, CASE WHEN f0 IS NULL THEN 1 WHEN v[f0] <= h0 THEN 2 ELSE 3 END AS node1 FROM t),
t2 AS (SELECT t1.*, CASE WHEN b1.f IS NULL THEN node1 WHEN v[b1.f] <= b1.thr THEN 2 * node1 ELSE 2 * node1 + 1 END AS node
       FROM t1 LEFT JOIN b1 ON b1.node = node1)
SELECT t2.vec_id, t2.label, CAST(t2.node AS BIGINT) AS node, leaf.label AS prediction FROM t2 JOIN leaf ON leaf.node = t2.node
""")
def ml6b(spark, sf):
    """Classification tree of depth 2 that tries every distinct value as a
    threshold; leaf and prediction of the held-out rows."""
    e = table(spark, sf, "embeddings")
    is_test = rel.hash_order("vec_id", 11) % 5 == 0
    tree = TR.exact_tree(e.filter(~is_test), "embedding", "label", max_depth=2)
    return e.filter(is_test).select("vec_id", "label", tree.node("embedding").alias("node"),
                                    tree.predict("embedding").alias("prediction"))


@query("ml7_random_forest")
def ml7(spark, sf):
    train, test = _emb(spark, sf)
    return _predict(ML.classifier("forest", numTrees=20, maxDepth=10).fit(train), test)


@query("ml8_gbt_one_vs_rest")
def ml8(spark, sf):
    """Boosted trees on a 3-class target through one-vs-rest."""
    train, test = _emb(spark, sf)
    tr = train.withColumn("label", (F.col("label") % 3).cast("double"))
    te = test.withColumn("label", F.col("label") % 3)
    return _predict(ML.classifier("gbt", maxIter=10, maxDepth=3).fit(tr), te)


@query("ml8_multinomial_boosting")
def ml8b(spark, sf):
    """Multinomial boosting on all classes of the label: K trees a round on
    the softmax residuals."""
    e = table(spark, sf, "embeddings")
    is_test = rel.hash_order("vec_id", 11) % 5 == 0
    model = TR.boost(e.filter(~is_test), "embedding", "label", rounds=8, max_depth=2, rate=0.1)
    return model.predict(e.filter(is_test), "embedding").select("vec_id", "label", "prediction")


@query("ml9_multilayer_perceptron")
def ml9(spark, sf):
    train, test = _emb(spark, sf)
    return _predict(ML.classifier("mlp", layers=[64, 32, 10], maxIter=100).fit(train), test)


@query("ml10_linear_svm")
def ml10(spark, sf):
    train, test = _emb(spark, sf)
    return _predict(ML.classifier("svm", regParam=0.01, maxIter=30).fit(train), test)


@query("ml11_rbf_svm_random_features")
def ml11(spark, sf):
    """RBF-kernel SVM approximated by 128 random Fourier features + a linear
    SVM (one-vs-rest)."""
    e = table(spark, sf, "embeddings")
    e = ML.random_fourier_features(e, "embedding", 64, 128, gamma=1.0, seed=3)
    # eight classes are fitted at a time: few partitions keep the cores busy, and each step of a fit one stage
    e = _few_parts(ML.array_features(e, "rff").select("vec_id", "label", "features"), 65_536)
    is_test = rel.hash_order("vec_id", 11) % 5 == 0
    m = ML.classifier("svm", regParam=0.001, maxIter=30).fit(e.filter(~is_test))
    return _predict(m, e.filter(is_test))


@query("fe13_feature_importance")
def fe13(spark, sf):
    """Forest feature importances of the 64 embedding dimensions, desc."""
    from orrery.operators.features import feature_importances
    train, _ = _emb(spark, sf)
    m = ML.classifier("forest", numTrees=20, maxDepth=6).fit(train)
    rows = feature_importances(m, [f"e{i}" for i in range(m.numFeatures)])
    return spark.createDataFrame(rows, "feature string, importance double")


# ----------------------------------------------------------- ML-18..21 --

def _folded(spark, sf, k=5):
    e = table(spark, sf, "embeddings")
    e = ML.array_features(e, "embedding")
    return SP.stratified_folds(e, "vec_id", "label", k, seed=2)


def _few_parts(df, rows_per_part: int = 20_000):
    """The fold frame written once, in as many partitions as its rows need:
    every iteration of a fit is a job over all of them."""
    t = cut_lineage(df)
    return t.coalesce(max(1, math.ceil(t.count() / rows_per_part)))


def _grid_search(df):
    """(grid, estimator, fitted search): 6 logistic settings, 5 stratified folds, accuracy."""
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import ParamGridBuilder
    lr = ML.classifier("logistic", maxIter=50, regParam=0.01)
    grid = (ParamGridBuilder().addGrid(lr.regParam, [0.001, 0.01, 0.1])
            .addGrid(lr.elasticNetParam, [0.0, 0.5]).build())
    ev = MulticlassClassificationEvaluator(metricName="accuracy")
    return grid, lr, ML.cross_validate(lr, grid, ev, df, fold_col="fold", folds=5, parallelism=8)


@query("ml18_grid_search_refit")
def ml18b(spark, sf):
    """The best setting of the grid search refitted on all training rows, and
    its predictions for the held-out rows."""
    train = rel.hash_order("vec_id", 11) % 5 != 0
    folded = _folded(spark, sf)
    _, _, cv = _grid_search(_few_parts(folded.filter(train)))
    return _predict(cv.bestModel, folded.filter(~train))


@query("ml18_grid_search_cv")
def ml18(spark, sf):
    """Grid search, 5 stratified folds, accuracy; settings ranked (WIN-4)."""
    grid, lr, cv = _grid_search(_few_parts(_folded(spark, sf)))
    rows = [(float(pm[lr.regParam]), float(pm[lr.elasticNetParam]), float(s))
            for pm, s in zip(grid, cv.avgMetrics)]
    res = spark.createDataFrame(rows, "reg_param double, elastic_net double, mean_score double")
    return M.rank_desc(res, "mean_score")


@query("ml19_random_search_cv")
def ml19(spark, sf):
    """Randomised search: 3 seeded settings of a 3 x 3 forest grid, 2 folds."""
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import ParamGridBuilder
    df = _few_parts(_folded(spark, sf, 2))
    rf = ML.classifier("forest")
    full = ParamGridBuilder().addGrid(rf.numTrees, [5, 10, 20]).addGrid(rf.maxDepth, [3, 5, 8]).build()
    grid = ML.sample_grid(full, 3, seed=0)
    ev = MulticlassClassificationEvaluator(metricName="accuracy")
    cv = ML.cross_validate(rf, grid, ev, df, fold_col="fold", folds=2)
    rows = [(int(pm[rf.numTrees]), int(pm[rf.maxDepth]), float(s)) for pm, s in zip(grid, cv.avgMetrics)]
    return M.rank_desc(spark.createDataFrame(rows, "num_trees int, max_depth int, mean_score double"), "mean_score")


_CLASS = "1"  # of ml20's best recall and precision, as classification_report names it


@query("ml20_model_comparison")
def ml20(spark, sf):
    """Several models on one split; per model accuracy, macro recall and
    precision and those of one class from the classification report; best
    by accuracy, by recall and by precision of the class flagged (ties: the
    first model; none if the class never occurs)."""
    train, test = _emb(spark, sf)
    train = _few_parts(train)
    n = train.count()
    models = {"logistic": ML.classifier("logistic", n_train=n, maxIter=200),
              "tree": ML.classifier("tree", maxDepth=6),
              "forest": ML.classifier("forest", numTrees=20, maxDepth=8)}
    frames = []
    for i, (name, est) in enumerate(models.items()):
        pred = _predict(est.fit(train), test)
        rep = M.classification_report(pred, "label", "prediction", zero_division=0.0)
        frames.append(rep.filter(F.col("class").isin("accuracy", "macro avg", _CLASS))
                      .select(F.lit(name).alias("model"), F.lit(i).alias("ordinal"), "class", "precision", "recall"))
    allr = rel.stack(frames)
    wide = allr.groupBy("model", "ordinal").agg(
        F.max(F.when(F.col("class") == "accuracy", F.col("precision"))).alias("accuracy"),
        F.max(F.when(F.col("class") == "macro avg", F.col("recall"))).alias("macro_recall"),
        F.max(F.when(F.col("class") == "macro avg", F.col("precision"))).alias("macro_precision"),
        F.max(F.when(F.col("class") == _CLASS, F.col("recall"))).alias("class_recall"),
        F.max(F.when(F.col("class") == _CLASS, F.col("precision"))).alias("class_precision"))
    return flag_best(wide)


def flag_best(wide):
    """ML-20: rounded scores of every model, and which is the first best by
    accuracy, by recall and by precision of the class."""
    wide = wide.withColumn("_g", F.lit(1))
    scores = {"accuracy": "is_best", "class_recall": "is_best_recall", "class_precision": "is_best_precision"}
    out = wide
    for score, flag in scores.items():
        best = M.arg_best(wide, ["_g"], "model", score, "ordinal", out="_best")
        out = (out.join(F.broadcast(best), "_g")
                  .withColumn(flag, (F.col("model") == F.col("_best")) & F.col(score).isNotNull()).drop("_best"))
    return out.select("model", R("accuracy").alias("accuracy"), R("macro_recall").alias("macro_recall"),
                      R("macro_precision").alias("macro_precision"), "is_best",
                      F.lit(_CLASS).alias("class"), R("class_recall").alias("class_recall"),
                      R("class_precision").alias("class_precision"), "is_best_recall", "is_best_precision")


def _score_pipeline():
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StandardScaler
    return Pipeline(stages=[StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
                            ML.classifier("logistic", featuresCol="scaled", maxIter=200, regParam=0.01)])


@query("ml21_score_new_rows")
def ml21(spark, sf):
    """Preprocessing and model fitted on training rows only; the held-out
    rows are scored with the fitted PipelineModel (no refit)."""
    train, test = _emb(spark, sf)
    model = _score_pipeline().fit(train)
    return _predict(model, test)


@query("ml21_score_new_rows_stream")
def ml21s(spark, sf):
    """ML-21 as a stream: the held-out rows arrive as Parquet files, the
    pipeline fitted on the training rows scores each micro-batch, and the
    file sink's output is read back."""
    from orrery.sources.files import scratch_path
    from orrery.streaming import scoring as ST
    train, _ = _emb(spark, sf)
    model = _score_pipeline().fit(train)
    e = table(spark, sf, "embeddings")
    incoming = e.filter(rel.hash_order("vec_id", 11) % 5 == 0).select("vec_id", "label", "embedding")
    src = scratch_path(spark, "ml21s-in")
    incoming.write.mode("overwrite").parquet(src)
    rows = ST.read_new_rows(spark, src, incoming.schema)
    scored = ST.score_stream(model, ML.array_features(rows, "embedding"), ["vec_id", "label"])
    out = ST.write_available(scored, scratch_path(spark, "ml21s-out"), scratch_path(spark, "ml21s-ckpt"))
    return spark.read.parquet(out).select("vec_id", "label", F.col("prediction").cast("int").alias("prediction"))


def model_folder(spark) -> str:
    """``spark.orrery.model.dir``, else a folder below the configured
    checkpoint folder, which outlives a session."""
    given = spark.conf.get("spark.orrery.model.dir", None)
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return (given or root.rstrip("/") + "/models").rstrip("/")


@query("snk3_fit_or_load")
def snk3(spark, sf):
    """Fit once and persist in the shared model folder; later calls, in this
    session or another, load the saved model.  Both must predict the same."""
    train, test = _emb(spark, sf)
    path = model_folder(spark) + "/snk3_" + hashlib.md5(sf.encode()).hexdigest()
    m1, _ = ML.fit_or_load(_score_pipeline(), train, path)
    m2, loaded = ML.fit_or_load(_score_pipeline(), train, path)
    a = _predict(m1, test).withColumnRenamed("prediction", "fitted")
    b = _predict(m2, test).select("vec_id", F.col("prediction").alias("reloaded"))
    return a.join(b, "vec_id").withColumn("from_disk", F.lit(loaded))
