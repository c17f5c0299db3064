"""Feature engineering and splitting queries (SURVEY 2.12, AG-8, AG-9,
AG-20)."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.operators import features as FE
from orrery.operators import relational as rel
from orrery.operators import splits as SP
from orrery.plans.registry import query
from orrery.sources.tables import table


def R(c, d: int = 6):
    return F.round(F.col(c) if isinstance(c, str) else c, d)


def H(key: str, seed: int) -> str:
    """SQL twin of ``relational.hash_order``."""
    return rel.hash_order_sql(key, seed)


_NUM = ["l_quantity", "l_extendedprice", "l_discount"]


def _li_split(spark, sf):
    li = table(spark, sf, "lineitem")
    is_test = rel.hash_order("l_orderkey", 3) % 5 == 0
    return li.filter(~is_test), li.filter(is_test)


_TRAIN = f"(SELECT * FROM lineitem WHERE NOT ({H('l_orderkey', 3)} % 5 = 0))"
_TEST = f"(SELECT * FROM lineitem WHERE {H('l_orderkey', 3)} % 5 = 0)"


@query("fe1_minmax_scale", f"""
WITH s AS (SELECT min(l_quantity) a0, max(l_quantity) b0, min(l_extendedprice) a1, max(l_extendedprice) b1,
                  min(l_discount) a2, max(l_discount) b2 FROM {_TRAIN} t)
SELECT l_orderkey, l_linenumber,
       round(CASE WHEN b0 = a0 THEN 0 ELSE (l_quantity - a0) / (b0 - a0) END, 6) AS l_quantity,
       round(CASE WHEN b1 = a1 THEN 0 ELSE (l_extendedprice - a1) / (b1 - a1) END, 6) AS l_extendedprice,
       round(CASE WHEN b2 = a2 THEN 0 ELSE (l_discount - a2) / (b2 - a2) END, 6) AS l_discount
FROM {_TEST} x, s
""")
def fe1(spark, sf):
    """Min-max scaling fitted on the training rows, applied to test rows."""
    train, test = _li_split(spark, sf)
    m = FE.minmax_fit(train, _NUM)
    out = m.transform(test)
    return out.select("l_orderkey", "l_linenumber", *[R(c).alias(c) for c in _NUM])


@query("fe2_standardize", f"""
WITH s AS (SELECT avg(l_quantity) m0, stddev_pop(l_quantity) s0, avg(l_extendedprice) m1,
                  stddev_pop(l_extendedprice) s1, avg(l_discount) m2, stddev_pop(l_discount) s2 FROM {_TRAIN} t)
SELECT l_orderkey, l_linenumber, round((l_quantity - m0) / s0, 6) AS l_quantity,
       round((l_extendedprice - m1) / s1, 6) AS l_extendedprice, round((l_discount - m2) / s2, 6) AS l_discount
FROM {_TEST} x, s
""")
def fe2(spark, sf):
    """Standardisation with the population standard deviation (train)."""
    train, test = _li_split(spark, sf)
    m = FE.standard_fit(train, _NUM)
    return m.transform(test).select("l_orderkey", "l_linenumber", *[R(c).alias(c) for c in _NUM])


_SEGS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("fe3_one_hot", f"""
SELECT c_custkey, {", ".join(f"CAST(c_mktsegment = '{s}' AS INTEGER) AS seg_{s}" for s in _SEGS)}
FROM customer WHERE {H('c_custkey', 5)} % 5 = 0
""")
def fe3(spark, sf):
    """One-hot columns named after the (at most 100) commonest levels of the
    training rows; applied to the test rows (unseen level -> all zeros).
    ``fe3_one_hot_vector`` takes any number of levels."""
    c = table(spark, sf, "customer")
    is_test = rel.hash_order("c_custkey", 5) % 5 == 0
    levels = FE.fit_levels(c.filter(~is_test), "c_mktsegment", 100)
    return c.filter(is_test).select("c_custkey", *FE.one_hot("c_mktsegment", levels, "seg"))


@query("fe3_one_hot_vector", f"""
SELECT c_custkey, [{", ".join(f"CASE WHEN c_mktsegment = '{s}' THEN 1.0 ELSE 0.0 END" for s in _SEGS)}] AS onehot
FROM customer WHERE {H('c_custkey', 5)} % 5 = 0
""")
def fe3b(spark, sf):
    """The same encoding as ML stages (indexer with an unknown slot +
    encoder dropping it) giving a sparse vector, shown as an array."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    c = table(spark, sf, "customer")
    is_test = rel.hash_order("c_custkey", 5) % 5 == 0
    model = Pipeline(stages=FE.one_hot_pipeline("c_mktsegment", "onehot")).fit(c.filter(~is_test))
    out = model.transform(c.filter(is_test))
    return out.select("c_custkey", vector_to_array("onehot").alias("onehot"))


@query("fe4_global_dictionary", f"""
WITH tr AS (SELECT * FROM part WHERE NOT ({H('p_partkey', 9)} % 5 = 0)),
te AS (SELECT * FROM part WHERE {H('p_partkey', 9)} % 5 = 0),
d AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS idx FROM (
        SELECT DISTINCT value FROM (SELECT p_brand AS value FROM tr UNION ALL SELECT p_type FROM tr) u) v),
n AS (SELECT count(*) AS size FROM d),
l AS (SELECT p_partkey, 'p_brand' AS "column", 0 AS col_pos, p_brand AS value FROM te
      UNION ALL SELECT p_partkey, 'p_type', 1, p_type FROM te)
SELECT l.p_partkey, l."column", l.col_pos * n.size + d.idx AS slot FROM l CROSS JOIN n LEFT JOIN d ON l.value = d.value
""")
def fe4(spark, sf):
    """Global value dictionary over p_brand and p_type (train rows); each
    test cell maps to slot column_position x dictionary_size + index."""
    p = table(spark, sf, "part")
    is_test = rel.hash_order("p_partkey", 9) % 5 == 0
    cols = ["p_brand", "p_type"]
    d = FE.global_dictionary(p.filter(~is_test), cols)
    return FE.dictionary_codes(p.filter(is_test), "p_partkey", cols, d)


@query("fe5_target_encoding", f"""
WITH tr AS (SELECT *, CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS y FROM customer WHERE NOT ({H('c_custkey', 5)} % 5 = 0)),
te AS (SELECT * FROM customer WHERE {H('c_custkey', 5)} % 5 = 0),
p AS (SELECT avg(y) AS prior FROM tr),
e AS (SELECT c_mktsegment, (1.0 * (SELECT prior FROM p) + sum(y)) / (1.0 + count(*)) AS enc FROM tr GROUP BY 1)
SELECT te.c_custkey, round(coalesce(e.enc, (SELECT prior FROM p)), 6) AS segment_enc
FROM te LEFT JOIN e ON te.c_mktsegment = e.c_mktsegment
""")
def fe5(spark, sf):
    """Target (mean) encoding with m-estimate smoothing m = 1."""
    c = table(spark, sf, "customer").withColumn("y", (F.col("c_acctbal") > 5000).cast("int"))
    is_test = rel.hash_order("c_custkey", 5) % 5 == 0
    enc, prior = FE.target_encoding_fit(c.filter(~is_test), "c_mktsegment", "y", m=1.0)
    out = FE.target_encoding_apply(c.filter(is_test), "c_mktsegment", enc, prior, "segment_enc")
    return out.select("c_custkey", R("segment_enc").alias("segment_enc"))


@query("fe5_out_of_fold", f"""
WITH c AS (SELECT *, CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS y, {H('c_custkey', 15)} % 4 AS fold FROM customer),
f AS (SELECT DISTINCT fold FROM c),
p AS (SELECT f.fold, avg(c.y) AS prior FROM f JOIN c ON c.fold <> f.fold GROUP BY f.fold),
e AS (SELECT f.fold, c.c_mktsegment, sum(c.y) AS s, count(*) AS n FROM f JOIN c ON c.fold <> f.fold GROUP BY 1, 2)
SELECT c.c_custkey, round(coalesce((p.prior + e.s) / (1.0 + e.n), p.prior), 6) AS segment_enc
FROM c JOIN p ON c.fold = p.fold LEFT JOIN e ON c.fold = e.fold AND c.c_mktsegment = e.c_mktsegment
""")
def fe5b(spark, sf):
    """Target encoding of training rows from the other folds only."""
    c = table(spark, sf, "customer").withColumn("y", (F.col("c_acctbal") > 5000).cast("int"))
    c = c.withColumn("fold", rel.hash_order("c_custkey", 15) % 4)
    return FE.target_encoding_out_of_fold(c, "c_mktsegment", "y", "fold", "segment_enc").select(
        "c_custkey", R("segment_enc").alias("segment_enc"))


_AUTO = """CASE WHEN {n} * {v} + {w} = 0 THEN {p} ELSE ({n} * {v} * {m} + {w} * {p}) / ({n} * {v} + {w}) END"""


@query("fe5_auto_smoothing", f"""
WITH tr AS (SELECT *, CAST(c_acctbal AS DOUBLE) AS y FROM customer WHERE NOT ({H('c_custkey', 5)} % 5 = 0)),
te AS (SELECT * FROM customer WHERE {H('c_custkey', 5)} % 5 = 0),
p AS (SELECT avg(y) AS p, var_pop(y) AS v FROM tr),
l AS (SELECT c_mktsegment, count(*) AS n, avg(y) AS m, var_pop(y) AS w FROM tr GROUP BY 1)
SELECT te.c_custkey, round(CASE WHEN l.n IS NULL THEN p.p ELSE {_AUTO.format(n='l.n', v='p.v', w='l.w', p='p.p', m='l.m')} END, 6) AS segment_enc
FROM te CROSS JOIN p LEFT JOIN l ON l.c_mktsegment = te.c_mktsegment
""")
def fe5c(spark, sf):
    """Target encoding of the balance by segment, smoothing by empirical
    Bayes per level."""
    c = table(spark, sf, "customer").withColumn("y", F.col("c_acctbal").cast("double"))
    is_test = rel.hash_order("c_custkey", 5) % 5 == 0
    out = FE.target_encoding_auto(c.filter(~is_test), c.filter(is_test), "c_mktsegment", "y", "segment_enc")
    return out.select("c_custkey", R("segment_enc").alias("segment_enc"))


@query("fe5_auto_out_of_fold", f"""
WITH c AS (SELECT *, CAST(c_acctbal AS DOUBLE) AS y, {H('c_custkey', 15)} % 4 AS fold FROM customer),
f AS (SELECT DISTINCT fold FROM c),
p AS (SELECT f.fold, avg(c.y) AS p, var_pop(c.y) AS v FROM f JOIN c ON c.fold <> f.fold GROUP BY f.fold),
l AS (SELECT f.fold, c.c_nationkey, count(*) AS n, avg(c.y) AS m, var_pop(c.y) AS w FROM f JOIN c ON c.fold <> f.fold GROUP BY 1, 2)
SELECT c.c_custkey, round(CASE WHEN l.n IS NULL THEN p.p ELSE {_AUTO.format(n='l.n', v='p.v', w='l.w', p='p.p', m='l.m')} END, 6) AS nation_enc
FROM c JOIN p ON c.fold = p.fold LEFT JOIN l ON c.fold = l.fold AND c.c_nationkey = l.c_nationkey
""")
def fe5d(spark, sf):
    """The same for training rows, from the other folds only."""
    c = table(spark, sf, "customer").withColumn("y", F.col("c_acctbal").cast("double"))
    c = c.withColumn("fold", rel.hash_order("c_custkey", 15) % 4)
    return FE.target_encoding_auto_out_of_fold(c, "c_nationkey", "y", "fold", "nation_enc").select(
        "c_custkey", R("nation_enc").alias("nation_enc"))


@query("fe6_polynomial_features", """
SELECT l_orderkey, l_linenumber, 1.0 AS q_0, l_quantity AS q_1, round(pow(l_quantity, 2), 6) AS q_2,
       round(pow(l_quantity, 3), 6) AS q_3
FROM lineitem
""")
def fe6(spark, sf):
    li = table(spark, sf, "lineitem")
    cols = FE.polynomial("l_quantity", 3, include_bias=True, prefix="q")
    out = li.select("l_orderkey", "l_linenumber", *cols)
    return out.select("l_orderkey", "l_linenumber", *[R(f"q_{k}").alias(f"q_{k}") for k in range(4)])


_CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "disc_price"]


def _corr_frame(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(*_CORR_COLS[:5], (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("disc_price"))


def _corr_sql() -> str:
    src = "(SELECT *, l_extendedprice * (1 - l_discount) AS disc_price FROM lineitem)"
    parts = []
    for a in _CORR_COLS:
        for b in _CORR_COLS:
            if a == b:
                parts.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, 1.0 AS corr")
            else:
                parts.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS corr FROM {src} s")
    return "(" + " UNION ALL ".join(parts) + ")"


@query("ag8_correlation_matrix", f"""
SELECT feature_a, feature_b, round(corr, 6) AS corr FROM {_corr_sql()} c
""")
def ag8(spark, sf):
    """Pearson matrix in long form, all pairs from one aggregate pass."""
    c = FE.correlation_long(_corr_frame(spark, sf), _CORR_COLS)
    return c.select("feature_a", "feature_b", R("corr").alias("corr"))


@query("ag9_top_correlated_partners", f"""
SELECT feature_a, feature_b, round(corr, 6) AS corr, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY feature_a ORDER BY corr DESC, feature_b) AS rank FROM {_corr_sql()} c) t
WHERE rank <= 2
""")
def ag9(spark, sf):
    c = FE.correlation_long(_corr_frame(spark, sf), _CORR_COLS)
    t = FE.top_partners(c, 2)
    return t.select("feature_a", "feature_b", R("corr").alias("corr"), "rank")


@query("fe9_corr_prune_second_largest", f"""
SELECT feature_a AS feature FROM (
  SELECT *, row_number() OVER (PARTITION BY feature_a ORDER BY corr DESC, feature_b) AS rank FROM {_corr_sql()} c) t
WHERE rank = 2 AND corr > 0.7
""")
def fe9(spark, sf):
    """Features whose second-largest signed correlation exceeds 0.7."""
    c = FE.correlation_long(_corr_frame(spark, sf), _CORR_COLS)
    return FE.prune_second_largest(c, 0.7)


@query("fe10_corr_prune_greedy", f"""
WITH RECURSIVE n AS (SELECT unnest(range(0, {len(_CORR_COLS)})) AS i, unnest({_CORR_COLS}) AS f),
hit AS (SELECT a.i AS i, b.i AS j FROM {_corr_sql()} c JOIN n a ON a.f = feature_a JOIN n b ON b.f = feature_b
        WHERE a.i < b.i AND abs(corr) > 0.8),
step AS (
  SELECT 0 AS i, CAST([] AS BIGINT[]) AS gone
  UNION ALL
  SELECT i + 1, CASE WHEN list_contains(gone, i) THEN gone
    ELSE list_concat(gone, coalesce((SELECT list(j) FROM hit WHERE hit.i = step.i), CAST([] AS BIGINT[]))) END
  FROM step WHERE i < {len(_CORR_COLS)})
SELECT n.f AS feature, NOT list_contains(s.gone, n.i) AS kept FROM n, (SELECT gone FROM step ORDER BY i DESC LIMIT 1) s
""")
def fe10(spark, sf):
    """Greedy upper-triangle pruning at |corr| > 0.8: (feature, kept)."""
    c = FE.correlation_long(_corr_frame(spark, sf), _CORR_COLS)
    dropped = set(FE.prune_greedy(_CORR_COLS, c, 0.8))
    rows = [(f, f not in dropped) for f in _CORR_COLS]
    return spark.createDataFrame(rows, "feature string, kept boolean")


_TARGET_COLS = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


@query("fe11_target_correlation_filter", "SELECT feature, round(corr, 6) AS corr FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, corr({c}, l_extendedprice) AS corr FROM lineitem" for c in _TARGET_COLS)
    + ") t WHERE abs(corr) < 0.1")
def fe11(spark, sf):
    """Features weakly correlated with the target (|corr| < 0.1), to drop."""
    li = table(spark, sf, "lineitem")
    t = FE.target_correlations(li, _TARGET_COLS, "l_extendedprice")
    return t.filter(F.abs("corr") < 0.1).select("feature", R("corr").alias("corr"))


_VAR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("ag20_variances", "SELECT feature, round(variance, 6) AS variance FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, var_pop({c}) AS variance FROM lineitem" for c in _VAR_COLS)
    + ") t ORDER BY variance DESC")
def ag20(spark, sf):
    li = table(spark, sf, "lineitem")
    v = FE.variances(li, _VAR_COLS)
    return v.select("feature", R("variance").alias("variance")).orderBy(F.desc("variance"))


@query("fe12_variance_threshold", "SELECT feature FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, var_pop({c}) AS variance FROM (SELECT l_quantity / 50 AS l_quantity, "
    f"l_extendedprice / 100000 AS l_extendedprice, l_discount * 10 AS l_discount, l_tax * 10 AS l_tax FROM lineitem) s"
    for c in _VAR_COLS) + ") t WHERE variance > 0.03")
def fe12(spark, sf):
    """Variance threshold 0.03 (population variance) on rescaled columns."""
    li = table(spark, sf, "lineitem").select(
        (F.col("l_quantity") / 50).alias("l_quantity"), (F.col("l_extendedprice") / 100000).alias("l_extendedprice"),
        (F.col("l_discount") * 10).alias("l_discount"), (F.col("l_tax") * 10).alias("l_tax"))
    return FE.variance_threshold(li, _VAR_COLS, 0.03).select("feature")


def _leading_sql(m: str, v: str, rounds: int = 40) -> str:
    """CTEs of the leading eigenvector of the symmetric matrix in ``m`` (a
    list of rows): repeated squaring of the matrix leaves it alone.  ``v``:
    the vector, its largest component positive, and its eigenvalue."""
    return f"""
{v}_pw AS (SELECT 0 AS r, m AS b FROM {m}
  UNION ALL
  SELECT r + 1, list_transform(b, lambda x: list_transform(b, lambda y: list_dot_product(x, y) / s)) FROM (
    SELECT r, b, list_max(list_transform(b, lambda x: list_dot_product(x, x))) AS s FROM {v}_pw) q WHERE r < {rounds}),
{v}_row AS (SELECT list_transform(x, lambda y: y / sqrt(list_dot_product(x, x)) * CASE WHEN list_max(x) >= -list_min(x) THEN 1 ELSE -1 END) AS v FROM (
  SELECT unnest(b) AS x FROM {v}_pw WHERE r = {rounds}) q ORDER BY list_dot_product(x, x) DESC LIMIT 1),
{v} AS MATERIALIZED (SELECT v, list_dot_product(v, list_transform(m, lambda x: list_dot_product(x, v))) AS l FROM {v}_row, {m})"""


_COV_SQL = """WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
mu AS (SELECT list(a ORDER BY p) AS mu FROM (SELECT p, avg(x) AS a FROM (SELECT unnest(range(1, len(v) + 1)) AS p, unnest(v) AS x FROM e) u GROUP BY p) g),
c AS (SELECT vec_id, list_transform(range(1, len(v) + 1), lambda i: v[i] - mu[i]) AS v FROM e, mu),
col AS (SELECT p, list(x ORDER BY vec_id) AS xs FROM (SELECT vec_id, unnest(range(1, len(v) + 1)) AS p, unnest(v) AS x FROM c) u GROUP BY p),
m1 AS (SELECT list(w ORDER BY p) AS m FROM (SELECT a.p, list(list_dot_product(a.xs, b.xs) ORDER BY b.p) AS w FROM col a, col b GROUP BY a.p) g),
tr AS (SELECT sum(m[i][i]) AS t FROM m1, range(1, len(m) + 1) t(i))"""


def _deflated_sql(k: int) -> str:
    """The matrix m{k + 1} without the eigenvector v{k}."""
    return (f"m{k + 1} AS MATERIALIZED (SELECT list_transform(range(1, len(m) + 1), lambda i: list_transform(range(1, len(m) + 1), "
            f"lambda j: m[i][j] - l * v[i] * v[j])) AS m FROM m{k}, v{k})")


@query("fe7_pca_projection", f"""{_COV_SQL}, {_leading_sql('m1', 'v1')}, {_deflated_sql(1)}, {_leading_sql('m2', 'v2')}
SELECT vec_id, round(list_dot_product(c.v, v1.v), 6) AS pc1, round(list_dot_product(c.v, v2.v), 6) AS pc2,
       round(v1.l / t, 6) AS ratio1, round(v2.l / t, 6) AS ratio2 FROM c, v1, v2, tr
""")
def fe7(spark, sf):
    """Centred PCA of the embeddings to 2 components with the explained
    variance ratio of each (sign fixed so the largest loading is > 0)."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.functions import array_to_vector
    e = table(spark, sf, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    centred, model, _ = FE.pca_fit(e, "v", 2)
    pc = model.pc.toArray()
    signs = [1.0 if pc[abs(pc[:, j]).argmax(), j] >= 0 else -1.0 for j in range(pc.shape[1])]
    ratio = [float(x) for x in model.explainedVariance.toArray()]
    out = model.transform(centred).select("vec_id", vector_to_array("pca").alias("p"))
    return out.select("vec_id", R(F.col("p")[0] * signs[0]).alias("pc1"), R(F.col("p")[1] * signs[1]).alias("pc2"),
                      F.lit(round(ratio[0], 6)).alias("ratio1"), F.lit(round(ratio[1], 6)).alias("ratio2"))


_DIM = 64  # of the embeddings


@query("fe8_pca_fraction", f"""{_COV_SQL},
{', '.join(_leading_sql(f'm{k}', f'v{k}') + (', ' + _deflated_sql(k) if k < _DIM else '') for k in range(1, _DIM + 1))},
l AS ({' UNION ALL '.join(f'SELECT {k} AS k, l FROM v{k}' for k in range(1, _DIM + 1))}),
s AS (SELECT k, sum(l) OVER (ORDER BY k) / t AS share FROM l, tr)
SELECT CAST(f AS DOUBLE) AS fraction, CAST(min(k) AS INT) AS n_components FROM s, (SELECT unnest([0.8, 0.9]) AS f) q
WHERE share >= f - 1e-12 GROUP BY f
""")
def fe8(spark, sf):
    """Fewest components reaching 80 % and 90 % of the variance."""
    from pyspark.ml.functions import array_to_vector
    e = table(spark, sf, "embeddings").select(array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    dim = len(e.first()["v"])
    _, model, _ = FE.pca_fit(e, "v", dim)
    ev = [float(x) for x in model.explainedVariance.toArray()]
    rows = [(f, FE.components_for_fraction(ev, f)) for f in (0.8, 0.9)]
    return spark.createDataFrame(rows, "fraction double, n_components int")


# ------------------------------------------------------------------ SPL --

@query("spl1_split_exact", f"""
SELECT o_orderkey, o_orderpriority, o_totalprice, (row_number() OVER (ORDER BY {H('o_orderkey', 1)}, o_orderkey) - 1)
        < round(count(*) OVER () * 0.2) AS is_test FROM orders
""")
def spl1(spark, sf):
    """With columns that are carried along."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return SP.split_exact(o, "o_orderkey", 0.2, seed=1)


@query("spl1_split_approx", f"""
SELECT o_orderkey, {H('o_orderkey', 2)} < {int(0.2 * 1000003)} AS is_test FROM orders
""")
def spl1b(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    return SP.split_approx(o, "o_orderkey", 0.2, seed=2)


@query("spl2_split_stratified", f"""
SELECT o_orderkey, o_orderstatus, o_custkey, o_totalprice,
       (row_number() OVER (PARTITION BY o_orderstatus ORDER BY {H('o_orderkey', 4)}, o_orderkey) - 1)
        < round(count(*) OVER (PARTITION BY o_orderstatus) * 0.3) AS is_test FROM orders
""")
def spl2(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey", "o_totalprice")
    return SP.split_stratified(o, "o_orderkey", "o_orderstatus", 0.3, seed=4)


@query("spl3_split_positional", """
SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) < 6000 AS is_train FROM orders
""")
def spl3(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    return SP.split_positional(o, "o_orderkey", 6000).select("o_orderkey", "is_train")


@query("spl4_stratified_folds", f"""
SELECT o_orderkey, o_orderpriority, o_custkey, o_totalprice,
       CAST((row_number() OVER (PARTITION BY o_orderpriority ORDER BY {H('o_orderkey', 6)}, o_orderkey) - 1) % 5 AS INTEGER) AS fold
FROM orders
""")
def spl4(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_custkey", "o_totalprice")
    return SP.stratified_folds(o, "o_orderkey", "o_orderpriority", 5, seed=6)


@query("spl5_shuffle_split", f"""
SELECT CAST(s AS INTEGER) AS split, o_orderkey,
       CAST('0x' || substr(md5('8:' || CAST(s AS VARCHAR) || ':' || CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 1000003
         < {int(0.2 * 1000003)} AS is_test
FROM orders, range(0, 10) t(s)
""")
def spl5(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    return SP.shuffle_splits(o, "o_orderkey", 10, 0.2, seed=8).select("split", "o_orderkey", "is_test")


@query("spl5_overlap", """
SELECT CAST(a.s AS INTEGER) AS split_a, CAST(b.s AS INTEGER) AS split_b, true AS near_fifth
FROM range(0, 10) a(s), range(0, 10) b(s) WHERE a.s < b.s
""")
def spl5_overlap(spark, sf):
    """Independence of SPL-5's splits: of the test rows of one split a fifth
    (within five standard deviations) are test rows of any other."""
    o = table(spark, sf, "orders").select("o_orderkey")
    t = SP.shuffle_splits(o, "o_orderkey", 10, 0.2, seed=8).filter("is_test")
    sets = t.groupBy("o_orderkey").agg(F.collect_list("split").alias("s"))
    n = t.groupBy("split").agg(F.count("*").alias("n"))
    pair = (sets.select(F.explode("s").alias("split_a"), "s").select("split_a", F.explode("s").alias("split_b"))
            .filter("split_a < split_b").groupBy("split_a", "split_b").agg(F.count("*").alias("both")))
    # a pair without a common row counts as zero
    every = spark.range(100).select((F.col("id") % 10).cast("int").alias("split_a"),
                                    F.floor(F.col("id") / 10).cast("int").alias("split_b")).filter("split_a < split_b")
    p = every.join(pair, ["split_a", "split_b"], "left").join(n.withColumnRenamed("split", "split_a"), "split_a")
    share = F.coalesce("both", F.lit(0)) / F.col("n")
    return p.select("split_a", "split_b", (F.abs(share - 0.2) < 5 * F.sqrt(0.16 / F.col("n"))).alias("near_fifth"))
