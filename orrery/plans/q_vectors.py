"""Vector, distance and nearest-neighbour queries on ``embeddings``
(SURVEY 2.11, JN-1, JN-2, ML-12, ORD-3, NUL-3, AG-4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.functions import vectors as V
from orrery.operators import neighbors as NB
from orrery.operators import relational as rel
from orrery.plans.registry import query
from orrery.session import small_side
from orrery.sources.tables import table

_E = "(SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"


def R(c, d: int = 6):
    return F.round(F.col(c) if isinstance(c, str) else c, d)


def _emb(spark, sf):
    return table(spark, sf, "embeddings").select(
        "vec_id", "label", V.as_double("embedding").alias("v"))


@query("vec1_scale_and_product", f"""
SELECT vec_id,
       list_transform(v, lambda x: round(x * 2, 6)) AS scaled,
       list_transform(range(1, len(v) + 1), lambda i: round(v[i] * v[len(v) + 1 - i], 6)) AS product
FROM {_E} e
""")
def vec1(spark, sf):
    e = _emb(spark, sf)
    return e.select("vec_id", V.round_array(V.scale("v", 2)).alias("scaled"),
                    V.round_array(V.multiply("v", F.reverse("v"))).alias("product"))


@query("vec2_list_repeat", f"""
SELECT vec_id, list_concat(v, v) AS repeated FROM {_E} e
""")
def vec2(spark, sf):
    return _emb(spark, sf).select("vec_id", V.repeat_list("v", 2).alias("repeated"))


@query("vec3_constant_and_ranges", f"""
SELECT vec_id, list_transform(v, lambda x: 1.0) AS ones,
       list_transform(range(0, 10), lambda i: 5.0 - 0.5 * i) AS ramp
FROM {_E} e
""")
def vec3(spark, sf):
    e = _emb(spark, sf)
    return e.select("vec_id", V.full(1.0, F.size("v")).alias("ones"),
                    V.arange(5.0, 0.0, -0.5).alias("ramp"))


@query("vec4_reshape_slice_transpose", f"""
SELECT vec_id,
       list_transform(range(0, 16), lambda i: v[(i // 2) * 8 + (i % 2) + 1]) AS first_two_cols,
       list_transform(range(0, 64), lambda i: v[(i % 8) * 8 + (i // 8) + 1]) AS transposed
FROM {_E} e
""")
def vec4(spark, sf):
    e = _emb(spark, sf)
    m = V.reshape("v", 8)
    return e.select("vec_id",
                    V.flatten(V.column_slice(m, 0, 2)).alias("first_two_cols"),
                    V.flatten(V.transpose(m)).alias("transposed"))


_CENTROID_SQL = f"""
WITH e AS {_E},
u AS (SELECT label, unnest(range(1, len(v) + 1)) AS pos, unnest(v) AS x FROM e),
c AS (SELECT label, list(x ORDER BY pos) AS c
      FROM (SELECT label, pos, avg(x) AS x FROM u GROUP BY label, pos) g GROUP BY label)
"""


@query("vec5_distance_to_centroid", _CENTROID_SQL + """
SELECT e.vec_id, e.label,
       round(list_distance(e.v, c.c), 6) AS euclidean,
       round(list_reduce(list_transform(range(1, len(e.v) + 1), lambda i: abs(e.v[i] - c.c[i])), lambda a, b: a + b), 6) AS manhattan,
       round(list_max(list_transform(range(1, len(e.v) + 1), lambda i: abs(e.v[i] - c.c[i]))), 6) AS chebyshev,
       round(1 - list_cosine_similarity(e.v, c.c), 6) AS cosine,
       round(list_inner_product(e.v, c.c), 6) AS dot,
       round(sqrt(list_inner_product(e.v, e.v)), 6) AS norm
FROM e JOIN c ON e.label = c.label
""")
def vec5(spark, sf):
    """Point-to-set distances: every vector against its label centroid
    (centroids by a partial aggregate, then an equi-join on the label)."""
    e = _emb(spark, sf)
    c = NB.centroids(e, "label", "v", "c")
    j = e.join(small_side(c), "label")
    return j.select("vec_id", "label",
                    R(V.euclidean("v", "c")).alias("euclidean"),
                    R(V.manhattan("v", "c")).alias("manhattan"),
                    R(V.chebyshev("v", "c")).alias("chebyshev"),
                    R(V.cosine_distance("v", "c")).alias("cosine"),
                    R(V.dot("v", "c")).alias("dot"),
                    R(V.norm("v")).alias("norm"))


@query("jn1_distances_to_all_centroids", _CENTROID_SQL + """
SELECT e.vec_id, list(round(list_distance(e.v, c.c), 6) ORDER BY c.label) AS distances
FROM e, c GROUP BY e.vec_id
""")
def jn1(spark, sf):
    """All pairs between the vectors and the (small, size-checked) set of
    label centroids; the centre matrix is inlined, one array per row."""
    e = _emb(spark, sf)
    out = NB.distances_to_centres(e, "vec_id", "v", NB.centroids(e, "label", "v", "c"), "label", "c", "euclidean", "d")
    return out.select("vec_id", V.round_array("d").alias("distances"))


@query("vec6_line_eval", """
WITH f AS (SELECT l_returnflag, regr_slope(l_extendedprice, l_quantity) AS m,
                  regr_intercept(l_extendedprice, l_quantity) AS b FROM lineitem GROUP BY 1)
SELECT l.l_orderkey, l.l_linenumber, round(f.m * l.l_quantity + f.b, 4) AS fitted_price
FROM lineitem l JOIN f ON l.l_returnflag = f.l_returnflag
""")
def vec6(spark, sf):
    li = table(spark, sf, "lineitem")
    y, x = F.col("l_extendedprice"), F.col("l_quantity")
    fit = li.groupBy("l_returnflag").agg(F.regr_slope(y, x).alias("m"), F.regr_intercept(y, x).alias("b"))
    j = li.select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity").join(small_side(fit), "l_returnflag")
    return j.select("l_orderkey", "l_linenumber",
                    R(V.line("l_quantity", F.col("m"), F.col("b")), 4).alias("fitted_price"))


# ------------------------------------------------------------------ AG-4 --

@query("ag4_total_sum", f"""
SELECT round(sum(x), 6) AS total FROM (SELECT unnest(v) AS x FROM {_E} e) t
""")
def ag4a(spark, sf):
    e = _emb(spark, sf)
    return e.agg(R(F.sum(V.array_sum("v"))).alias("total"))


@query("ag4_row_sums", f"""
SELECT vec_id, round(list_sum(v), 6) AS row_sum FROM {_E} e
""")
def ag4b(spark, sf):
    return _emb(spark, sf).select("vec_id", R(V.array_sum("v")).alias("row_sum"))


@query("ag4_column_sums", f"""
SELECT pos, round(sum(x), 6) AS col_sum FROM
  (SELECT unnest(range(0, len(v))) AS pos, unnest(v) AS x FROM {_E} e) t GROUP BY pos
""")
def ag4c(spark, sf):
    """Axis-0 sums: ``posexplode`` and a partial aggregate per position."""
    e = _emb(spark, sf)
    ex = e.select(F.posexplode("v").alias("pos", "x"))
    return ex.groupBy(F.col("pos").cast("long").alias("pos")).agg(R(F.sum("x")).alias("col_sum"))


@query("ag4_axis_sums_3d", f"""
SELECT vec_id, CAST(pos // 8 AS BIGINT) AS i, round(sum(x), 6) AS axis2_sum FROM
  (SELECT vec_id, unnest(range(0, len(v))) AS pos, unnest(v) AS x FROM {_E} e) t GROUP BY vec_id, pos // 8
""")
def ag4d(spark, sf):
    """Each vector as an 8 x 8 matrix (a 3-D n x 8 x 8 tensor); sum over the
    innermost axis, done in-row with no shuffle."""
    e = _emb(spark, sf)
    rows = e.select("vec_id", F.posexplode(V.reshape("v", 8)).alias("i", "row"))
    return rows.select("vec_id", F.col("i").cast("long").alias("i"),
                       R(V.array_sum("row")).alias("axis2_sum"))


# ------------------------------------------------------------------- kNN --

_KNN_SQL = f"""
WITH e AS {_E},
p AS (SELECT a.vec_id AS q_id, b.vec_id AS r_id, {{dist}} AS d FROM e a, e b {{where}}),
r AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY d, r_id) AS rk FROM p)
"""


def _stored(spark, sf):
    """Vectors as they are stored: floats travel as floats."""
    return table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").alias("v"))


@query("jn2_knn_euclidean", _KNN_SQL.format(dist="list_distance(a.v, b.v)", where="WHERE a.vec_id <> b.vec_id") + """
SELECT q_id, r_id, round(d, 6) AS dist, rk AS rank FROM r WHERE rk <= 5
""")
def jn2(spark, sf):
    e = _stored(spark, sf)
    nn = NB.knn(e, e, 5, q_id="vec_id", r_id="vec_id", q_vec="v", r_vec="v",
                metric="euclidean", exclude_self=True)
    return nn.select("q_id", "r_id", R("dist").alias("dist"), "rank")


@query("jn2_knn_cosine", _KNN_SQL.format(dist="1 - list_cosine_similarity(a.v, b.v)", where="WHERE a.vec_id <> b.vec_id") + """
SELECT q_id, r_id, round(d, 6) AS dist, rk AS rank FROM r WHERE rk <= 3
""")
def jn2c(spark, sf):
    e = _emb(spark, sf)
    nn = NB.knn(e, e, 3, q_id="vec_id", r_id="vec_id", q_vec="v", r_vec="v",
                metric="cosine", exclude_self=True)
    return nn.select("q_id", "r_id", R("dist").alias("dist"), "rank")


def _split_flag(col):
    """Deterministic 80/20 hold-out flag from the key (SPL-1 rule)."""
    return rel.hash_order(col, 11) % 5 == 0


_SPLIT_SQL = rel.hash_order_sql("vec_id", 11) + " % 5 = 0"


@query("ml12_knn_classifier", f"""
WITH e AS {_E},
te AS (SELECT * FROM e WHERE {_SPLIT_SQL}), tr AS (SELECT * FROM e WHERE NOT ({_SPLIT_SQL})),
p AS (SELECT te.vec_id AS q_id, tr.label AS lab, list_distance(te.v, tr.v) AS d, tr.vec_id AS r_id FROM te, tr),
r AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY d, r_id) AS rk FROM p),
v AS (SELECT q_id, lab, count(*) AS n FROM r WHERE rk <= 5 GROUP BY q_id, lab)
SELECT q_id AS vec_id, prediction FROM (
  SELECT q_id, lab AS prediction, row_number() OVER (PARTITION BY q_id ORDER BY n DESC, lab) AS o FROM v) t
WHERE o = 1
""")
def ml12(spark, sf):
    """kNN classifier: test rows against the training rows (k = 5,
    uniform weights, Euclidean); majority vote, ties to smallest label."""
    e = _stored(spark, sf)
    test, train = e.filter(_split_flag("vec_id")), e.filter(~_split_flag("vec_id"))
    nn = NB.knn(test, train, 5, q_id="vec_id", r_id="vec_id", q_vec="v", r_vec="v")
    pred = NB.knn_vote(nn, train, "vec_id", "label")
    return pred.select(F.col("q_id").alias("vec_id"), "prediction")


@query("ord3_knn_distance_curve", _KNN_SQL.format(dist="list_distance(a.v, b.v)", where="") + """
SELECT q_id AS vec_id, round(avg(d), 6) AS mean_knn_dist FROM r WHERE rk <= 4 GROUP BY q_id
ORDER BY mean_knn_dist
""")
def ord3(spark, sf):
    """Sorted mean distance to the 4 nearest rows (self included at 0), the
    curve used to choose a DBSCAN epsilon."""
    e = _stored(spark, sf)
    nn = NB.knn(e, e, 4, q_id="vec_id", r_id="vec_id", q_vec="v", r_vec="v")
    m = nn.groupBy("q_id").agg(F.avg("dist").alias("m"))
    return m.select(F.col("q_id").alias("vec_id"), R("m").alias("mean_knn_dist")).orderBy("mean_knn_dist")


@query("nul3_knn_impute", f"""
WITH e AS (SELECT vec_id, v, CASE WHEN v[1] < -0.1 THEN NULL ELSE CAST(label AS DOUBLE) END AS y FROM {_E} x),
miss AS (SELECT * FROM e WHERE y IS NULL), known AS (SELECT * FROM e WHERE y IS NOT NULL),
p AS (SELECT m.vec_id AS q_id, k.vec_id AS r_id, k.y, list_distance(m.v, k.v) AS d FROM miss m, known k),
r AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY d, r_id) AS rk FROM p)
SELECT vec_id, round(coalesce(y, imp), 6) AS value_imputed FROM e LEFT JOIN
  (SELECT q_id, avg(y) AS imp FROM r WHERE rk <= 3 GROUP BY q_id) i ON e.vec_id = i.q_id
""")
def nul3(spark, sf):
    """kNN imputation (k = 3): a missing value becomes the mean of the
    values of the 3 nearest rows that have one (distance on the vector)."""
    e = _emb(spark, sf).select(
        "vec_id", "v",
        F.when(F.element_at("v", 1) < -0.1, None).otherwise(F.col("label").cast("double")).alias("y"))
    miss, known = e.filter(F.col("y").isNull()), e.filter(F.col("y").isNotNull())
    nn = NB.knn(miss, known, 3, q_id="vec_id", r_id="vec_id", q_vec="v", r_vec="v")
    imp = (nn.join(known.select(F.col("vec_id").alias("r_id"), "y"), "r_id")
             .groupBy("q_id").agg(F.avg("y").alias("imp")))
    j = e.join(imp, e.vec_id == imp.q_id, "left")
    return j.select("vec_id", R(F.coalesce("y", "imp")).alias("value_imputed"))


def _knn_vote_sql(dist: str, weight: str) -> str:
    return f"""
WITH e AS {_E},
te AS (SELECT * FROM e WHERE {_SPLIT_SQL}), tr AS (SELECT * FROM e WHERE NOT ({_SPLIT_SQL})),
p AS (SELECT te.vec_id AS q_id, tr.label AS lab, {dist} AS d, tr.vec_id AS r_id FROM te, tr),
r AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY d, r_id) AS rk FROM p),
v AS (SELECT q_id, lab, sum({weight}) AS n FROM r WHERE rk <= 5 GROUP BY q_id, lab)
SELECT q_id AS vec_id, prediction FROM (
  SELECT q_id, lab AS prediction, row_number() OVER (PARTITION BY q_id ORDER BY n DESC, lab) AS o FROM v) t
WHERE o = 1
"""


def _knn_vote(spark, sf, metric: str, weights: str):
    e = _stored(spark, sf)
    test, train = e.filter(_split_flag("vec_id")), e.filter(~_split_flag("vec_id"))
    nn = NB.knn(test, train, 5, q_id="vec_id", r_id="vec_id", q_vec="v", r_vec="v", metric=metric)
    return NB.knn_vote(nn, train, "vec_id", "label", weights).select(F.col("q_id").alias("vec_id"), "prediction")


@query("ml12_knn_manhattan", _knn_vote_sql(
    "list_sum(list_transform(range(1, len(te.v) + 1), lambda i: abs(te.v[i] - tr.v[i])))", "1"))
def ml12m(spark, sf):
    return _knn_vote(spark, sf, "manhattan", "uniform")


@query("ml12_knn_cosine", _knn_vote_sql("1 - list_cosine_similarity(te.v, tr.v)", "1"))
def ml12c(spark, sf):
    return _knn_vote(spark, sf, "cosine", "uniform")


@query("ml12_knn_distance_weights", _knn_vote_sql("list_distance(te.v, tr.v)", "1 / d"))
def ml12w(spark, sf):
    """Votes weigh 1 / distance (no test row lies on a training row here)."""
    return _knn_vote(spark, sf, "euclidean", "distance")


@query("ag4_axis0_axis1_3d", f"""
WITH x AS (SELECT pos // 8 AS i, pos % 8 AS j, vec_id, x FROM
  (SELECT vec_id, unnest(range(0, len(v))) AS pos, unnest(v) AS x FROM {_E} e) t)
SELECT 0 AS axis, CAST(NULL AS BIGINT) AS vec_id, CAST(i AS BIGINT) AS i, CAST(j AS BIGINT) AS j, round(sum(x), 6) AS total
FROM x GROUP BY i, j
UNION ALL
SELECT 1, vec_id, CAST(NULL AS BIGINT), CAST(j AS BIGINT), round(sum(x), 6) FROM x GROUP BY vec_id, j
""")
def ag4e(spark, sf):
    """The n x 8 x 8 tensor summed over axis 0 (per cell, partial
    aggregates) and over axis 1 (in the row)."""
    e = _emb(spark, sf).select("vec_id", V.reshape("v", 8).alias("m"))
    zero = V.axis_sum_3d(e, "m", 0).select(F.lit(0).alias("axis"), F.lit(None).cast("long").alias("vec_id"), "i", "j", R("total").alias("total"))
    one = V.axis_sum_3d(e, "m", 1, "vec_id").select(F.lit(1).alias("axis"), "vec_id", F.lit(None).cast("long").alias("i"), "j",
                                                    R("total").alias("total"))
    return zero.unionByName(one)


@query("vec4_copy_then_set", f"""
SELECT vec_id, round(v[3], 6) AS original, -1.5 AS changed, round(list_sum(v), 6) AS sum_before,
       round(list_sum(v) - v[3] - 1.5, 6) AS sum_after
FROM {_E} e
""")
def vec4b(spark, sf):
    """Setting an element of a copy leaves the array itself as it was."""
    e = _emb(spark, sf).withColumn("w", V.with_value("v", 2, -1.5))
    return e.select("vec_id", R(F.get("v", F.lit(2))).alias("original"), F.get("w", F.lit(2)).alias("changed"),
                    R(V.array_sum("v")).alias("sum_before"), R(V.array_sum("w")).alias("sum_after"))
