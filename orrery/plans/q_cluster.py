"""Clustering queries (SURVEY 2.13 ML-13..17, AG-14..17, WIN-1, WIN-2,
JN-3)."""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from orrery.functions import vectors as V
from orrery.operators import cluster as CL
from orrery.operators import dbscan as DB
from orrery.operators import density as DN
from orrery.operators import neighbors as NB
from orrery.operators import relational as rel
from orrery.plans.registry import query
from orrery.session import cut_lineage, many
from orrery.sources.tables import table


def R(c, d: int = 6):
    return F.round(F.col(c) if isinstance(c, str) else c, d)


def _emb(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "label", V.as_double("embedding").alias("v"))


_E = "(SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
_H = rel.hash_order_sql("vec_id", 5)
_ASSIGN_SQL = f"""
WITH e AS {_E},
c AS (SELECT row_number() OVER (ORDER BY h, vec_id) - 1 AS cid, v AS cv FROM (
        SELECT {_H} AS h, vec_id, v FROM e) t ORDER BY h, vec_id LIMIT 10),
d AS (SELECT e.vec_id, e.v, c.cid,
             list_reduce(list_transform(range(1, len(e.v) + 1), lambda i: (e.v[i] - c.cv[i]) * (e.v[i] - c.cv[i])),
                         lambda a, b: a + b) AS d2 FROM e, c),
a AS (SELECT vec_id, v, cid AS cluster, d2 FROM (
        SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, cid) AS rn FROM d) t WHERE rn = 1)
"""


def _assigned(spark, sf):
    e = _emb(spark, sf)
    centres = CL.initial_centres(e, "vec_id", "v", 10, seed=5)
    return CL.lloyd_step(e, "v", centres)


@query("ml13_kmeans_assign_step", _ASSIGN_SQL + """,
u AS (SELECT cluster, unnest(range(0, len(v))) AS pos, unnest(v) AS x FROM a)
SELECT CAST(cluster AS INTEGER) AS cluster, list(round(m, 6) ORDER BY pos) AS centre FROM (
  SELECT cluster, pos, avg(x) AS m FROM u GROUP BY cluster, pos) g GROUP BY cluster
""")
def ml13a(spark, sf):
    """One k-means step from 10 seeded initial rows: assignment (ties to the
    lowest centre) and the updated centres."""
    _, new = _assigned(spark, sf)
    return new.select("cluster", V.round_array("centre").alias("centre"))


@query("ag14_inertia", _ASSIGN_SQL + """
SELECT round(sum(d2), 4) AS inertia, count(*) AS n FROM a
""")
def ag14(spark, sf):
    """Within-cluster sum of squares over all rows for the seeded centres."""
    a, _ = _assigned(spark, sf)
    return a.agg(R(F.sum("sq_dist"), 4).alias("inertia"), F.count(F.lit(1)).alias("n"))


_MAX_ITER = 100
_KS = range(2, 10)


def _lloyd_sql(k: int, digits: int | None = None) -> str:
    """k-means from the first k distinct rows in hash order until inertia
    stops falling: one recursion step a round, at most ``_MAX_ITER``; ``a``
    holds (vec_id, v, cluster, d2) for the last centres, rounded to
    ``digits`` where given."""
    centre = "cs[i]" if digits is None else f"list_transform(cs[i], lambda x: round(x, {digits}))"
    return f"""WITH RECURSIVE e AS {_E},
f AS (SELECT list(v ORDER BY h, vec_id) AS cs FROM (SELECT h, vec_id, v FROM (
  SELECT *, row_number() OVER (PARTITION BY v ORDER BY h, vec_id) AS dup FROM (SELECT {_H} AS h, vec_id, v FROM e) t) u
  WHERE dup = 1 ORDER BY h, vec_id LIMIT {k}) r),
it AS (SELECT 0 AS r, cs, CAST('inf' AS DOUBLE) AS last FROM f
  UNION ALL
  SELECT r + 1, list_transform(range(1, {k} + 1), lambda i: coalesce(map_extract(m, i)[1], cs[i])), cost FROM (
    SELECT max(r) AS r, max(last) AS last, any_value(cs) AS cs, sum(cost) AS cost, map_from_entries(list((cl, cv))) AS m FROM (
      SELECT cl, max(r) AS r, max(last) AS last, any_value(cs) AS cs, sum(cost) AS cost, list(x ORDER BY pos) AS cv FROM (
        SELECT cl, pos, max(r) AS r, max(last) AS last, any_value(cs) AS cs, avg(x) AS x,
               sum(CASE WHEN pos = 0 THEN d2 ELSE 0 END) AS cost FROM (
          SELECT r, last, cs, list_position(d, list_min(d)) AS cl, list_min(d) AS d2, unnest(range(0, len(v))) AS pos, unnest(v) AS x FROM (
            SELECT it.r, it.last, it.cs, e.v, list_transform(it.cs, lambda c: list_sum(list_transform(range(1, len(e.v) + 1),
              lambda i: (e.v[i] - c[i]) * (e.v[i] - c[i])))) AS d FROM it, e) b) u GROUP BY cl, pos) g GROUP BY cl) w) z
  WHERE r < {_MAX_ITER} AND cost < last),
c AS (SELECT i - 1 AS cid, {centre} AS cv FROM (SELECT cs, unnest(range(1, {k} + 1)) AS i FROM (SELECT cs FROM it ORDER BY r DESC LIMIT 1) x) y),
a AS (SELECT vec_id, v, cid AS cluster, cv, d2 FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, cid) AS rn FROM (
    SELECT e.vec_id, e.v, c.cid, c.cv, list_reduce(list_transform(range(1, len(e.v) + 1),
      lambda i: (e.v[i] - c.cv[i]) * (e.v[i] - c.cv[i])), lambda a, b: a + b) AS d2 FROM e, c) d) t WHERE rn = 1)"""


_SWEEP_SQL = " UNION ALL ".join(
    f"SELECT {k} AS k, (SELECT sum(d2) FROM ({_lloyd_sql(k)} SELECT d2 FROM a) s) AS wsse" for k in _KS)


def _k_sweep(spark, sf):
    e = _emb(spark, sf)
    first = CL.initial_centres(e, "vec_id", "v", max(_KS), seed=5)
    last = CL.lloyd(e, "v", {k: first[:k] for k in _KS}, _MAX_ITER)
    cost = F.array(*[F.struct(F.lit(k).alias("k"), F.array_min(CL.squared_distances("v", m)).alias("d")) for k, m in last.items()])
    return e.select(F.explode(cost).alias("c")).groupBy("c.k").agg(F.sum("c.d").alias("wsse"))


@query("ml13_kmeans_fit", _lloyd_sql(10) + """
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster FROM a
""")
def ml13b(spark, sf):
    """k-means (k = 10) from given distinct rows until inertia stops
    falling; the cluster of every row by the fitted centres."""
    e = _emb(spark, sf)
    centres = CL.lloyd(e, "v", {10: CL.initial_centres(e, "vec_id", "v", 10, seed=5)}, _MAX_ITER)[10]
    return CL.assign(e, "v", centres).select("vec_id", "cluster")


@query("ml14_k_sweep", f"SELECT k, round(wsse, 4) AS wsse FROM ({_SWEEP_SQL}) w")
def ml14(spark, sf):
    """Inertia for k = 2..9, every k until its inertia stops falling."""
    return _k_sweep(spark, sf).select("k", R("wsse", 4).alias("wsse"))


@query("win1_elbow_kmeans", f"""
WITH s AS (SELECT k, wsse, row_number() OVER (ORDER BY k) - 1 AS i, lead(wsse) OVER (ORDER BY k) - wsse AS sl FROM ({_SWEEP_SQL}) w),
p AS (SELECT *, lag(sl) OVER (ORDER BY k) AS prev FROM s)
SELECT k, round(wsse, 4) AS wsse FROM p
WHERE i = coalesce((SELECT min(i) FROM p WHERE i >= 1 AND sl IS NOT NULL AND abs(prev) - abs(sl) > 100), 1)
""")
def win1a(spark, sf):
    """Elbow of the k sweep fitted to the end (threshold 100; second row if
    none)."""
    return CL.elbow(_k_sweep(spark, sf), "k", "wsse", 100.0).select("k", R("wsse", 4).alias("wsse"))


def _binned_curve(spark, sf):
    li = table(spark, sf, "lineitem").select("l_quantity")
    x = li.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(10))))
    x = x.withColumn("bin", F.least(F.floor((F.col("l_quantity") - 1) * F.col("k") / 50), F.col("k") - 1))
    g = x.groupBy("k", "bin").agg((F.var_pop("l_quantity") * F.count(F.lit(1))).alias("ss"))
    return g.groupBy("k").agg(F.sum("ss").alias("wsse"))


_CURVE_SQL = """
WITH x AS (SELECT l_quantity, k, least(floor((l_quantity - 1) * k / 50), k - 1) AS bin
           FROM lineitem, range(1, 11) t(k)),
g AS (SELECT k, bin, var_pop(l_quantity) * count(*) AS ss FROM x GROUP BY k, bin),
c AS (SELECT k, sum(ss) AS wsse FROM g GROUP BY k),
s AS (SELECT k, wsse, row_number() OVER (ORDER BY k) - 1 AS i, lead(wsse) OVER (ORDER BY k) - wsse AS sl FROM c),
p AS (SELECT *, lag(sl) OVER (ORDER BY k) AS prev FROM s)
"""


@query("win1_elbow_curve", _CURVE_SQL + """
SELECT CAST(k AS INTEGER) AS k, round(wsse, 4) AS wsse FROM p
WHERE i = coalesce((SELECT min(i) FROM p WHERE i >= 1 AND sl IS NOT NULL AND abs(prev) - abs(sl) > 100), 1)
""")
def win1b(spark, sf):
    """Elbow of a data-derived inertia curve: within-bin sum of squares of
    the quantity split into k equal-width bins, k = 1..10 (threshold 100)."""
    curve = _binned_curve(spark, sf).withColumn("k", F.col("k").cast("int"))
    e = CL.elbow(curve, "k", "wsse", 100.0)
    return e.select("k", R("wsse", 4).alias("wsse"))


@query("ml17_vector_quantisation", _lloyd_sql(16, digits=2) + """
SELECT vec_id, CAST(cluster AS INTEGER) AS code, round(d2, 6) AS sq_error, 64 * 32 AS bits_before,
       CAST(ceil(log2(16)) AS INTEGER) AS bits_after FROM a
""")
def ml17(spark, sf):
    """Palette of 16 k-means centres fitted to the end (rounded to 2
    decimals), one code per vector, the squared error of its reconstruction
    and the bits per vector before / after; vectors are rebuilt by a
    broadcast look-up of the palette."""
    e = _emb(spark, sf)
    centres = CL.lloyd(e, "v", {16: CL.initial_centres(e, "vec_id", "v", 16, seed=5)}, _MAX_ITER)[16]
    palette = [[round(x, 2) for x in c] for c in centres]
    coded = e.select("vec_id", "v", CL.nearest_centre("v", palette).alias("code"))
    pal = spark.createDataFrame([(i, c) for i, c in enumerate(palette)], "code int, centre array<double>")
    rec = coded.join(F.broadcast(pal), "code")
    dim = len(palette[0])
    return rec.select("vec_id", "code", R(V.sq_euclidean("v", "centre")).alias("sq_error"),
                      F.lit(dim * 32).alias("bits_before"),
                      F.lit(math.ceil(math.log2(len(palette)))).alias("bits_after"))


# ---------------------------------------------------------- AG-15..17 --

_SIL_SQL = f"""
WITH e AS {_E},
p AS (SELECT a.vec_id, a.label AS own, b.label AS other, list_distance(a.v, b.v) AS d
      FROM e a, e b WHERE a.vec_id <> b.vec_id),
m AS (SELECT vec_id, own, other, avg(d) AS md FROM p GROUP BY 1, 2, 3),
s AS (SELECT vec_id, max(CASE WHEN own = other THEN md END) AS a,
             min(CASE WHEN own <> other THEN md END) AS b FROM m GROUP BY vec_id)
SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM s
"""


@query("ag15_silhouette", _SIL_SQL)
def ag15(spark, sf):
    """Exact silhouette of the labelling given by ``embeddings.label``."""
    e = _emb(spark, sf).withColumn("labs", F.array(F.col("label").cast("long")))
    s = CL.silhouette(e, "vec_id", "v", "labs")
    return s.select(R("silhouette").alias("silhouette"))


@query("ag15_silhouette_squared", _SIL_SQL.replace("avg(d) AS md", "avg(d * d) AS md"))
def ag15b(spark, sf):
    """The silhouette on squared distances, from counts, means and variances
    of the clusters: no pairs of points."""
    s = CL.silhouette_squared(_emb(spark, sf), "v", "label")
    return s.select(R("silhouette").alias("silhouette"))


_CENT_SQL = f"""
WITH e AS {_E},
u AS (SELECT vec_id, label, unnest(range(1, len(v) + 1)) AS pos, unnest(v) AS x FROM e),
cm AS (SELECT label, pos, avg(x) AS m, count(*) AS n FROM u GROUP BY label, pos),
om AS (SELECT pos, avg(x) AS m FROM u GROUP BY pos)
"""


@query("ag16_calinski_harabasz", _CENT_SQL + """,
w AS (SELECT sum((u.x - cm.m) * (u.x - cm.m)) AS W FROM u JOIN cm ON u.label = cm.label AND u.pos = cm.pos),
b AS (SELECT sum(cm.n * (cm.m - om.m) * (cm.m - om.m)) AS B FROM cm JOIN om ON cm.pos = om.pos),
k AS (SELECT count(DISTINCT label) AS k, count(*) AS n FROM e)
SELECT round(CASE WHEN W = 0 THEN 1.0 ELSE (B * (n - k)) / (W * (k - 1)) END, 4) AS calinski_harabasz FROM w, b, k
""")
def ag16(spark, sf):
    c = CL.calinski_harabasz(_emb(spark, sf), "v", "label")
    return c.select(R("calinski_harabasz", 4).alias("calinski_harabasz"))


@query("ag17_davies_bouldin", _CENT_SQL + """,
c AS (SELECT label, list(m ORDER BY pos) AS cv FROM cm GROUP BY label),
s AS (SELECT e.label, avg(list_distance(e.v, c.cv)) AS s FROM e JOIN c ON e.label = c.label GROUP BY e.label),
cs AS (SELECT c.label, c.cv, s.s FROM c JOIN s ON c.label = s.label),
r AS (SELECT a.label, max((a.s + b.s) / list_distance(a.cv, b.cv)) AS m FROM cs a, cs b
      WHERE a.label <> b.label GROUP BY a.label)
SELECT round(avg(m), 6) AS davies_bouldin FROM r
""")
def ag17(spark, sf):
    d = CL.davies_bouldin(_emb(spark, sf), "v", "label")
    return d.select(R("davies_bouldin").alias("davies_bouldin"))


# ---------------------------------------------------- JN-3, ML-15, 16 --

def _points(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", (F.col("c_acctbal") / 1000).alias("x"), (F.col("c_nationkey") / 3.0).alias("y"))


_PTS_SQL = "(SELECT c_custkey, c_acctbal / 1000 AS x, c_nationkey / 3.0 AS y FROM customer)"


@query("jn3_radius_join", f"""
SELECT a.c_custkey AS id_a, b.c_custkey AS id_b,
       round(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), 6) AS dist
FROM {_PTS_SQL} a JOIN {_PTS_SQL} b ON a.c_custkey < b.c_custkey
 AND sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 0.3
""")
def jn3(spark, sf):
    """Pairs of points within eps = 0.3 (each unordered pair once), via grid
    cells of side eps and half of their 3 x 3 neighbourhoods."""
    p = DB.radius_pairs(_points(spark, sf), "c_custkey", ["x", "y"], 0.3, once=True)
    return p.select("id_a", "id_b", R("dist").alias("dist"))


@query("ml15_dbscan", f"""
WITH RECURSIVE p AS {_PTS_SQL},
n AS (SELECT a.c_custkey AS a, b.c_custkey AS b FROM p a JOIN p b
      ON sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 0.3),
core AS (SELECT a AS id FROM n GROUP BY a HAVING count(*) >= 4),
e AS (SELECT n.a, n.b FROM n JOIN core x ON n.a = x.id JOIN core y ON n.b = y.id),
reach(a, b) AS (SELECT id, id FROM core UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a),
comp AS (SELECT a AS id, min(b) AS root FROM reach GROUP BY a),
num AS (SELECT root, row_number() OVER (ORDER BY root) - 1 AS cluster FROM (SELECT DISTINCT root FROM comp) d),
lab AS (SELECT comp.id, num.cluster FROM comp JOIN num ON comp.root = num.root),
border AS (SELECT n.a AS id, min(lab.cluster) AS cluster FROM n JOIN lab ON n.b = lab.id GROUP BY n.a)
SELECT p.c_custkey, coalesce(lab.cluster, border.cluster, -1) AS cluster
FROM p LEFT JOIN lab ON p.c_custkey = lab.id LEFT JOIN border ON p.c_custkey = border.id
""")
def ml15(spark, sf):
    """DBSCAN, eps 0.3, min_samples 4 on the customer points."""
    out = DB.dbscan(_points(spark, sf), "c_custkey", ["x", "y"], [0.3], 4)
    return out.select(F.col("id").alias("c_custkey"), "cluster")


def _density_sql(points: str, dist: str, eps: list[float], m: int) -> str:
    """CTEs up to ``lab`` (e, eps, id, cluster): DBSCAN of ``points`` (id,
    ...) for every eps, components by spreading the smallest label until
    nothing moves.  ``dist``: the distance of the rows a and b."""
    return f"""p AS ({points}),
eps AS (SELECT unnest(range(0, {len(eps)})) AS e, unnest({eps}::DOUBLE[]) AS eps),
d AS (SELECT a.id AS a, b.id AS b, {dist} AS dist FROM p a JOIN p b ON {dist} <= {max(eps)}),
n AS (SELECT e, eps, a, b FROM d JOIN eps ON dist <= eps),
core AS (SELECT e, a AS id FROM n GROUP BY e, a HAVING count(*) >= {m}),
g AS (SELECT n.e, n.a, n.b FROM n JOIN core x ON n.e = x.e AND n.a = x.id JOIN core y ON n.e = y.e AND n.b = y.id),
it AS (
  SELECT e, id, id AS lab, CAST(1 AS HUGEINT) AS moved, 0 AS r FROM core
  UNION ALL
  SELECT e, id, nl, sum(CASE WHEN nl < lab THEN 1 ELSE 0 END) OVER (), r + 1 FROM (
    SELECT i.e, i.id, min(i.lab) AS lab, min(k.lab) AS nl, min(i.r) AS r
    FROM it i JOIN g ON g.e = i.e AND g.a = i.id JOIN it k ON k.e = g.e AND k.id = g.b WHERE i.moved > 0 GROUP BY i.e, i.id) t),
cl AS (SELECT e, id, dense_rank() OVER (PARTITION BY e ORDER BY lab) - 1 AS cluster FROM it WHERE r = (SELECT max(r) FROM it)),
border AS (SELECT n.e, n.a AS id, min(cl.cluster) AS cluster FROM n JOIN cl ON n.e = cl.e AND n.b = cl.id GROUP BY n.e, n.a),
lab AS (SELECT eps.e, eps.eps, p.*, coalesce(cl.cluster, border.cluster, -1) AS cluster FROM p CROSS JOIN eps
        LEFT JOIN cl ON cl.e = eps.e AND cl.id = p.id LEFT JOIN border ON border.e = eps.e AND border.id = p.id)"""


_VEC = "SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings"
_VEC_DIST = "list_distance(a.v, b.v)"


@query("jn3_radius_join_vectors", f"""
WITH p AS ({_VEC})
SELECT a.id AS id_a, b.id AS id_b, round({_VEC_DIST}, 6) AS dist FROM p a JOIN p b ON a.id < b.id AND {_VEC_DIST} <= 1.1
""")
def jn3_vectors(spark, sf):
    """Pairs of 64-dimensional vectors within eps = 1.1 (each unordered pair
    once), through the pivot index."""
    p = DB.ball_pairs(table(spark, sf, "embeddings"), "vec_id", "embedding", 1.1, once=True)
    return p.select("id_a", "id_b", R("dist").alias("dist"))


@query("ml15_dbscan_vectors", f"""
WITH RECURSIVE {_density_sql(_VEC, _VEC_DIST, [1.1, 1.15, 1.2], 3)}
SELECT eps, id AS vec_id, cluster FROM lab
""")
def ml15_vectors(spark, sf):
    """DBSCAN of 64-dimensional vectors, min_samples 3, for eps 1.1, 1.15 and
    1.2: three cuts of one reachability tree."""
    out = DN.dbscan_any(_emb(spark, sf), "vec_id", "v", [1.1, 1.15, 1.2], 3)
    return out.select("eps", F.col("id").alias("vec_id"), "cluster")


_SWEEP = [e / 100 for e in range(10, 60, 5)]
_XY = "SELECT c_custkey AS id, c_acctbal / 1000 AS x, c_nationkey / 3.0 AS y FROM customer"
_XY_DIST = "sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))"


def _scores_sql(eps: list[float]) -> str:
    """CTEs up to ``sc``: the scores of every eps with two clusters or more."""
    return f"""WITH RECURSIVE {_density_sql(_XY, _XY_DIST, eps, 4)},
st AS (SELECT e, eps, count(DISTINCT cluster) FILTER (WHERE cluster >= 0) AS n_clusters,
              count(*) FILTER (WHERE cluster < 0) AS n_noise FROM lab GROUP BY e, eps),
v AS (SELECT lab.* FROM lab JOIN st ON lab.e = st.e WHERE n_clusters > 1),
m AS (SELECT a.e, a.id, a.cluster AS own, b.cluster AS other, sum((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS s, count(*) AS c
      FROM v a JOIN v b ON a.e = b.e GROUP BY a.e, a.id, a.cluster, b.cluster),
ab AS (SELECT e, id, max(CASE WHEN own = other AND c > 1 THEN s / (c - 1) END) AS a, min(CASE WHEN own <> other THEN s / c END) AS b
       FROM m GROUP BY e, id),
sil AS (SELECT e, avg(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END) AS silhouette FROM ab GROUP BY e),
c AS (SELECT e, cluster, avg(x) AS cx, avg(y) AS cy, count(*) AS n FROM v GROUP BY e, cluster),
o AS (SELECT e, avg(x) AS ox, avg(y) AS oy, count(*) AS n FROM v GROUP BY e),
w AS (SELECT v.e, v.cluster, sum((x - cx) * (x - cx) + (y - cy) * (y - cy)) AS w,
             avg(sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy))) AS s FROM v JOIN c ON v.e = c.e AND v.cluster = c.cluster GROUP BY v.e, v.cluster),
ch AS (SELECT o.e, (sum(c.n * ((cx - ox) * (cx - ox) + (cy - oy) * (cy - oy))) * (min(o.n) - count(*))) / (sum(w.w) * (count(*) - 1)) AS ch
       FROM o JOIN c ON c.e = o.e JOIN w ON w.e = c.e AND w.cluster = c.cluster GROUP BY o.e),
r AS (SELECT a.e, a.cluster, max((wa.s + wb.s) / sqrt((a.cx - b.cx) * (a.cx - b.cx) + (a.cy - b.cy) * (a.cy - b.cy))) AS r
      FROM c a JOIN c b ON a.e = b.e AND a.cluster <> b.cluster JOIN w wa ON wa.e = a.e AND wa.cluster = a.cluster
      JOIN w wb ON wb.e = b.e AND wb.cluster = b.cluster GROUP BY a.e, a.cluster),
db AS (SELECT e, avg(r) AS db FROM r GROUP BY e),
sc AS (SELECT st.eps, st.n_clusters, st.n_noise, round(silhouette, 6) AS silhouette_squared, round(ch, 4) AS calinski_harabasz,
              round(db, 6) AS davies_bouldin FROM st JOIN sil ON sil.e = st.e JOIN ch ON ch.e = st.e JOIN db ON db.e = st.e)"""


def _sweep_scores(spark, sf, eps_list):
    """Every eps is a cut of one reachability tree; those with two clusters
    or more are scored (noise counted as one more cluster)."""
    pts = _points(spark, sf).select(F.col("c_custkey").alias("id"), F.array("x", "y").alias("v"))
    lab = cut_lineage(DN.dbscan_any(pts, "id", "v", eps_list, 4))
    stats = lab.groupBy("e", "eps").agg(
        F.count_distinct(F.when(F.col("cluster") >= 0, F.col("cluster"))).alias("n_clusters"),
        F.count_if(F.col("cluster") < 0).alias("n_noise"))
    valid = stats.filter(F.col("n_clusters") > 1)
    per_pt = cut_lineage(lab.join(valid.select("e"), "e").join(many(pts), "id"))
    if per_pt.isEmpty():
        none = F.lit(None).cast("double")
        return valid.select("eps", "n_clusters", "n_noise", none.alias("silhouette_squared"), none.alias("calinski_harabasz"),
                            none.alias("davies_bouldin"))
    ch = CL.calinski_harabasz(per_pt, "v", "cluster", ["e"])
    db = CL.davies_bouldin(per_pt, "v", "cluster", ["e"])
    sil = CL.silhouette_squared(per_pt, "v", "cluster", "e")
    return (valid.join(sil, "e").join(ch, "e").join(db, "e")
                 .select("eps", "n_clusters", "n_noise", R("silhouette").alias("silhouette_squared"),
                         R("calinski_harabasz", 4).alias("calinski_harabasz"),
                         R("davies_bouldin").alias("davies_bouldin")))


@query("ml16_eps_sweep", _scores_sql(_SWEEP) + " SELECT * FROM sc")
def ml16(spark, sf):
    """DBSCAN for eps 0.10, 0.15, ..., 0.55 from one tree; eps values with at
    least two clusters scored by the silhouette of squared distances,
    Calinski-Harabasz and Davies-Bouldin (noise counted as one more
    cluster)."""
    return _sweep_scores(spark, sf, _SWEEP)


_RANGES = [(lo, lo + 20) for lo in range(10, 50, 10)]  # hundredths
_GRID = sorted({e for lo, hi in _RANGES for e in range(lo, hi, 5)})


@query("win2_eps_ranges", _scores_sql([g / 100 for g in _GRID]) + f""",
rg AS (SELECT unnest({[lo for lo, _ in _RANGES]}) AS lo, unnest({[hi for _, hi in _RANGES]}) AS hi),
j AS (SELECT lo, hi, sc.*, CAST(round(eps * 100) AS INT) AS h FROM sc JOIN rg ON round(eps * 100) >= lo AND round(eps * 100) < hi),
k AS (SELECT *, row_number() OVER (PARTITION BY lo ORDER BY silhouette_squared DESC, h) AS rs,
             row_number() OVER (PARTITION BY lo ORDER BY calinski_harabasz DESC, h) AS rc,
             row_number() OVER (PARTITION BY lo ORDER BY davies_bouldin, h) AS rd FROM j),
b AS (SELECT lo, hi, max(CASE WHEN rs = 1 THEN eps END) AS best_silhouette_squared_eps, max(CASE WHEN rc = 1 THEN eps END) AS best_ch_eps,
             max(CASE WHEN rd = 1 THEN eps END) AS best_db_eps FROM k GROUP BY lo, hi),
a AS (SELECT *, (best_silhouette_squared_eps + best_ch_eps + best_db_eps) / 3 AS mean_eps FROM b)
SELECT lo / 100::DOUBLE AS range_lo, hi / 100::DOUBLE AS range_hi, best_silhouette_squared_eps, best_ch_eps, best_db_eps,
       round(mean_eps, 6) AS mean_eps, round(avg(mean_eps) OVER (), 6) AS overall_eps FROM a
""")
def win2(spark, sf):
    """Overlapping eps ranges [lo, lo + 0.2) for lo = 0.10, 0.20, 0.30,
    0.40, each with grid lo, lo + 0.05, ...; per range the best eps by each
    score (first on ties), their mean, and the mean over ranges."""
    scores = _sweep_scores(spark, sf, [g / 100 for g in _GRID])
    scores = scores.withColumn("h", F.round(F.col("eps") * 100).cast("int"))
    rdf = spark.createDataFrame(_RANGES, "lo int, hi int")
    members = rdf.select("lo", "hi", F.explode(F.sequence("lo", F.col("hi") - 1, F.lit(5))).alias("h"))
    j = members.join(scores, "h")
    best = j.groupBy("lo", "hi").agg(
        F.max_by("eps", F.struct(F.col("silhouette_squared"), -F.col("h"))).alias("best_silhouette_squared_eps"),
        F.max_by("eps", F.struct(F.col("calinski_harabasz"), -F.col("h"))).alias("best_ch_eps"),
        F.min_by("eps", F.struct(F.col("davies_bouldin"), F.col("h"))).alias("best_db_eps"))
    best = best.withColumn("mean_eps", (F.col("best_silhouette_squared_eps") + F.col("best_ch_eps") + F.col("best_db_eps")) / 3)
    overall = best.agg(F.avg("mean_eps").alias("overall_eps"))
    return best.join(F.broadcast(overall)).select(
        (F.col("lo") / 100).alias("range_lo"), (F.col("hi") / 100).alias("range_hi"),
        "best_silhouette_squared_eps", "best_ch_eps", "best_db_eps", R("mean_eps").alias("mean_eps"),
        R("overall_eps").alias("overall_eps"))
