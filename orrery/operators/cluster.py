"""Clustering and cluster evaluation (ML-13, ML-14, ML-17, AG-14..17,
WIN-1).

* Assignment to a small, size-checked centre set is an in-row expression
  (the centres are inlined, as ``KMeansModel`` ships its centres).
* Fitting from given rows (``lloyd``) is one Arrow-batched pass a round, until
  inertia stops falling.
* The exact silhouette needs every pairwise distance; a blocked kernel turns
  each (query block, reference block) tile into per-cluster sums, so only n x
  clusters rows ever leave a task - never the n^2 pairs.  With squared
  distances (``silhouette_squared``) a cluster's count, mean and variance give
  every mean in closed form, and the nearest other cluster comes from the
  pivot index: no pairs of points, no n x clusters rows.
* Davies-Bouldin compares only pairs of centres that can be a maximum, found
  through the pivot index.
"""

from __future__ import annotations

import math
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.functions import vectors as V
from orrery.operators import pivots
from orrery.operators.neighbors import centroids, inline_matrix
from orrery.session import cut_lineage, many, small_side


def _lit_matrix(matrix) -> Column:
    return F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in matrix])


def squared_distances(vec, matrix) -> Column:
    """Array of squared distances from ``vec`` to every inlined centre."""
    v = V.as_double(vec)
    return F.transform(_lit_matrix(matrix), lambda c: V.sq_euclidean(v, c))


def nearest_centre(vec, matrix) -> Column:
    """0-based index of the closest centre; ties go to the lowest index."""
    d = squared_distances(vec, matrix)
    return (F.array_position(d, F.array_min(d)) - 1).cast("int")


def assign(df: DataFrame, vec: str, matrix, out: str = "cluster") -> DataFrame:
    d = squared_distances(vec, matrix)
    return (df.withColumn("_d", d)
              .withColumn(out, (F.array_position("_d", F.array_min("_d")) - 1).cast("int"))
              .withColumn("sq_dist", F.array_min("_d")).drop("_d"))


def initial_centres(df: DataFrame, key: str, vec: str, k: int, seed: int = 0) -> list:
    """k distinct rows as initial centres, chosen by a seeded hash order of
    the key (repeatable, partition-independent)."""
    from orrery.operators.relational import hash_order
    d = (df.withColumn("_h", hash_order(key, seed))
           .groupBy(V.as_double(vec).alias("_v")).agg(F.min(F.struct("_h", key)).alias("_m")))
    rows = d.orderBy("_m").limit(k).collect()
    if len(rows) < k:
        raise ValueError("fewer distinct rows than clusters")
    return [list(r["_v"]) for r in rows]


def lloyd_step(df: DataFrame, vec: str, matrix):
    """One k-means step: assign to the nearest centre, then the new centres
    are the member means.  Returns (assigned frame, new centre frame)."""
    a = assign(df, vec, matrix)
    new = centroids(a.select("cluster", V.as_double(vec).alias("_v")), "cluster", "_v", "centre")
    return a, new


def _member_sums():
    def kernel(current):
        def run(batches):
            import numpy as np
            import pyarrow as pa
            sums = {k: np.zeros((k, len(m[0]) + 2)) for k, m in current.items()}  # sum of the members, their number, their cost
            for b in batches:
                x = b.column("_v").drop_null()
                x = np.asarray(x.flatten(), np.float64).reshape(len(x), -1)
                for k, m in current.items():
                    if not len(x):
                        break
                    d = np.stack([((x - c) ** 2).sum(1) for c in np.array(m)], 1)
                    near = d.argmin(1)
                    cost = d[np.arange(len(x)), near]
                    for c in np.unique(near):
                        at = near == c
                        sums[k][c] += [*x[at].sum(0), at.sum(), cost[at].sum()]
            rows = [(k, c, s) for k, m in sums.items() for c, s in enumerate(m.tolist()) if s[-2]]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                                              pa.array([r[2] for r in rows], pa.list_(pa.float64()))], names=["k", "c", "sums"])
        return run
    return kernel


def lloyd(df: DataFrame, vec: str, starts: dict[int, list], max_iter: int = 100) -> dict[int, list]:
    """ML-13 / ML-14: k-means from given rows, for several k at once.

    ``starts``: k -> its k initial centres.  Every round is one pass that
    serves all k: each row is assigned to its nearest centre of every k, and
    the member means become the new centres.  A centre without members
    stays.  A k ends when its inertia no longer falls, or after ``max_iter``
    rounds; the others go on without it.  A task adds its rows up to one row
    for each k and centre; only the centres' sums, bounded by the
    parameters, reach the driver."""
    current = {k: [list(c) for c in m] for k, m in starts.items()}
    least, running, kernel = {k: math.inf for k in current}, set(current), _member_sums()
    rows = df.select(V.as_double(vec).alias("_v"))
    for _ in range(max_iter):
        part = rows.mapInArrow(kernel({k: current[k] for k in sorted(running)}), "k int, c int, sums array<double>")
        cells = part.select("k", "c", F.posexplode("sums").alias("pos", "x")).groupBy("k", "c", "pos").agg(F.sum("x").alias("x"))
        sums = {(r["k"], r["c"], r["pos"]): r["x"] for r in cells.collect()}
        for k in sorted(running):
            dim = len(current[k][0])
            member = [c for c in range(k) if (k, c, dim) in sums]
            cost = math.fsum(sums[k, c, dim + 1] for c in member)
            if not cost < least[k]:
                running.discard(k)
                continue
            least[k] = cost
            for c in member:
                current[k][c] = [sums[k, c, i] / sums[k, c, dim] for i in range(dim)]
        if not running:
            break
    return current


def inertia(df: DataFrame, vec: str, matrix) -> Column:
    """AG-14: sum of squared distances to the nearest centre, all rows."""
    return F.sum(F.array_min(squared_distances(vec, matrix)))


def elbow(curve: DataFrame, k: str, score: str, threshold: float) -> DataFrame:
    """WIN-1: slopes s_i = score_{i+1} - score_i; the elbow is row i for the
    first i >= 1 with |s_{i-1}| - |s_i| > threshold, else the second row.
    The curve has one row per parameter value, so the global window is
    over a handful of rows."""
    w = Window.orderBy(k)
    c = (curve.withColumn("_i", F.row_number().over(w) - 1)
              .withColumn("_s", F.lead(score).over(w) - F.col(score)))
    c = c.withColumn("_prev", F.lag("_s").over(w))
    hit = c.filter((F.col("_i") >= 1) & F.col("_s").isNotNull() &
                   (F.abs("_prev") - F.abs("_s") > threshold)).agg(F.min("_i").alias("_e"))
    fallback = F.lit(1)
    pick = hit.select(F.coalesce("_e", fallback).alias("_pick"))
    return c.join(F.broadcast(pick), F.col("_i") == F.col("_pick")).select(k, score)


# --------------------------------------------------- AG-15 silhouette ----

def _all_distances(q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Euclidean distances of all pairs, by one product; pairs so close that
    its error would count are measured by their differences."""
    if q.shape[1] < 8 or not (np.isfinite(q).all() and np.isfinite(r).all()):
        return pivots.pair_distances("euclidean", q, r)
    centre = r.mean(0)
    qc, rc = q - centre, r - centre
    q2, r2 = (qc * qc).sum(1), (rc * rc).sum(1)
    d = qc @ (-2.0 * rc).T
    d += q2[:, None]
    d += r2
    close = 8e6 * (q.shape[1] + 4) * np.finfo(float).eps * (q2 + r2.max())
    at = np.flatnonzero(d <= close[:, None])
    np.maximum(d, 0, out=d)
    np.sqrt(d, out=d)
    row, col = np.divmod(at, len(r))
    for a in range(0, len(at), 100_000):
        e = slice(a, a + 100_000)
        d[row[e], col[e]] = np.sqrt(((q[row[e]] - r[col[e]]) ** 2).sum(1))
    return d


def _cluster_sums(n_sets: int):
    def fn(qpdf: pd.DataFrame, rpdf: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"q_id": pd.Series([], dtype="int64"), "s": pd.Series([], dtype="int32"),
                              "r_cluster": pd.Series([], dtype="int64"), "dsum": pd.Series([], dtype="float64"),
                              "cnt": pd.Series([], dtype="int64")})
        if len(qpdf) == 0 or len(rpdf) == 0:
            return empty
        qm = np.vstack(qpdf["q_vec"].to_numpy()).astype(np.float64)
        rm = np.vstack(rpdf["r_vec"].to_numpy()).astype(np.float64)
        qids = qpdf["q_id"].to_numpy(np.int64)
        rl = np.vstack(rpdf["r_lab"].to_numpy()).astype(np.int64)  # nr x n_sets
        out = []
        by_label = np.argsort(rl[:, 0], kind="stable")
        rm, rl = rm[by_label], rl[by_label]  # the first labelling lies in order
        step = max(1, 1_000_000 // max(1, len(rm)))
        for s0 in range(0, len(qm), step):
            q = qm[s0:s0 + step]
            d = _all_distances(q, rm)
            for si in range(n_sets):
                order = np.argsort(rl[:, si], kind="stable")
                sorted_lab = rl[order, si]
                labs, starts, cnts = np.unique(sorted_lab, return_index=True, return_counts=True)
                sums = np.add.reduceat(d if si == 0 else d[:, order], starts, axis=1)
                nq = len(q)
                out.append(pd.DataFrame({
                    "q_id": np.repeat(qids[s0:s0 + step], len(labs)),
                    "s": np.full(nq * len(labs), si, dtype=np.int32),
                    "r_cluster": np.tile(labs, nq),
                    "dsum": sums.ravel(),
                    "cnt": np.tile(cnts, nq)}))
        return pd.concat(out) if out else empty
    return fn


def silhouette(df: DataFrame, key: str, vec: str, labels: str, block_rows: int | None = None,
               ref_block_rows: int | None = None) -> DataFrame:
    """AG-15 exact: per labelling set s (``labels`` is an array column, one
    cluster id per set) the mean over points of (b - a) / max(a, b), a =
    mean distance to the other members of its cluster, b = smallest mean
    distance to another cluster; points alone in their cluster score 0.
    Returns (s, silhouette).

    Query blocks are small (parallelism), reference blocks large: every
    tile emits one partial row per query point and cluster, so fewer
    reference blocks means fewer partial rows to shuffle.  Both grow with the
    table within bounds; the distances stay n^2."""
    p = df.select(F.col(key).cast("long").alias("id"), V.as_double(vec).alias("v"),
                  F.col(labels).cast("array<long>").alias("lab"))
    n_sets = len(p.first()["lab"])
    n = p.count()
    nq = max(1, math.ceil(n / (block_rows or max(1024, min(16384, math.ceil(n / 16))))))
    nr = max(1, math.ceil(n / (ref_block_rows or max(16384, min(65536, math.ceil(n / 16))))))
    q = (p.select(F.col("id").alias("q_id"), F.col("v").alias("q_vec"))
          .withColumn("qb", F.pmod(F.xxhash64("q_id"), F.lit(nq)).cast("int"))
          .withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(nr - 1)))))
    r = (p.select(F.col("id").alias("r_id"), F.col("v").alias("r_vec"), F.col("lab").alias("r_lab"))
          .withColumn("rb", F.pmod(F.xxhash64("r_id"), F.lit(nr)).cast("int"))
          .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nq - 1)))))
    sums = (q.groupBy("qb", "rb").cogroup(r.groupBy("qb", "rb"))
              .applyInPandas(_cluster_sums(n_sets),
                             "q_id long, s int, r_cluster long, dsum double, cnt long"))
    tot = sums.groupBy("q_id", "s", "r_cluster").agg(F.sum("dsum").alias("dsum"), F.sum("cnt").alias("cnt"))
    own = p.select(F.col("id").alias("q_id"), F.posexplode("lab").alias("s", "own"))
    j = tot.join(own, ["q_id", "s"])
    per = j.groupBy("q_id", "s").agg(
        F.max(F.when(F.col("r_cluster") == F.col("own"), F.try_divide(F.col("dsum"), F.col("cnt") - 1))).alias("a"),
        F.max(F.when(F.col("r_cluster") == F.col("own"), F.col("cnt"))).alias("n_own"),
        F.min(F.when(F.col("r_cluster") != F.col("own"), F.col("dsum") / F.col("cnt"))).alias("b"))
    # a point alone in its cluster, or on top of all others, scores 0
    sil = F.when(F.col("n_own") <= 1, F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return per.groupBy("s").agg(F.avg(sil).alias("silhouette"))


# ------------------------------------------------------ AG-16 / AG-17 ----

def _grouped(df: DataFrame, groups: Sequence[str]):
    if groups:
        return df, list(groups)
    return df.withColumn("_grp", F.lit(0)), ["_grp"]


def _centres(pts: DataFrame, g: list) -> DataFrame:
    ex = pts.select(*g, "_c", F.posexplode("_v").alias("_pos", "_x"))
    m = ex.groupBy(*g, "_c", "_pos").agg(F.avg("_x").alias("_x"), F.count(F.lit(1)).alias("_n"))
    return m.groupBy(*g, "_c").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_x"))), lambda t: t["_x"]).alias("_cv"),
        F.max("_n").alias("_n"))


def calinski_harabasz(df: DataFrame, vec: str, cluster: str, groups: Sequence[str] = ()) -> DataFrame:
    """AG-16: [B / (k - 1)] / [W / (n - k)], B = size-weighted squared
    distances of cluster centres to the overall centre, W = squared
    distances of points to their own centre (1.0 when W = 0).  Partial
    aggregates over (group, cluster, dimension); centres joined on keys."""
    d, g = _grouped(df, groups)
    pts = d.select(*g, F.col(cluster).alias("_c"), V.as_double(vec).alias("_v"))
    cen = _centres(pts, g)
    allc = _centres(pts.withColumn("_c", F.lit(0)), g).select(*g, F.col("_cv").alias("_ov"))
    within = (pts.join(cen, [*g, "_c"]).groupBy(*g)
                 .agg(F.sum(V.sq_euclidean("_v", "_cv")).alias("W"),
                      F.count(F.lit(1)).alias("n")))
    between = (cen.join(allc, g).groupBy(*g)
                  .agg(F.sum(F.col("_n") * V.sq_euclidean("_cv", "_ov")).alias("B"),
                       F.count(F.lit(1)).alias("k")))
    j = within.join(between, g)
    ch = F.when(F.col("W") == 0, F.lit(1.0)).otherwise(
        F.try_divide(F.col("B") * (F.col("n") - F.col("k")), F.col("W") * (F.col("k") - 1)))
    out = j.select(*g, ch.alias("calinski_harabasz"))
    return out if groups else out.drop("_grp")


#: so many centres are compared pair by pair
PAIRED = 1000


def _apart(pts: DataFrame, vec: str) -> float:
    """A step so wide that a coordinate of (number x step) keeps the points
    of different numbers farther apart than any two of one number."""
    ends = (pts.select(F.posexplode(vec).alias("p", "x")).groupBy("p").agg((F.max("x") - F.min("x")).alias("w"))
            .agg(F.coalesce(F.sum(F.col("w") * F.col("w")), F.lit(0.0)).alias("d2")).first()["d2"])
    return 4.0 * math.sqrt(ends) + 1.0


def _nearest_other(sets: dict):
    """Rows (e, c, v) -> smallest mean squared distance to a cluster of e
    other than c (null if there is none).  ``sets``: e -> (numbers, means,
    variances)."""
    matrix = pivots._matrix

    def run(batches):
        import numpy as np
        import pyarrow as pa
        for b in batches:
            e, c = np.asarray(b.column("_e")), np.asarray(b.column("_c"))
            v, best = matrix(b.column("_v")), np.full(b.num_rows, np.inf)
            for x in np.unique(e):
                names, means, variance = sets[int(x)]
                at = np.flatnonzero(e == x)
                step = max(1, 2_000_000 // means.size)
                for s in range(0, len(at), step):
                    i = at[s:s + step]
                    d = ((v[i][:, None, :] - means[None]) ** 2).sum(2) + variance
                    best[i] = np.where(names[None] == c[i][:, None], np.inf, d).min(1)
            yield pa.RecordBatch.from_arrays([b.column("_e"), b.column("_n"), b.column("_a"), pa.array(best, mask=np.isinf(best))],
                                             names=["_e", "_n", "_a", "_b"])
    return run


def silhouette_squared(df: DataFrame, vec: str, cluster: str, group: str | None = None,
                       inline_values: int = pivots.MAX_VALUES) -> DataFrame:
    """AG-15 on squared Euclidean distances, for the labelling of each group:
    mean of (b - a) / max(a, b) with mean squared distances.

    For a cluster of n members with mean m and variance v (mean squared
    distance to m) the mean squared distance of a point x to its members is
    |x - m|^2 + v, and n / (n - 1) times that without x itself.  The means of
    all clusters travel with the tasks while they have at most
    ``inline_values`` numbers.  Beyond that the smallest value among other
    clusters is the nearest of the points (m, sqrt(v)) to (x, 0): a search for
    two neighbours in the pivot index, the own cluster being one of them at
    most.  Members of single-point clusters score 0."""
    d, g = _grouped(df, [group] if group else [])
    e = g[0]
    numbers = small_side(d.select(e).distinct().withColumn("_e", F.row_number().over(Window.orderBy(e)) - 1))
    pts = d.join(numbers, e).select("_e", F.col(cluster).cast("long").alias("_c"), V.as_double(vec).alias("_v"))
    cen = _centres(pts, ["_e"])
    own = cut_lineage(pts.join(cen, ["_e", "_c"]).withColumn("_d2", V.sq_euclidean("_v", "_cv")))
    sets = cut_lineage(own.groupBy("_e", "_c").agg(F.avg("_d2").alias("_var"), F.first("_cv").alias("_cv")))
    size = sets.agg(F.coalesce(F.sum(F.size("_cv")), F.lit(0)).alias("n")).first()["n"]
    own = own.join(small_side(sets.select("_e", "_c", "_var")), ["_e", "_c"]).withColumn(
        "_a", F.try_divide(F.col("_n") * (F.col("_d2") + F.col("_var")), F.col("_n") - 1))
    if size <= inline_values:
        rows = {}
        for r in sets.orderBy("_e", "_c").collect():
            rows.setdefault(r["_e"], []).append((r["_c"], r["_cv"], r["_var"]))
        held = {x: tuple(np.array(col) for col in zip(*rs)) for x, rs in rows.items()}
        s = own.select("_e", "_c", "_v", "_n", "_a").mapInArrow(_nearest_other(held), "_e int, _n long, _a double, _b double")
    else:
        step = F.lit(2 * _apart(own, "_v"))  # a standard deviation is no wider than the box
        lifted = lambda v, z: F.concat(F.col(v), F.array(z, F.col("_e") * step))
        sets = cut_lineage(sets.withColumn("_r", F.monotonically_increasing_id()))
        own = cut_lineage(own.withColumn("_q", F.monotonically_increasing_id()))
        index = pivots.build(sets.withColumn("_x", lifted("_cv", F.sqrt("_var"))), "_r", "_x")
        near = pivots.nearest(own.withColumn("_x", lifted("_v", F.lit(0.0))), index, 2, "_q", "_x").filter("tested is null")
        other = (near.join(sets.select(F.col("_r").alias("r_id"), F.col("_e").alias("_re"), F.col("_c").alias("_rc")), "r_id")
                 .join(many(own.select(F.col("_q").alias("q_id"), "_e", "_c")), "q_id").filter("_e = _re and _c != _rc")
                 .groupBy(F.col("q_id").alias("_q")).agg(F.min(F.col("dist") * F.col("dist")).alias("_b")))
        s = own.join(many(other), "_q", "left")
    sil = F.when(F.col("_n") <= 1, F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("_b") - F.col("_a"), F.greatest("_a", "_b")), F.lit(0.0)))
    out = s.groupBy("_e").agg(F.avg(sil).alias("silhouette")).join(numbers, "_e").drop("_e")
    return out if group else out.drop("_grp")


def davies_bouldin(df: DataFrame, vec: str, cluster: str, groups: Sequence[str] = ()) -> DataFrame:
    """AG-17: mean over clusters i of max_{j != i} (s_i + s_j) / d(c_i, c_j),
    s = mean distance of members to their centre; centres that coincide take
    no part in each other's maximum.

    Not all pairs of centres: the nearest few of each give a first value t_i,
    and a better j must lie within (s_i + s_j) / t_i.  Clusters are classed
    by powers of two of s, so that this limit is known for a class, and the
    pivot index yields the centres of each class within it.  Up to
    ``PAIRED`` centres are simply paired."""
    d, g = _grouped(df, groups)
    pts = d.select(*g, F.col(cluster).alias("_c"), V.as_double(vec).alias("_v"))
    cen = _centres(pts, g)
    sc = pts.join(cen, [*g, "_c"]).groupBy(*g, "_c").agg(F.avg(V.euclidean("_v", "_cv")).alias("_s"))
    numbers = small_side(pts.select(*g).distinct().withColumn("_e", F.row_number().over(Window.orderBy(*g)) - 1))
    cs = cut_lineage(cen.join(sc, [*g, "_c"]).join(numbers, g).withColumn("_i", F.monotonically_increasing_id()).drop("_n"))
    if cs.count() <= PAIRED:
        a = cs.select(*g, F.col("_i").alias("_a"), F.col("_cv").alias("_va"), F.col("_s").alias("_sa"))
        r = cs.join(F.broadcast(a), g).filter("_i != _a").withColumn("_r", F.coalesce(
            F.try_divide(F.col("_s") + F.col("_sa"), V.euclidean("_cv", "_va")), F.lit(0.0)))
        out = r.groupBy(*g, "_i").agg(F.max("_r").alias("_m")).groupBy(*g).agg(F.avg("_m").alias("davies_bouldin"))
        return out if groups else out.drop("_grp")
    # classes of s: 0, and one for each power of two down to 2^-60 of the largest
    top = F.lit(cs.agg(F.max("_s")).first()[0])
    cs = cs.withColumn("_k", F.when(F.col("_s") > 0, F.least(F.floor(F.log2(top / F.col("_s"))), F.lit(60)) + 1)
                       .otherwise(F.lit(0)).cast("int"))
    half = _apart(cs, "_cv")
    step = F.lit(2 * half)
    ref = small_side(cs.select(F.col("_i").alias("r_id"), F.col("_e").alias("_re"), F.col("_s").alias("_sj"), F.col("_k").alias("_rk")))
    value = F.try_divide(F.col("_s") + F.col("_sj"), F.col("dist"))
    at = lambda k: F.concat("_cv", F.array(F.col("_e") * step, k * step))
    x = cs.withColumn("_x", at(F.lit(0)))
    near = pivots.nearest(x, pivots.build(x, "_i", "_x"), 4, "_i", "_x", exclude_self=True).filter("tested is null")
    own = cs.select(F.col("_i").alias("q_id"), "_e", "_s")
    first = (near.join(own, "q_id").join(ref, "r_id").filter("_e = _re and dist > 0")
             .groupBy(F.col("q_id").alias("_i")).agg(F.max(value).alias("_t")))
    tops = cs.groupBy("_k").agg(F.max("_s").alias("_most")).select(F.col("_k").alias("_rk"), "_most")  # at most 62 rows
    q = (cs.join(first, "_i", "left").crossJoin(F.broadcast(tops))
         .withColumn("_limit", F.least(F.lit(half), F.coalesce(F.try_divide(F.col("_s") + F.col("_most"), F.col("_t")), F.lit(half))))
         .withColumn("_x", at(F.col("_rk"))))
    q = cut_lineage(q.select("_i", "_x", F.col("_limit") * (1 + 1e-9)).toDF("_i", "_x", "_limit"))
    index = pivots.build(cs.withColumn("_x", at(F.col("_k"))), "_i", "_x")
    pairs = pivots.within(q, index, "_limit", "_i", "_x").filter("tested is null and dist > 0")
    worst = (pairs.join(own, "q_id").join(ref, "r_id").groupBy(F.col("q_id").alias("_i")).agg(F.max(value).alias("_m")))
    out = (cs.join(worst, "_i", "left").groupBy(*g)
           .agg(F.when(F.count(F.lit(1)) > 1, F.avg(F.coalesce("_m", F.lit(0.0)))).alias("davies_bouldin")))
    out = out.filter("davies_bouldin is not null")
    return out if groups else out.drop("_grp")
