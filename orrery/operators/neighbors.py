"""Exact nearest-neighbour and distance-to-set operators (JN-1, JN-2, ML-12,
ORD-3, NUL-3).

Neighbours under a metric come through the pivot index of ``pivots``.  The
cosine distance does not obey the triangle inequality; it is a block nested
loop that is never materialised as pair rows: query and reference rows are
dealt into blocks by a hash of their id, every pair of blocks is one bounded
group, a NumPy kernel keeps the ``k`` best per query, and the blocks'
candidates are merged.  Distance-to-centroid work (JN-1) uses a small,
size-checked centre matrix that is inlined into the plan, as ``KMeansModel``
does.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orrery.functions import vectors as V
from orrery.operators import pivots

_MAX_INLINE_VALUES = 200_000  # centres x dims that may be inlined in a plan


def _pair_distances(qm: np.ndarray, rm: np.ndarray, metric: str) -> np.ndarray:
    if metric == "cosine":  # a zero vector is at distance 1 from all
        qn = np.linalg.norm(qm, axis=1)[:, None]
        rn = np.linalg.norm(rm, axis=1)[None, :]
        return 1.0 - (qm / np.where(qn == 0, 1, qn)) @ (rm / np.where(rn == 0, 1, rn).T).T
    raise ValueError(f"unknown metric {metric}")


def _nearest_squared(qm: np.ndarray, rm: np.ndarray, kk: int, own: np.ndarray):
    """(query row, reference row, squared distance) of the ``kk`` nearest.

    The product form |q|^2 + |r|^2 - 2qr is fast but cancels; its error is
    bounded by the lengths involved.  Every reference that may be among the
    nearest within that bound is measured again by its differences."""
    centre = rm.mean(0)
    qc, rc = qm - centre, rm - centre
    q2, r2 = (qc * qc).sum(1), (rc * rc).sum(1)
    d2 = q2[:, None] + r2[None, :] - 2.0 * qc @ rc.T
    d2[own] = np.inf
    error = 8 * (qm.shape[1] + 4) * np.finfo(float).eps * (q2 + r2.max())
    cut = np.partition(d2, kk - 1, axis=1)[:, kk - 1] + 2 * error
    row, col = np.nonzero((d2 <= cut[:, None]) & ~own)
    exact = ((qm[row] - rm[col]) ** 2).sum(1)
    by = np.lexsort((col, exact, row))
    row, col, exact = row[by], col[by], exact[by]
    keep = np.arange(len(row)) - np.searchsorted(row, row, "left") < kk
    return row[keep], col[keep], exact[keep]


def _nearest_cosine(qm: np.ndarray, rm: np.ndarray, kk: int, own):
    """(query row, reference row, distance) of the ``kk`` nearest by cosine;
    ``own``: (rows, columns) left out.  A product of narrow numbers leaves those
    that may be among them, its error included, to be measured again."""
    qn, rn = (m / np.where((size := np.linalg.norm(m, axis=1)) == 0, 1, size)[:, None] for m in (qm, rm))
    d = qn.astype(np.float32) @ -np.ascontiguousarray(rn.astype(np.float32).T)
    d[own] = np.inf
    cut = np.partition(d, kk - 1, axis=1)[:, kk - 1] + 32 * (qm.shape[1] + 4) * np.finfo(np.float32).eps
    row, col = np.divmod(np.flatnonzero((d <= cut[:, None].astype(np.float32)) & (d < np.inf)), len(rm))
    exact = 1.0 - np.concatenate([(qn[row[a:a + 100_000]] * rn[col[a:a + 100_000]]).sum(1) for a in range(0, max(1, len(row)), 100_000)])
    by = np.lexsort((col, exact, row))
    row, col, exact = row[by], col[by], exact[by]
    keep = np.arange(len(row)) - np.searchsorted(row, row, "left") < kk
    return row[keep], col[keep], exact[keep]


def _local_topk(k: int, metric: str, exclude_self: bool):
    def fn(qpdf: pd.DataFrame, rpdf: pd.DataFrame) -> pd.DataFrame:
        cols = {"q_id": [], "r_id": [], "dist": []}
        if len(qpdf) == 0 or len(rpdf) == 0:
            return pd.DataFrame({"q_id": pd.Series([], dtype="int64"), "r_id": pd.Series([], dtype="int64"),
                                 "dist": pd.Series([], dtype="float64")})
        rpdf = rpdf.sort_values("r_id", kind="stable")
        rids = rpdf["r_id"].to_numpy(np.int64)
        rm = np.vstack(rpdf["r_vec"].to_numpy()).astype(np.float64)
        qids = qpdf["q_id"].to_numpy(np.int64)
        qm_all = np.vstack(qpdf["q_vec"].to_numpy()).astype(np.float64)
        step = max(1, min(len(qids), 2_000_000 // max(1, len(rids))))  # a bounded distance tile
        kk = min(k, len(rids))
        finite = metric == "cosine" and np.isfinite(rm).all() and np.isfinite(qm_all).all()
        for s in range(0, len(qids), step):
            qm = qm_all[s:s + step]
            qi = qids[s:s + step]
            if finite:
                first, last = np.searchsorted(rids, qi, "left"), np.searchsorted(rids, qi, "right")
                at = np.repeat(np.arange(len(qi)), (last - first) * exclude_self)
                place = np.arange(len(at)) - np.searchsorted(at, at, "left") + first[at]
                row, col, dist = _nearest_cosine(qm, rm, kk, (at, place))
                cols["q_id"].append(qi[row])
                cols["r_id"].append(rids[col])
                cols["dist"].append(dist)
                continue
            own = (qi[:, None] == rids[None, :]) & exclude_self
            d = _pair_distances(qm, rm, metric)
            order = np.argsort(np.where(own, np.inf, d), axis=1, kind="stable")[:, :kk]
            keep = ~np.take_along_axis(own, order, axis=1).ravel()
            row = np.repeat(np.arange(len(qi)), kk)[keep]
            col = order.ravel()[keep]
            dist = d[row, col]
            cols["q_id"].append(qi[row])
            cols["r_id"].append(rids[col])
            cols["dist"].append(dist)
        return pd.DataFrame({c: np.concatenate(v) for c, v in cols.items()})
    return fn


def knn(query: DataFrame, ref: DataFrame, k: int, *, q_id: str, r_id: str,
        q_vec: str, r_vec: str, metric: str = "euclidean",
        exclude_self: bool = False, block_rows: int | None = None,
        ref_block_rows: int | None = None) -> DataFrame:
    """Exact k nearest reference rows for every query row.

    Returns ``(q_id, r_id, dist, rank)`` with rank 1..k ordered by distance
    then reference id.  ``exclude_self`` drops pairs with equal ids (use it
    when query and reference are the same set).  Metrics that obey the
    triangle inequality go through the pivot index, the cosine distance
    through all blocks.
    """
    if metric in pivots.METRICS:
        index = pivots.build(ref, r_id, r_vec, metric, keep_ids=k + int(exclude_self), shelf_rows=ref_block_rows, share=8)
        local = pivots.nearest(query, index, k, q_id, q_vec, exclude_self, block_rows).filter("tested is null").drop("tested")
        if metric == "sqeuclidean":
            local = local.withColumn("dist", F.col("dist") * F.col("dist"))
    else:
        local = _all_blocks(query, ref, k, q_id, r_id, q_vec, r_vec, metric, exclude_self, block_rows, ref_block_rows)
    w = Window.partitionBy("q_id").orderBy("dist", "r_id")
    ranked = local.withColumn("rank", F.row_number().over(w).cast("long"))
    return ranked.filter(F.col("rank") <= k)


def _all_blocks(query: DataFrame, ref: DataFrame, k: int, q_id: str, r_id: str, q_vec: str, r_vec: str, metric: str,
                exclude_self: bool, block_rows: int | None, ref_block_rows: int | None) -> DataFrame:
    q = query.select(F.col(q_id).cast("long").alias("q_id"), V.as_double(q_vec).alias("q_vec"))
    r = ref.select(F.col(r_id).cast("long").alias("r_id"), V.as_double(r_vec).alias("r_vec"))
    nq, nr = q.count(), r.count()
    # small query blocks for parallelism, large reference blocks so each
    # query point gets few local top-k lists to merge; both grow with the
    # tables within bounds, so that the copies of a row do not
    block_rows = block_rows or max(1024, min(16384, math.ceil(nq / 16)))
    ref_block_rows = ref_block_rows or max(16384, min(65536, math.ceil(nr / 16)))
    qb = max(1, math.ceil(nq / block_rows))
    rb = max(1, math.ceil(nr / ref_block_rows))
    qx = (q.withColumn("qb", F.pmod(F.xxhash64("q_id"), F.lit(qb)).cast("int"))
           .withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(rb - 1)))))
    rx = (r.withColumn("rb", F.pmod(F.xxhash64("r_id"), F.lit(rb)).cast("int"))
           .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(qb - 1)))))
    return (qx.groupBy("qb", "rb").cogroup(rx.groupBy("qb", "rb"))
            .applyInPandas(_local_topk(k, metric, exclude_self), "q_id long, r_id long, dist double"))


def knn_vote(neigh: DataFrame, ref_labels: DataFrame, r_id: str, label: str,
             weights: str = "uniform", out: str = "prediction") -> DataFrame:
    """ML-12 vote: majority label of the neighbours (ties -> smallest label).

    ``weights="distance"`` weighs by 1/d; if a neighbour sits at distance 0
    only the zero-distance neighbours vote (the library's rule).
    """
    j = neigh.join(ref_labels.select(F.col(r_id).cast("long").alias("r_id"), F.col(label).alias("_lab")),
                   "r_id")
    if weights == "uniform":
        j = j.withColumn("_w", F.lit(1.0))
    else:
        has0 = F.max((F.col("dist") == 0).cast("int")).over(Window.partitionBy("q_id"))
        j = j.withColumn("_w", F.when(has0 == 1, (F.col("dist") == 0).cast("double"))
                         .otherwise(1.0 / F.col("dist")))
    s = j.groupBy("q_id", "_lab").agg(F.sum("_w").alias("_s"))
    return s.groupBy("q_id").agg(
        F.min_by(F.col("_lab"), F.struct(-F.col("_s"), F.col("_lab"))).alias(out))


def centroids(df: DataFrame, key: str, vec: str, out: str = "centroid") -> DataFrame:
    """Element-wise mean vector per group: ``posexplode`` + partial
    aggregate per (group, position), then one small array per group."""
    ex = df.select(key, F.posexplode(V.as_double(vec)).alias("pos", "x"))
    m = ex.groupBy(key, "pos").agg(F.avg("x").alias("x"))
    return m.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias(out))


def inline_matrix(centres: DataFrame, key: str, vec: str):
    """Collect a centre table for use as a literal.  For tables that a
    parameter bounds (k centres, labels); ``distances_to_centres`` takes any."""
    rows = centres.orderBy(key).collect()
    return [r[key] for r in rows], [[float(x) for x in r[vec]] for r in rows]


def distances_to_centres(df: DataFrame, id_col: str, vec: str, centres: DataFrame, key: str, cvec: str,
                         metric: str = "euclidean", out: str = "distances", inline_values: int = _MAX_INLINE_VALUES,
                         block_rows: int = 4096) -> DataFrame:
    """JN-1: distances from every row to every centre, ordered by ``key``.

    Centres of up to ``inline_values`` numbers are part of the plan.  Larger
    sets are dealt into blocks, each row meets each block once, and the
    blocks' distance arrays are put together in key order: the same answer."""
    size = centres.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size(cvec)), F.lit(0)).alias("v")).first()
    if size["v"] <= inline_values:
        keys, m = inline_matrix(centres, key, cvec)
        return distances_to_set(df, vec, keys, m, metric, out)
    blocks = math.ceil(size["n"] / block_rows)
    packed = (centres.select(F.pmod(F.xxhash64(key), F.lit(blocks)).alias("_b"), F.struct(F.col(key).alias("k"), V.as_double(cvec).alias("c")).alias("s"))
              .groupBy("_b").agg(F.collect_list("s").alias("_set")))
    fn = V.METRICS[metric]
    row = (df.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"), V.as_double(vec).alias("_v"))
           .withColumn("_b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))))
    part = row.join(packed, "_b").select("_id", "_row", F.transform("_set", lambda s: F.struct(s["k"].alias("k"), fn(F.col("_v"), s["c"]).alias("d"))).alias("_d"))
    whole = part.groupBy("_id").agg(F.first("_row").alias("_row"), F.sort_array(F.flatten(F.collect_list("_d"))).alias("_d"))
    return whole.select("_row.*", F.transform("_d", lambda s: s["d"]).alias(out))


def distances_to_set(df: DataFrame, vec: str, keys, matrix, metric: str = "euclidean",
                     out: str = "distances") -> DataFrame:
    """JN-1 / VEC-5 set-to-set: distance from every row to every centre of a
    small inlined set, one array per row (ordered like ``keys``)."""
    lit_m = F.array(*[F.array(*[F.lit(x) for x in row]) for row in matrix])
    fn = V.METRICS[metric]
    return df.withColumn(out, F.transform(lit_m, lambda c: fn(V.as_double(vec), c)))
