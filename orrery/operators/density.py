"""Density clustering from one tree (ML-15 in any dimension, ML-16, WIN-2).

A point's core distance is that to its ``min_samples``-th nearest point
(itself included); the mutual reachability of two points is the largest of
their core distances and their distance.  A minimum spanning tree of mutual
reachability holds the clusters of every eps at once: cut the edges longer
than eps, drop the points whose core distance exceeds it, and what hangs
together is a cluster.

* Core distances and border points come from the exact neighbours of the
  pivot index: a point that is not core at eps has fewer than ``min_samples``
  points within eps, so all of them are among its nearest.
* The tree (up to the largest eps asked for) is the spanning forest of the
  union of the forests of parts of its edges.  Every point is copied to the
  shelves of the index that its ball of the largest eps reaches; each (shelf,
  block of copies) tile keeps only a forest, at most one edge for each of its
  points.  In few dimensions its points lie in boxes, and boxes that already
  hang together are not measured (``near_forest``).
* The tiles' forests are merged in rounds of the cheapest edge of every
  component, which at least halve the components, until what is left is
  small enough to finish in one task (``bound`` edges).

Points with equal vectors are one node with that many points.  From ``BOXED``
dimensions on distances within a ball of the largest eps are measured pair by
pair (never kept).
"""

from __future__ import annotations

import math
from typing import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orrery.functions import vectors as V
from orrery.operators import pivots
from orrery.operators.dbscan import connected_components
from orrery.operators.splits import group_index
from orrery.session import cut_lineage, many

BOUND = 2_000_000
BOXED = 8  # dimensions from which on boxes of points rule little out
_EDGE = "a long, b long, w double"


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node of every node's component."""
    root = np.arange(n)
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        if (low == high).all():
            return root
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]


def forest(a: np.ndarray, b: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Places of the edges of a minimum spanning forest; ties go to the
    smaller (w, a, b), so that forests of parts fit together."""
    lo, hi = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((hi, lo, w))
    names, ends = np.unique(np.concatenate([lo[order], hi[order]]), return_inverse=True)
    u, v = ends[:len(w)], ends[len(w):]
    comp, rank, kept = np.arange(len(names)), np.arange(len(w)), []
    while True:
        open_ = comp[u] != comp[v]
        u, v, rank = u[open_], v[open_], rank[open_]
        if not len(rank):
            return order[np.concatenate(kept)] if kept else np.zeros(0, np.int64)
        best = np.full(len(names), len(w))
        np.minimum.at(best, comp[u], rank)
        np.minimum.at(best, comp[v], rank)
        chosen = np.unique(best[best < len(w)])
        kept.append(chosen)
        at = np.searchsorted(rank, chosen)
        comp = _roots(len(names), comp[u[at]], comp[v[at]])[comp]


def _compact(x: np.ndarray, most: int) -> list[np.ndarray]:
    """Places of the rows in groups of at most ``most``, halved along the
    widest side."""
    todo, groups = [np.arange(len(x))] if len(x) else [], []
    while todo:
        at = todo.pop()
        if len(at) <= most:
            groups.append(at)
            continue
        side = int(np.ptp(x[at], axis=0).argmax())
        at, half = at[np.argsort(x[at, side], kind="stable")], len(at) // 2
        todo += [at[half:], at[:half]]
    return groups


def _lightest(row, col, w, u, v):
    """Of the pairs of components u[row], v[col] only the lightest."""
    (un, u), (vn, v) = (np.unique(c, return_inverse=True) for c in (u, v))
    least = np.full((len(un), len(vn)), np.inf)
    np.minimum.at(least, (u[row], v[col]), w)
    keep = w == least[u[row], v[col]]
    return row[keep], col[keep], w[keep]


def near_forest(metric: str, limit: float, ids: np.ndarray, core: np.ndarray, x: np.ndarray, own: int, group: int = 256):
    """Forest of the mutual reachabilities up to ``limit`` among the first
    ``own`` points and between them and the others: (a, b, w).

    The points lie in small boxes.  ``limit`` is approached in steps of two,
    from about the core distances on: a step measures the pairs of boxes that
    may hold an edge of its length, except where all points of both already
    hang together, and keeps the lightest edge of any two components.  So in a
    dense spot points are measured against their neighbourhood, not against
    all within ``limit``."""
    distances = pivots.pair_distances
    boxes = _compact(x[:own], group)
    mine = len(boxes)
    boxes += [own + g for g in _compact(x[own:], group)]
    out = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    if not mine:
        return out
    low, high, least = (np.array([f(c[g], axis=0) for g in boxes]) for f, c in ((np.min, x), (np.max, x), (np.min, core)))
    left, right, bound = [], [], []
    for i in range(mine):
        gap = np.maximum(np.maximum(low[i:] - high[i], low[i] - high[i:]), 0)
        d = np.sqrt((gap * gap).sum(1)) if metric == "euclidean" else gap.sum(1) if metric == "manhattan" else gap.max(1)
        d = np.maximum(np.maximum(d * (1 - 1e-9), least[i:]), least[i])
        near = np.flatnonzero(d <= limit)
        left.append(np.full(len(near), i))
        right.append(near + i)
        bound.append(d[near])
    left, right, bound = (np.concatenate(c) for c in (left, right, bound))
    steps, t = [], max(2 * float(np.median(core)), limit / 64)
    while t < limit:
        steps.append(t)
        t *= 2
    comp = np.arange(len(x))
    for t in [*steps, limit]:
        lowest, highest = (np.array([f(comp[g]) for g in boxes]) for f in (np.min, np.max))
        whole = (lowest[left] == highest[right]) & (highest[left] == lowest[right]) & (lowest[left] == highest[left])
        edges, held = [], 0
        for n in np.flatnonzero((bound <= t) & ~whole):
            a, b = boxes[left[n]], boxes[right[n]]
            w = np.maximum(np.maximum(distances(metric, x[a], x[b]), core[a][:, None]), core[b][None])
            open_ = (w <= t) & (comp[a][:, None] != comp[b][None])
            row, col = np.divmod(np.flatnonzero(open_), len(b))
            if not len(row):
                continue
            row, col, w = _lightest(row, col, w[row, col], comp[a], comp[b])
            edges.append((a[row], b[col], w))
            held += len(row)
            if held > 1_000_000:
                edges, held = [_least(comp, edges)], 0
        if edges:
            a, b, w = _least(comp, edges)
            comp = _roots(len(x), comp[a], comp[b])[comp]
            out = [np.concatenate(c) for c in zip(out, (ids[a], ids[b], w))]
    return out


def _least(comp, edges):
    a, b, w = (np.concatenate(c) for c in zip(*edges))
    keep = forest(comp[a], comp[b], w)
    return a[keep], b[keep], w[keep]


def wide_forest(metric: str, limit: float, qid, qc, q, rid, rc, r):
    """Forest of the mutual reachabilities up to ``limit`` of queries and
    entries, each pair with the smaller id among the queries, where boxes rule
    nothing out (many dimensions): pairs come block by block and meet the
    forest so far; those it already joins by shorter edges are dropped."""
    names, place = np.unique(np.concatenate([qid, rid]), return_inverse=True)
    of_q, of_r = place[:len(qid)], place[len(qid):]
    kept = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    parts, held, cuts_ = [], 0, []

    def merged():
        a, b, w = (np.concatenate(c) for c in zip(kept, *parts))
        keep = forest(a, b, w)
        return [a[keep], b[keep], w[keep]]
    step = max(1, min(1024, 8_000_000 // len(r)))
    for s in range(0, len(q), step):
        row, col, d = pivots.close_pairs(metric, q[s:s + step], r, np.full(len(q[s:s + step]), limit))
        row = row + s
        w = np.maximum(np.maximum(d, qc[row]), rc[col])
        good = (w <= limit) & (qid[row] < rid[col])
        a, b, w = of_q[row[good]], of_r[col[good]], w[good]
        for t, comp in cuts_:
            good = (w < t) | (comp[a] != comp[b])
            a, b, w = a[good], b[good], w[good]
        parts.append((a, b, w))
        held += len(a)
        if held > 1_000_000:
            kept, parts, held = merged(), [], 0
            at = np.unique(np.quantile(kept[2], (0.25, 0.5, 0.75, 0.9, 1.0)))
            cuts_ = [(t, _roots(len(names), kept[0][kept[2] <= t], kept[1][kept[2] <= t])) for t in at]
    a, b, w = merged()
    return names[a], names[b], w


def _tile_forest(metric: str, limit: float):
    """Copies of points (left) and a shelf (right): the forest of the mutual
    reachabilities up to ``limit``.  Points are (id, core, vec).  Every pair of
    points comes together in the shelves of both."""
    matrix = pivots._matrix

    def run(left, right):
        import pyarrow as pa
        out = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if left.num_rows and right.num_rows:
            q, r = (matrix(t.column(c)) for t, c in ((left, "q_vec"), (right, "vec")))
            qid, rid = np.asarray(left.column("q_id").combine_chunks()), np.asarray(right.column("ids").combine_chunks().flatten())
            qc, rc = np.asarray(left.column("core").combine_chunks()), np.asarray(right.column("core").combine_chunks())
            if q.shape[1] < BOXED:
                other = ~np.isin(qid, rid) & np.isfinite(q).all(1)
                fit = np.isfinite(r).all(1)
                out = near_forest(metric, limit, np.concatenate([rid[fit], qid[other]]), np.concatenate([rc[fit], qc[other]]),
                                  np.concatenate([r[fit], q[other]]), int(fit.sum()))
            else:
                out = wide_forest(metric, limit, qid, qc, q, rid, rc, r)
        return pa.table({"a": out[0], "b": out[1], "w": out[2]})
    return run


def _whole_forest(batches):
    import pyarrow as pa
    parts = [[np.asarray(b.column(c)) for c in ("a", "b", "w")] for b in batches if b.num_rows]
    if parts:
        a, b, w = (np.concatenate(x) for x in zip(*parts))
        keep = forest(a, b, w)
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)[keep]), pa.array(np.maximum(a, b)[keep]), pa.array(w[keep])],
                                         names=["a", "b", "w"])


def spanning_forest(edges: DataFrame, bound: int = BOUND) -> DataFrame:
    """(a, b, w), a < b, of a minimum spanning forest of ``edges`` (a, b, w)."""
    rest = cut_lineage(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "w")
                       .groupBy("a", "b").agg(F.min("w").alias("w"))
                       .withColumn("u", F.col("a")).withColumn("v", F.col("b")))  # the components of the ends
    done = []
    while rest.count() > bound:
        each = rest.select(F.col("u").alias("c"), F.struct("w", "a", "b").alias("e"))
        each = each.unionByName(rest.select(F.col("v").alias("c"), F.struct("w", "a", "b").alias("e")))
        best = each.groupBy("c").agg(F.min("e").alias("e")).select("e.*").distinct()
        chosen = cut_lineage(best.join(many(rest.select("a", "b", "u", "v")), ["a", "b"]))
        done.append(chosen.select("a", "b", "w"))
        both = chosen.select(F.col("u").alias("src"), F.col("v").alias("dst"))
        both = cut_lineage(both.unionByName(both.select(F.col("dst").alias("src"), F.col("src").alias("dst"))))
        comp = connected_components(both.select(F.col("src").alias("id")).distinct(), both)
        to = lambda c: comp.select(F.col("id").alias(c), F.col("label").alias(c + "2"))
        # every component has an edge, so every end has a new component
        rest = (rest.join(many(to("u")), "u").join(many(to("v")), "v").filter("u2 != v2")
                .groupBy(F.least("u2", "v2").alias("u"), F.greatest("u2", "v2").alias("v"))
                .agg(F.min(F.struct("w", "a", "b")).alias("e")).select("e.a", "e.b", "e.w", "u", "v"))
        rest = cut_lineage(rest)
    # the ends are now components: the kernel sees those, and hands on the edges
    last = rest.coalesce(1).select(F.col("u").alias("a"), F.col("v").alias("b"), "w").mapInArrow(_whole_forest, _EDGE)
    last = last.join(many(rest.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), F.col("a").alias("x"), F.col("b").alias("y"))),
                     (F.col("a") == F.col("u")) & (F.col("b") == F.col("v"))).select(F.col("x").alias("a"), F.col("y").alias("b"), "w")
    for part in done:
        last = last.unionByName(part)
    return cut_lineage(last)


def reachability(df: DataFrame, key: str, vec: str, min_samples: int, limit: float, metric: str = "euclidean",
                 bound: int = BOUND, shelf_rows: int | None = None, block_rows: int | None = None):
    """The tree up to ``limit``: (edges (a, b, w); points (id, node, core),
    node being the smallest id with that vector; near (id, nb, dist), the
    ``min_samples`` - 1 nearest other points of each)."""
    v = F.transform(V.as_double(vec), lambda x: x + F.lit(0.0))
    pts = cut_lineage(df.select(F.col(key).cast("long").alias("id"), v.alias("v"))
                      .filter(F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull()))
                      .withColumn("node", F.min("id").over(Window.partitionBy("v"))))
    others = min_samples - 1
    index = pivots.build(pts, "id", "v", metric, keep_ids=min_samples, shelf_rows=shelf_rows)
    near, points = df.sparkSession.createDataFrame([], "id long, nb long, dist double"), pts.withColumn("core", F.lit(0.0))
    if others:
        found = pivots.nearest(pts, index, others, "id", "v", exclude_self=True).filter("tested is null")
        rank = F.row_number().over(Window.partitionBy("q_id").orderBy("dist", "r_id"))
        near = cut_lineage(found.withColumn("_r", rank).filter(F.col("_r") <= others)
                           .select(F.col("q_id").alias("id"), F.col("r_id").alias("nb"), "dist"))
        core = near.groupBy("id").agg(F.max("dist").alias("core"), F.count(F.lit(1)).alias("n")).filter(F.col("n") == others)
        points = cut_lineage(pts.join(many(core.drop("n")), "id", "left"))
    edges = df.sparkSession.createDataFrame([], _EDGE)
    if index:
        # an entry of the index is a vector; its smallest id is the node
        nodes = points.filter((F.col("core") <= limit) & (F.col("id") == F.col("node")))
        cores = nodes.select(F.col("id").alias("_i"), "core")
        placed = index.placed.join(many(cores), F.element_at("ids", 1) == F.col("_i")).select(
            "shelf", F.slice("ids", 1, 1).alias("ids"), "vec", "core")
        q = pivots.routed(pivots._queries(nodes, "id", "v", limit), index, "all")
        q = q.join(many(cores), F.col("q_id") == F.col("_i")).select("shelf", "q_id", "q_vec", "core")
        dim = index.points.shape[1]
        # boxes want all copies of a shelf at once
        block_rows = block_rows or (pivots.TASK_VALUES // (8 * max(1, dim)) if dim < BOXED else None)
        edges = spanning_forest(pivots.met(cut_lineage(q), cut_lineage(placed), index.shelves, _tile_forest(index.metric, limit),
                                           _EDGE, block_rows, dim), bound)
    return edges, points.select("id", "node", "core"), near


def cuts(edges: DataFrame, points: DataFrame, near: DataFrame, eps_list: Sequence[float], bound: int = BOUND) -> DataFrame:
    """(e, eps, id, cluster) for every eps, from one ``reachability``: as
    ``dbscan.dbscan`` has them (clusters numbered by their smallest core
    point, border points in the smallest cluster they touch, noise -1)."""
    spark = edges.sparkSession
    eps = [float(x) for x in eps_list]
    sizes = F.array(*[F.lit(x) for x in eps])
    cores = points.filter(F.col("core") <= max(eps))
    nodes = cores.filter("id = node").select("id", "core")
    # equal vectors: a copy belongs where its node does
    if edges.count() + nodes.count() <= bound:
        ends = edges.unionByName(nodes.select(F.col("id").alias("a"), F.col("id").alias("b"), F.col("core").alias("w")))
        comp = ends.coalesce(1).mapInArrow(_cut_kernel(eps), "e int, id long, cluster long")
    else:
        # every eps starts from the clusters of the one before
        labels, before, parts = cut_lineage(nodes.select("id", "core", F.col("id").alias("label"))), -math.inf, []
        for x in sorted(set(eps)):
            band = edges.filter((F.col("w") > before) & (F.col("w") <= x))
            to = lambda c, k: labels.select(F.col("id").alias(c), F.col("label").alias(k))
            cut = band.join(many(to("a", "src")), "a").join(many(to("b", "dst")), "b").select("src", "dst")
            both = cut_lineage(cut.unionByName(cut.select(F.col("dst").alias("src"), F.col("src").alias("dst"))))
            if not both.isEmpty():
                joined = connected_components(both.select(F.col("src").alias("id")).distinct(), both)
                joined = joined.select(F.col("id").alias("label"), F.col("label").alias("_l"))
                labels = cut_lineage(labels.join(many(joined), "label", "left").select("id", "core", F.coalesce("_l", "label").alias("label")))
            before = x
            parts += [labels.filter(F.col("core") <= x).select(F.lit(e).alias("e"), "id", "label") for e, y in enumerate(eps) if y == x]
        comp = parts[0]
        for part in parts[1:]:
            comp = comp.unionByName(part)
        numbers = group_index(comp.select("e", "label").distinct(), ["e"], [F.col("label")], "cluster")
        comp = comp.join(many(numbers), ["e", "label"]).select("e", "id", "cluster")
    core_lab = cut_lineage(cores.join(many(comp.withColumnRenamed("id", "node")), "node").select("e", "id", "cluster"))
    every = points.select("id", "core", F.posexplode(sizes).alias("e", "eps"))
    loose = every.filter("core is null or core > eps")
    border = (loose.join(many(near), "id").filter("dist <= eps").select("e", "id", F.col("nb"))
              .join(many(core_lab.select("e", F.col("id").alias("nb"), "cluster")), ["e", "nb"])
              .groupBy("e", "id").agg(F.min("cluster").alias("cluster")))
    found = core_lab.unionByName(border)
    return (every.select("e", "eps", "id").join(many(found), ["e", "id"], "left")
            .select("e", "eps", "id", F.coalesce("cluster", F.lit(-1)).cast("long").alias("cluster")))


def _cut_kernel(eps: list[float]):
    """Edges, and nodes as (id, id, core distance) -> clusters for every eps."""
    def run(batches):
        import pyarrow as pa
        parts = [[np.asarray(b.column(c)) for c in ("a", "b", "w")] for b in batches if b.num_rows]
        if not parts:
            return
        a, b, w = (np.concatenate(x) for x in zip(*parts))
        names = np.unique(a[a == b])
        u, v = np.searchsorted(names, a), np.searchsorted(names, b)
        for e, x in enumerate(eps):
            cut = w <= x
            alive = np.unique(u[cut & (a == b)])
            root = _roots(len(names), u[cut], v[cut])[alive]
            _, number = np.unique(root, return_inverse=True)  # roots are smallest ids
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(alive), e, np.int32)), pa.array(names[alive]),
                                              pa.array(number.astype(np.int64))], names=["e", "id", "cluster"])
    return run


def dbscan_any(df: DataFrame, key: str, vec: str, eps_list: Sequence[float], min_samples: int = 4,
               metric: str = "euclidean") -> DataFrame:
    """ML-15 / ML-16 in any dimension and metric: DBSCAN labels for every eps
    in ``eps_list``, from one tree."""
    return cuts(*reachability(df, key, vec, min_samples, max(eps_list), metric), eps_list)
