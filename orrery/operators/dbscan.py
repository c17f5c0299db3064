"""Radius join and density clustering (JN-3, ML-15, ML-16, WIN-2).

Radius join: points are hashed to grid cells of side eps; one side is
expanded to its 3^d neighbour cells (half of them where a pair is wanted
once), the sides are equi-joined on the cell and the exact distance is
filtered.  Suited to low dimension (d <= 3);
``ball_pairs`` is the join for any other.

DBSCAN runs for a whole list of eps values at once: every step is keyed
by (eps index, ...), so one set of jobs serves the full sweep.  Dense grid
cells need no pairs (see ``dbscan``).  Connected components hook roots and
jump pointers; every intermediate table is written to the session's
checkpoint folder, so lineage stays short and lost executors only cost the
current step.
"""

from __future__ import annotations

import itertools
import math
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.session import Rounds, cut_lineage, many, small_side


def _dist(a_cols, b_cols):
    s = None
    for a, b in zip(a_cols, b_cols):
        t = (F.col(a) - F.col(b)) * (F.col(a) - F.col(b))
        s = t if s is None else s + t
    return F.sqrt(s)


def _spread(df: DataFrame, *keys: str, rows: int = 50_000) -> DataFrame:
    """``df`` dealt into tasks of about ``rows`` rows, before each row becomes
    several: a task that reads a whole file would hold all of those."""
    return df.repartition(max(1, math.ceil(df.count() / rows)), *keys)


def radius_pairs(df: DataFrame, key: str, xcols: Sequence[str], eps: float,
                 include_self: bool = True, once: bool = False, block_rows: int = 5_000) -> DataFrame:
    """All ordered pairs (id_a, id_b, dist) with dist <= eps (both
    directions; self pairs at distance 0 when ``include_self``).  ``once``:
    every pair once, id_a < id_b, from half the neighbour cells.

    The rows of a cell are one task's only up to ``block_rows`` of them; the
    blocks of a larger cell meet their neighbourhood apart from each other.
    Tasks follow the number of pairs to measure, and neither side is
    broadcast, whatever size its files suggest."""
    d = len(xcols)
    K = [f"k{i}" for i in range(d)]
    side = F.lit(float(eps) * (1 + 1e-9))  # rounding never puts two points within eps two cells apart
    cells = [F.floor(F.col(x) / side).cast("long") for x in xcols]
    a = df.select(F.col(key).alias("id_a"), *[F.col(x).alias(f"a{i}") for i, x in enumerate(xcols)],
                  *[c.alias(K[i]) for i, c in enumerate(cells)])
    per = a.na.drop(subset=K).groupBy(*K).agg(F.count(F.lit(1)).alias("n"))
    size = per.agg(F.sum("n").alias("n"), F.sum(F.col("n").cast("double") * F.col("n")).alias("n2"), F.max("n").alias("most")).first()
    parts = max(1, min(20_000, math.ceil(max((size["n"] or 0) / 50_000, (size["n2"] or 0) / 1e7))))
    none = (0,) * d
    offsets = [t for t in itertools.product((-1, 0, 1), repeat=d) if not once or t >= none]
    off = F.explode(F.array(*[F.array(*[F.lit(o) for o in t]) for t in offsets])).alias("_o")
    b = _spread(df, key).select(F.col(key).alias("id_b"), *[F.col(x).alias(f"b{i}") for i, x in enumerate(xcols)],
                  *[c.alias(f"c{i}") for i, c in enumerate(cells)], off)
    b = b.select("id_b", *[f"b{i}" for i in range(d)], (F.col("_o") == F.array(*[F.lit(0)] * d)).alias("_own"),
                 *[(F.col(f"c{i}") + F.col("_o")[i]).alias(K[i]) for i in range(d)])
    on = K
    if (size["most"] or 0) > block_rows:
        hot = small_side(per.filter(F.col("n") > block_rows).select(*K, F.ceil(F.col("n") / block_rows).alias("_n")))
        blocks = F.coalesce("_n", F.lit(1)).cast("long")
        a = a.join(hot, K, "left").withColumn("_s", F.pmod(F.xxhash64("id_a", *[f"a{i}" for i in range(d)]), blocks)).drop("_n")
        b = b.join(hot, K, "left").withColumn("_s", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))).drop("_n")
        on = [*K, "_s"]
    j = a.repartition(parts, *on).join(b.repartition(parts, *on).transform(many), on)
    j = j.withColumn("dist", _dist([f"a{i}" for i in range(d)], [f"b{i}" for i in range(d)]))
    j = j.filter(F.col("dist") <= F.lit(eps))
    if once:
        j = j.filter((F.col("id_a") < F.col("id_b")) | ((F.col("id_a") > F.col("id_b")) & ~F.col("_own")))
        return j.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"), "dist")
    if not include_self:
        j = j.filter(F.col("id_a") != F.col("id_b"))
    return j.select("id_a", "id_b", "dist")


def ball_pairs(df: DataFrame, key: str, vec: str, eps: float, metric: str = "euclidean", include_self: bool = True,
               shelf_rows: int | None = None, block_rows: int | None = None, once: bool = False) -> DataFrame:
    """JN-3 in any number of dimensions: all ordered pairs (id_a, id_b, dist)
    within ``eps``.  Rows live in the cells of a pivot index and are copied to
    every shelf of it that their ball reaches, in place of 3^d grid cells.
    ``once``: every pair once, id_a < id_b, for half the distances."""
    from orrery.operators import pivots
    if once:
        df = df.filter(F.col(key).isNotNull())
    index = pivots.build(df, key, vec, metric, shelf_rows=shelf_rows, share=8)
    if once:
        found = pivots.pairs_once(index, df.sparkSession, eps).filter("tested is null")
        return found.select(F.col("q_id").alias("id_a"), F.col("r_id").alias("id_b"), "dist")
    found = pivots.within(df, index, eps, key, vec, block_rows).filter("tested is null")
    if not include_self:
        found = found.filter("q_id != r_id")
    return found.select(F.col("q_id").alias("id_a"), F.col("r_id").alias("id_b"), "dist")


def _shortcut(par: DataFrame, k: list, rounds: Rounds) -> DataFrame:
    """Pointer jumping until every node points at a root (each pass halves
    the tree depth)."""
    while True:
        up = par.select(*k, F.col("id").alias("p"), F.col("p").alias("pp"))
        nxt = (par.join(many(up), [*k, "p"], "left")
                  .select(*k, "id", F.coalesce("pp", "p").alias("p"),
                          (F.coalesce("pp", "p") != F.col("p")).alias("_moved")))
        nxt = rounds.keep(nxt)
        rounds.drop_old(1)
        if nxt.filter("_moved").limit(1).count() == 0:
            return nxt.drop("_moved")
        par = nxt.drop("_moved")


def connected_components(nodes: DataFrame, edges: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Smallest node id of each node's component.

    ``nodes``: (keys..., id); ``edges``: (keys..., src, dst), both
    directions.  Parent pointers only ever point at smaller ids.  Each round
    flattens every tree by pointer jumping, then hooks every root onto the
    smallest root adjacent to its tree; a root that is not a local minimum
    always hooks, so the number of trees per component at least halves and
    the rounds grow with log(n), not with the graph's diameter; the loop ends
    when nothing hooks.  Every intermediate table is written to the shared
    checkpoint folder and deleted once the next one is there."""
    k = list(keys)
    rounds = Rounds(nodes.sparkSession)
    first = edges.groupBy(*k, "src").agg(F.min("dst").alias("_m"))
    par = (nodes.select(*k, "id").join(many(first.withColumnRenamed("src", "id")), [*k, "id"], "left")
                .select(*k, "id", F.least("id", F.coalesce("_m", "id")).alias("p")))
    par = rounds.keep(par)
    while True:
        par = _shortcut(par, k, rounds)
        ru = par.select(*k, F.col("id").alias("src"), F.col("p").alias("ru"))
        rv = par.select(*k, F.col("id").alias("dst"), F.col("p").alias("rv"))
        hooks = (edges.join(many(ru), [*k, "src"]).join(many(rv), [*k, "dst"])
                      .filter(F.col("rv") < F.col("ru"))
                      .groupBy(*k, "ru").agg(F.min("rv").alias("_h")))
        hooks = rounds.keep(hooks)
        if hooks.limit(1).count() == 0:
            return par.select(*k, "id", F.col("p").alias("label"))
        par = (par.join(many(hooks.withColumnRenamed("ru", "id")), [*k, "id"], "left")
                  .select(*k, "id", F.least("p", F.coalesce("_h", "p")).alias("p")))
        par = rounds.keep(par)
        rounds.drop_old(1)


def _any_within(eps: float):
    """Tile kernel: does any pair (left row, right row) lie within eps?
    Emits the pair id once when it does (bounded tile, no pair rows)."""
    import numpy as np
    import pandas as pd

    def fn(lpdf: pd.DataFrame, rpdf: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"pair": pd.Series([], dtype="int64")})
        if len(lpdf) == 0 or len(rpdf) == 0:
            return empty
        e2 = float(lpdf["eps"].iloc[0]) ** 2
        lm = np.vstack(lpdf["v"].to_numpy()).astype(np.float64)
        rm = np.vstack(rpdf["v"].to_numpy()).astype(np.float64)
        step = max(1, 2_000_000 // max(1, len(rm) * rm.shape[1]))
        for s0 in range(0, len(lm), step):
            d2 = ((lm[s0:s0 + step, None, :] - rm[None, :, :]) ** 2).sum(2)
            if (d2 <= e2).any():
                return pd.DataFrame({"pair": pd.Series([int(lpdf["pair"].iloc[0])], dtype="int64")})
        return empty
    return fn


def dbscan(df: DataFrame, key: str, xcols: Sequence[str], eps_list: Sequence[float],
           min_samples: int = 4, block_rows: int = 2048) -> DataFrame:
    """ML-15 / ML-16: DBSCAN labels for every eps in ``eps_list``.

    A point is core with at least ``min_samples`` points (itself included)
    within eps; clusters are connected core points, numbered 0, 1, ... in
    order of their smallest point id; a non-core point within eps of a core
    point joins the smallest such cluster; the rest is noise (-1).
    Returns (e, eps, id, cluster).

    Hot spots never turn quadratic in rows: on a grid of side eps / sqrt(d)
    any two points of one cell are within eps, so a cell holding at least
    ``min_samples`` points (dense) makes all its points core and one graph
    node without any pair.  Only points of sparse cells (fewer than
    ``min_samples`` each) are joined with their neighbourhood, which bounds
    that join by (min_samples - 1) x cells x neighbour sizes.  Two
    neighbouring dense cells are linked when their bounding boxes are
    within eps everywhere, kept apart when the boxes are farther than eps,
    and otherwise decided by salted tiles of at most ``block_rows`` points
    per side that only report whether some pair is within eps."""
    from orrery.operators.splits import group_index
    d = len(xcols)
    m = int(min_samples)
    eps_arr = F.array(*[F.lit(float(e)) for e in eps_list])
    shrink = (1 - 1e-12) / math.sqrt(d)   # rounding never stretches a cell past eps
    reach = int(math.floor(math.sqrt(d) / (1 - 1e-12))) + 1
    X = [f"x{i}" for i in range(d)]
    S = [f"s{i}" for i in range(d)]
    G = [f"g{i}" for i in range(d)]
    base = df.select(F.col(key).cast("long").alias("id"),
                     *[F.col(x).cast("double").alias(X[i]) for i, x in enumerate(xcols)])
    pts = base.select("*", F.posexplode(eps_arr).alias("e", "eps"))
    pts = pts.select("e", "eps", "id", *X,
                     *[F.floor(F.col(X[i]) / (F.col("eps") * F.lit(shrink))).alias(S[i]) for i in range(d)],
                     *[F.floor(F.col(X[i]) / F.col("eps")).alias(G[i]) for i in range(d)])
    cells = pts.groupBy("e", *S).agg(
        F.count(F.lit(1)).alias("n_c"), F.min("id").alias("cid"),
        *[F.min(X[i]).alias(f"lo{i}") for i in range(d)], *[F.max(X[i]).alias(f"hi{i}") for i in range(d)])
    cells = cut_lineage(cells)
    pts = cut_lineage(pts.join(cells.select("e", *S, "n_c", "cid"), ["e", *S]))

    # sparse points against their neighbourhood (cells of side eps, 3^d); only
    # they are copied to its cells
    offsets = list(itertools.product((-1, 0, 1), repeat=d))
    off = F.explode(F.array(*[F.array(*[F.lit(o) for o in t]) for t in offsets])).alias("_o")
    q = _spread(pts.filter(F.col("n_c") < m), "e", "id").select(
        "e", "eps", F.col("id").alias("id_a"), *[F.col(X[i]).alias(f"a{i}") for i in range(d)], *G, off)
    q = q.select("e", "eps", "id_a", *[f"a{i}" for i in range(d)],
                 *[(F.col(G[i]) + F.col("_o")[i]).alias(G[i]) for i in range(d)])
    r = pts.select("e", F.col("id").alias("id_b"), *[F.col(X[i]).alias(f"b{i}") for i in range(d)], *G)
    pairs = (q.join(r, ["e", *G])
              .filter(_dist([f"a{i}" for i in range(d)], [f"b{i}" for i in range(d)]) <= F.col("eps"))
              .select("e", "id_a", "id_b"))
    pairs = cut_lineage(pairs)
    sparse_core = (pairs.groupBy("e", "id_a").agg(F.count(F.lit(1)).alias("n"))
                        .filter(F.col("n") >= m).select("e", F.col("id_a").alias("id")))
    core = (pts.filter(F.col("n_c") >= m).select("e", "id")
               .unionByName(sparse_core))
    core = cut_lineage(core)

    # graph nodes: each cell's core points, named by the smallest core id
    core_pts = pts.join(core, ["e", "id"], "left_semi").select("e", "id", *S)
    node_of = (core_pts.groupBy("e", *S).agg(F.min("id").alias("node"))
                       .join(core_pts, ["e", *S]).select("e", "id", "node"))
    node_of = cut_lineage(node_of)
    na = node_of.select("e", F.col("id").alias("id_a"), F.col("node").alias("src"))
    nb = node_of.select("e", F.col("id").alias("id_b"), F.col("node").alias("dst"))
    e_pairs = (pairs.join(na, ["e", "id_a"]).join(nb, ["e", "id_b"])
                    .filter(F.col("src") != F.col("dst")).select("e", "src", "dst"))

    # neighbouring dense cells
    dense = cells.filter(F.col("n_c") >= m).select(
        "e", *S, "cid", "n_c", *[f"lo{i}" for i in range(d)], *[f"hi{i}" for i in range(d)])
    near = [t for t in itertools.product(range(-reach, reach + 1), repeat=d)
            if any(t) and sum(max(abs(o) - 1, 0) ** 2 for o in t) <= d]
    noff = F.explode(F.array(*[F.array(*[F.lit(o) for o in t]) for t in near])).alias("_o")
    A = dense.select(*[F.col(c).alias(f"A_{c}") for c in dense.columns], noff)
    A = A.select("*", *[(F.col(f"A_{S[i]}") + F.col("_o")[i]).alias(S[i]) for i in range(d)],
                 F.col("A_e").alias("e"))
    B = dense.select("e", *S, *[F.col(c).alias(f"B_{c}") for c in dense.columns if c not in ("e", *S)])
    cand = A.join(B, ["e", *S]).filter(F.col("A_cid") < F.col("B_cid"))
    eps_e = F.element_at(eps_arr, F.col("e") + 1)
    gap = [F.greatest(F.lit(0.0), F.col(f"B_lo{i}") - F.col(f"A_hi{i}"), F.col(f"A_lo{i}") - F.col(f"B_hi{i}"))
           for i in range(d)]
    span = [F.greatest(F.col(f"A_hi{i}") - F.col(f"B_lo{i}"), F.col(f"B_hi{i}") - F.col(f"A_lo{i}"))
            for i in range(d)]
    cand = cand.select("e", F.col("A_cid").alias("ca"), F.col("B_cid").alias("cb"),
                       F.col("A_n_c").alias("na"), F.col("B_n_c").alias("nb"),
                       *[F.col(f"A_{S[i]}").alias(f"as{i}") for i in range(d)],
                       *[F.col(S[i]).alias(f"bs{i}") for i in range(d)],
                       F.sqrt(sum(g * g for g in gap)).alias("dmin"),
                       F.sqrt(sum(t * t for t in span)).alias("dmax"), eps_e.alias("eps"))
    cand = cut_lineage(cand.filter(F.col("dmin") <= F.col("eps")))
    sure = cand.filter(F.col("dmax") <= F.col("eps")).select("e", F.col("ca").alias("src"), F.col("cb").alias("dst"))
    unsure = cand.filter(F.col("dmax") > F.col("eps")).withColumn("pair", F.monotonically_increasing_id())
    unsure = cut_lineage(unsure)
    found = _tile_links(pts, unsure, d, block_rows, eps_list)
    dd = sure.unionByName(found)
    one_way = e_pairs.unionByName(dd)   # sparse-side pairs are found from one side only
    edges = one_way.unionByName(one_way.select("e", F.col("dst").alias("src"), F.col("src").alias("dst")))
    edges = cut_lineage(edges.distinct())
    nodes = node_of.select("e", F.col("node").alias("id")).distinct()
    lab = connected_components(nodes, edges, ["e"])
    comp = node_of.join(lab.withColumnRenamed("id", "node"), ["e", "node"]).select("e", "id", "label")
    roots = comp.select("e", "label").distinct()
    numbered = group_index(roots, ["e"], [F.col("label")], "cluster")
    core_lab = cut_lineage(comp.join(numbered, ["e", "label"]).select("e", "id", "cluster"))
    border = (pairs.join(core, [pairs.e == core.e, pairs.id_a == core.id], "left_anti")
                   .join(core_lab.select("e", F.col("id").alias("id_b"), "cluster"), ["e", "id_b"])
                   .groupBy("e", F.col("id_a").alias("id")).agg(F.min("cluster").alias("cluster")))
    labelled = core_lab.unionByName(border)
    out = pts.select("e", "id").join(labelled, ["e", "id"], "left").withColumn(
        "cluster", F.coalesce(F.col("cluster"), F.lit(-1)).cast("long"))
    return out.withColumn("eps", F.element_at(eps_arr, F.col("e") + 1)).select("e", "eps", "id", "cluster")


def _tile_links(pts: DataFrame, unsure: DataFrame, d: int, block_rows: int,
                eps_list: Sequence[float]) -> DataFrame:
    """Dense cell pairs whose bounding boxes straddle eps.  Pairs with at
    most ``8 * block_rows`` point combinations (the usual case) are checked
    by a plain equi-join on the pair; larger ones meet in salted tiles of at
    most ``block_rows`` points per side that only report whether some
    distance is within eps.  Returns (e, src, dst)."""
    S = [f"s{i}" for i in range(d)]
    X = [f"x{i}" for i in range(d)]
    small_max = 8 * block_rows
    small = unsure.filter(F.col("na") * F.col("nb") <= small_max)
    big = unsure.filter(F.col("na") * F.col("nb") > small_max)

    la = pts.join(small.select("e", "pair", *[F.col(f"as{i}").alias(S[i]) for i in range(d)]), ["e", *S]) \
        .select("pair", "eps", *[F.col(X[i]).alias(f"a{i}") for i in range(d)])
    lb = pts.join(small.select("e", "pair", *[F.col(f"bs{i}").alias(S[i]) for i in range(d)]), ["e", *S]) \
        .select("pair", *[F.col(X[i]).alias(f"b{i}") for i in range(d)])
    la, lb = cut_lineage(la), cut_lineage(lb)
    near = (la.join(lb, "pair")
              .filter(_dist([f"a{i}" for i in range(d)], [f"b{i}" for i in range(d)]) <= F.col("eps"))
              .select("pair").distinct())

    if big.limit(1).count() == 0:   # no large cell pair: skip the tile stage
        return unsure.join(near, "pair").select("e", F.col("ca").alias("src"), F.col("cb").alias("dst"))
    v = F.array(*[F.col(X[i]) for i in range(d)])
    side_a = big.select("e", "pair", "nb", *[F.col(f"as{i}").alias(S[i]) for i in range(d)],
                        F.col("na").alias("n_own"))
    side_b = big.select("e", "pair", "na", *[F.col(f"bs{i}").alias(S[i]) for i in range(d)],
                        F.col("nb").alias("n_own"))
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(n / F.lit(block_rows)).cast("int"))
    left = (pts.join(side_a, ["e", *S])
               .select("pair", "eps", v.alias("v"),
                       F.pmod(F.xxhash64("id"), blocks(F.col("n_own"))).cast("int").alias("ia"),
                       F.explode(F.sequence(F.lit(0), blocks(F.col("nb")) - 1)).alias("ib")))
    right = (pts.join(side_b, ["e", *S])
                .select("pair", "eps", v.alias("v"),
                        F.pmod(F.xxhash64("id"), blocks(F.col("n_own"))).cast("int").alias("ib"),
                        F.explode(F.sequence(F.lit(0), blocks(F.col("na")) - 1)).alias("ia")))
    # written out: both sides share lineage, which a cogroup cannot resolve
    left, right = cut_lineage(left), cut_lineage(right)
    hit = (left.groupBy("pair", "ia", "ib").cogroup(right.groupBy("pair", "ia", "ib"))
               .applyInPandas(_any_within(max(eps_list)), "pair long").distinct())
    linked = near.unionByName(hit)
    return unsure.join(linked, "pair").select("e", F.col("ca").alias("src"), F.col("cb").alias("dst"))
