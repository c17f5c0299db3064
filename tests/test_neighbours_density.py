"""Neighbours and radius joins through the pivot index, clusters from the
reachability tree, and the cluster scores that use them, against brute force."""

import os
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

from oracle_check import duck  # noqa: E402
from orrery.operators import cluster as CL  # noqa: E402
from orrery.operators import dbscan as DB  # noqa: E402
from orrery.operators import density as DN  # noqa: E402
from orrery.operators import neighbors as NB  # noqa: E402
from orrery.operators import pivots  # noqa: E402
from orrery.plans import registry  # noqa: E402

registry.load_all()
VEC = "id long, v array<double>"


def clustered(n, dims, groups, seed=0, spread=0.05):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(groups, dims))[rng.integers(groups, size=n)] * 3 + rng.normal(size=(n, dims)) * spread


def frame(spark, x, parts=4):
    return spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], VEC).repartition(parts)


def measured(x, y, metric):
    d = np.abs(x[:, None] - y[None])
    return np.sqrt((d * d).sum(2)) if metric == "euclidean" else d.sum(2) if metric == "manhattan" else d.max(2)


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "chebyshev"])
def test_neighbours_of_clustered_points(spark, metric):
    x = clustered(3000, 6, 25)
    x[100:140] = x[99]  # a pile of copies: ties go to the smaller ids
    df, k = frame(spark, x), 5
    index = pivots.build(df, "id", "v", metric, keep_ids=k + 1, shelf_rows=300)
    assert index.shelves > 5
    found = pivots.nearest(df, index, k, "id", "v", exclude_self=True, block_rows=200)
    got = [tuple(r) for r in NB.knn(df, df, k, q_id="id", r_id="id", q_vec="v", r_vec="v", metric=metric, exclude_self=True,
                                    block_rows=200, ref_block_rows=300).orderBy("q_id", "rank").select("q_id", "r_id").collect()]
    d = measured(x, x, metric)
    np.fill_diagonal(d, np.inf)
    want = [(i, int(j)) for i in range(len(x)) for j in np.lexsort((np.arange(len(x)), d[i]))[:k]]
    assert got == want
    # the triangle inequality rules most of the distances out
    assert found.agg(F.sum("tested")).first()[0] < len(x) ** 2 / 5


def test_neighbours_of_unlike_queries_nulls_and_few_rows(spark):
    ref = spark.createDataFrame([(1, [0.0, 0.0]), (2, [3.0, 4.0]), (3, [-0.0, 0.0]), (4, None), (5, [1.0, None]), (6, [0.0, 0.0])], VEC)
    query = spark.createDataFrame([(1, [0.0, 0.0]), (7, [3.0, 0.0]), (8, None)], VEC)
    out = NB.knn(query, ref, 3, q_id="id", r_id="id", q_vec="v", r_vec="v", exclude_self=True).orderBy("q_id", "rank").collect()
    assert [(r["q_id"], r["r_id"], r["dist"]) for r in out] == [(1, 3, 0.0), (1, 6, 0.0), (1, 2, 5.0), (7, 1, 3.0), (7, 3, 3.0), (7, 6, 3.0)]
    assert NB.knn(query, ref.limit(0), 3, q_id="id", r_id="id", q_vec="v", r_vec="v").count() == 0


def test_neighbours_of_data_without_structure(spark):
    """Nothing can be ruled out: still right, over several shelves."""
    x = np.random.default_rng(1).normal(size=(600, 40))
    got = NB.knn(frame(spark, x[:50]), frame(spark, x), 3, q_id="id", r_id="id", q_vec="v", r_vec="v", ref_block_rows=100)
    d = measured(x[:50], x, "euclidean")
    assert sorted((r["q_id"], r["rank"], r["r_id"]) for r in got.collect()) == [
        (i, n + 1, int(j)) for i in range(50) for n, j in enumerate(np.argsort(d[i], kind="stable")[:3])]


@pytest.mark.parametrize("metric,eps", [("euclidean", 0.9), ("manhattan", 5.5)])
def test_radius_join_in_64_dimensions(spark, metric, eps):
    x = clustered(900, 64, 60, seed=2, spread=0.08)
    x[:5] = x[5]
    got = DB.ball_pairs(frame(spark, x), "id", "v", eps, metric, shelf_rows=128, block_rows=64).collect()
    d = measured(x, x, metric)
    want = {(int(a), int(b)) for a, b in zip(*np.nonzero(d <= eps))}
    assert len(got) == len(want) and {(r["id_a"], r["id_b"]) for r in got} == want and len(want) > 2000
    assert max(abs(d[r["id_a"], r["id_b"]] - r["dist"]) for r in got) < 1e-12
    assert DB.ball_pairs(frame(spark, x[:3]), "id", "v", eps, include_self=False).count() == 6


# ---- reachability tree --------------------------------------------------------

def brute_forest_weight(a, b, w):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    total, kept = 0.0, 0
    for d, x, y in sorted(zip(w, a, b)):
        if find(x) != find(y):
            root[find(x)] = find(y)
            total, kept = total + d, kept + 1
    return total, kept


@pytest.mark.parametrize("bound", [10**6, 40])
def test_spanning_forest(spark, bound):
    """In one task, or by rounds of the cheapest edge of every component."""
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 300, 1500), rng.integers(0, 300, 1500)
    keep = a != b
    a, b, w = a[keep], b[keep], rng.integers(1, 40, keep.sum()).astype(float)  # many ties
    edges = spark.createDataFrame(list(zip(a.tolist(), b.tolist(), w.tolist())), "a long, b long, w double")
    got = DN.spanning_forest(edges, bound).collect()
    assert (sum(r["w"] for r in got), len(got)) == brute_forest_weight(a, b, w)
    assert brute_forest_weight(*zip(*[(r["a"], r["b"], r["w"]) for r in got]))[1] == len(got)  # no cycle
    assert {(min(x, y), max(x, y), z) for x, y, z in zip(a, b, w)} >= {(r["a"], r["b"], r["w"]) for r in got}


@pytest.mark.parametrize("bound", [DN.BOUND, 20])
def test_clusters_of_every_eps_are_those_of_dbscan(spark, bound):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(150, 2)), rng.normal(size=(100, 2)) * 0.2 + 3, np.repeat([[9.0, 9.0]], 40, 0), rng.uniform(-4, 12, (60, 2))])
    df, eps = frame(spark, x), [0.1, 0.2, 0.4, 0.9, 3.0]
    tree = DN.reachability(df, "id", "v", 4, max(eps), bound=bound, shelf_rows=64, block_rows=32)
    assert tree[0].count() < len(x)
    got = {(r["e"], r["id"]): r["cluster"] for r in DN.cuts(*tree, eps, bound=bound).collect()}
    grid = DB.dbscan(df.select("id", F.col("v")[0].alias("x"), F.col("v")[1].alias("y")), "id", ["x", "y"], eps, 4)
    assert got == {(r["e"], r["id"]): r["cluster"] for r in grid.collect()}


def test_clusters_in_many_dimensions_and_of_few_points(spark):
    x = clustered(400, 20, 9, seed=5, spread=0.1)
    out = DN.dbscan_any(frame(spark, x), "id", "v", [1.0], 3, "manhattan").collect()
    d = measured(x, x, "manhattan") <= 1.0
    core = d.sum(1) >= 3
    lab = {r["id"]: r["cluster"] for r in out}
    for i in range(len(x)):
        near = [j for j in np.flatnonzero(d[i] & core)]
        assert (lab[i] == -1) == (not near)
        if core[i]:
            assert all(lab[j] == lab[i] for j in near)
        elif near:
            assert lab[i] == min(lab[j] for j in near)
    few = DN.dbscan_any(frame(spark, x[:2]), "id", "v", [100.0], 1).collect()
    assert sorted((r["id"], r["cluster"]) for r in few) == [(0, 0), (1, 0)]
    alone = DN.dbscan_any(frame(spark, x[:2]), "id", "v", [100.0], 3).collect()
    assert [r["cluster"] for r in alone] == [-1, -1]
    assert DN.dbscan_any(frame(spark, x[:1]).limit(0), "id", "v", [1.0], 3).count() == 0


# ---- scores -------------------------------------------------------------------

def labelled(spark):
    rng, rows = np.random.default_rng(0), []
    for e, k in enumerate((1, 5, 40)):
        for i in range(300):
            c = int(rng.integers(k))
            rows.append((e * 1000 + i, e, c, (rng.normal(size=3) * [.1, 1, .3][c % 3] + c % 7 * np.array([1, 2, 3.])).tolist()))
    rows.append((5000, 2, 99, [0.0, 0.0, 0.0]))
    return rows, spark.createDataFrame(rows, "id long, e int, c int, v array<double>")


@pytest.mark.parametrize("inline", [pivots.MAX_VALUES, 0])
def test_squared_silhouette(spark, inline):
    rows, df = labelled(spark)
    got = {r["e"]: r["silhouette"] for r in CL.silhouette_squared(df, "v", "c", "e", inline).collect()}
    for e in range(3):
        x, lab = (np.array([r[i] for r in rows if r[1] == e]) for i in (3, 2))
        d, s = ((x[:, None] - x[None]) ** 2).sum(2), []
        for i in range(len(x)):
            n, b = (lab == lab[i]).sum(), [d[i][lab == c].mean() for c in set(lab) - {lab[i]}]
            a = d[i][lab == lab[i]].sum() / max(1, n - 1)
            s.append((min(b) - a) / max(a, min(b)) if n > 1 and b else 0)
        assert got[e] == pytest.approx(np.mean(s))


@pytest.mark.parametrize("paired", [CL.PAIRED, 0])
def test_davies_bouldin_with_and_without_all_pairs(spark, monkeypatch, paired):
    monkeypatch.setattr(CL, "PAIRED", paired)
    rows, df = labelled(spark)
    got = {r["e"]: r["davies_bouldin"] for r in CL.davies_bouldin(df, "v", "c", ["e"]).collect()}
    assert set(got) == {1, 2}  # one cluster has no score
    for e in got:
        x, lab = (np.array([r[i] for r in rows if r[1] == e]) for i in (3, 2))
        cen = {c: x[lab == c].mean(0) for c in set(lab)}
        s = {c: np.linalg.norm(x[lab == c] - cen[c], axis=1).mean() for c in cen}
        assert got[e] == pytest.approx(np.mean([max((s[a] + s[b]) / np.linalg.norm(cen[a] - cen[b]) for b in cen if b != a) for a in cen]))


def test_eps_sweep_scores(spark):
    """Cluster and noise counts and scores of every eps, by brute force over
    the points (the silhouette on squared distances)."""
    pdf, con = registry.QUERIES["ml16_eps_sweep"](spark, SF_SMALL).toPandas(), duck(SF_SMALL)
    assert len(pdf)
    rows = con.execute("SELECT c_custkey, c_acctbal / 1000, c_nationkey / 3.0 FROM customer ORDER BY 1").fetchall()
    x = np.array([r[1:] for r in rows], float)
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    for r in pdf.itertuples():
        near = dist <= r.eps
        core = near.sum(1) >= 4
        lab, n = np.full(len(x), -1), 0
        for i in np.flatnonzero(core):
            if lab[i] < 0:
                todo, n = [i], n + 1
                while todo:
                    j = todo.pop()
                    if lab[j] < 0:
                        lab[j] = n - 1
                        todo += list(np.flatnonzero(near[j] & core & (lab < 0)))
        for i in np.flatnonzero(~core):
            own = lab[near[i] & core]
            lab[i] = own.min() if len(own) else -1
        assert (r.n_clusters, r.n_noise) == (n, (lab < 0).sum())
        ids = sorted(set(lab))
        means = {c: (dist[:, lab == c] ** 2).sum(1) for c in ids}
        s = []
        for i in range(len(x)):
            size = (lab == lab[i]).sum()
            a, b = means[lab[i]][i] / max(1, size - 1), min(means[c][i] / (lab == c).sum() for c in ids if c != lab[i])
            s.append(0 if size == 1 or max(a, b) == 0 else (b - a) / max(a, b))
        assert abs(np.mean(s) - r.silhouette_squared) < 1e-5
        cen = np.array([x[lab == c].mean(0) for c in ids])
        w = sum(((x[lab == c] - m) ** 2).sum() for c, m in zip(ids, cen))
        between = sum((lab == c).sum() * ((m - x.mean(0)) ** 2).sum() for c, m in zip(ids, cen))
        assert abs(between * (len(x) - len(ids)) / (w * (len(ids) - 1)) - r.calinski_harabasz) < 1e-3
