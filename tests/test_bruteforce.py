"""Operators without an SQL oracle, checked against brute force on small
inputs (NumPy over collected fixtures; the operators themselves run on
Spark)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from orrery.operators import cluster as CL
from orrery.operators import dbscan as DB
from orrery.operators import neighbors as NB
from orrery.sources.tables import table


def _points(spark):
    c = table(spark, SF_MID, "customer")
    return c.select("c_custkey", (F.col("c_acctbal") / 1000).alias("x"), (F.col("c_nationkey") / 3.0).alias("y"))


def _np_points(df):
    rows = sorted(df.collect(), key=lambda r: r[0])
    return np.array([r[0] for r in rows]), np.array([[r[1], r[2]] for r in rows])


def _brute_dbscan(ids, X, eps, min_samples):
    d = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(2))
    nb = d <= eps
    core = nb.sum(1) >= min_samples
    n = len(ids)
    comp = -np.ones(n, dtype=int)
    for i in range(n):
        if not core[i] or comp[i] >= 0:
            continue
        stack, comp[i] = [i], i
        while stack:
            j = stack.pop()
            for t in np.nonzero(nb[j] & core)[0]:
                if comp[t] < 0:
                    comp[t] = i
                    stack.append(t)
    roots = sorted({ids[c] for c in comp[core]})
    number = {r: k for k, r in enumerate(roots)}
    # component label -> smallest id in it
    smallest = {}
    for i in np.nonzero(core)[0]:
        smallest[comp[i]] = min(smallest.get(comp[i], ids[i]), ids[i])
    lab = {}
    for i in range(n):
        if core[i]:
            lab[ids[i]] = number[smallest[comp[i]]]
        else:
            cs = [number[smallest[comp[t]]] for t in np.nonzero(nb[i] & core)[0]]
            lab[ids[i]] = min(cs) if cs else -1
    return lab


@pytest.mark.parametrize("eps,min_samples", [(0.3, 4), (0.2, 3)])
def test_dbscan_matches_brute_force(spark, eps, min_samples):
    pts = _points(spark)
    ids, X = _np_points(pts)
    want = _brute_dbscan(ids, X, eps, min_samples)
    got = {r["id"]: r["cluster"] for r in DB.dbscan(pts, "c_custkey", ["x", "y"], [eps], min_samples).collect()}
    assert got == want
    assert len(set(want.values())) >= 2  # not all noise, not one label


def test_dbscan_sweep_equals_single_runs(spark):
    pts = _points(spark)
    ids, X = _np_points(pts)
    out = DB.dbscan(pts, "c_custkey", ["x", "y"], [0.2, 0.4], 4).collect()
    for e, eps in enumerate([0.2, 0.4]):
        got = {r["id"]: r["cluster"] for r in out if r["e"] == e}
        assert got == _brute_dbscan(ids, X, eps, 4)


def test_radius_pairs(spark):
    pts = _points(spark)
    ids, X = _np_points(pts)
    d = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(2))
    want = {(ids[i], ids[j]) for i, j in zip(*np.nonzero(d <= 0.3)) if ids[i] != ids[j]}
    got = {(r["id_a"], r["id_b"]) for r in
           DB.radius_pairs(pts, "c_custkey", ["x", "y"], 0.3, include_self=False).collect()}
    assert got == want


def test_connected_components_chain(spark):
    nodes = spark.createDataFrame([(i,) for i in range(10)], "id long")
    e = [(i, i + 1) for i in range(0, 4)] + [(7, 8)]
    edges = spark.createDataFrame(e + [(b, a) for a, b in e], "src long, dst long")
    got = {r["id"]: r["label"] for r in DB.connected_components(nodes, edges).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: 5, 6: 6, 7: 7, 8: 7, 9: 9}


def _emb(spark):
    e = table(spark, SF_SMALL, "embeddings")
    return e.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "cosine"])
def test_knn_exact(spark, metric):
    e = _emb(spark)
    rows = sorted(e.collect(), key=lambda r: r["vec_id"])
    ids = np.array([r["vec_id"] for r in rows])
    M = np.array([r["v"] for r in rows])
    if metric == "euclidean":
        D = np.sqrt(((M[:, None] - M[None]) ** 2).sum(2))
    elif metric == "manhattan":
        D = np.abs(M[:, None] - M[None]).sum(2)
    else:
        nm = np.linalg.norm(M, axis=1)
        D = 1 - (M @ M.T) / np.outer(nm, nm)
    k = 4
    got = NB.knn(e, e, k, q_id="vec_id", r_id="vec_id", q_vec="v", r_vec="v", metric=metric,
                 exclude_self=True, block_rows=16, ref_block_rows=40).collect()
    by_q = {}
    for r in got:
        by_q.setdefault(r["q_id"], []).append((r["rank"], r["r_id"], r["dist"]))
    for qi, q in enumerate(ids):
        order = sorted((D[qi, j], ids[j]) for j in range(len(ids)) if j != qi)[:k]
        mine = sorted(by_q[q])
        assert [m[1] for m in mine] == [o[1] for o in order]
        assert [m[2] for m in mine] == pytest.approx([o[0] for o in order], abs=1e-9)


def test_silhouette_exact(spark):
    e = _emb(spark)
    rows = sorted(e.collect(), key=lambda r: r["vec_id"])
    M = np.array([r["v"] for r in rows])
    lab = np.array([r["label"] for r in rows])
    D = np.sqrt(((M[:, None] - M[None]) ** 2).sum(2))
    s = []
    for i in range(len(M)):
        own = lab == lab[i]
        if own.sum() <= 1:
            s.append(0.0)
            continue
        a = D[i, own].sum() / (own.sum() - 1)
        b = min(D[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s.append((b - a) / max(a, b))
    got = CL.silhouette(e.withColumn("labs", F.array(F.col("label").cast("long"))), "vec_id", "v", "labs",
                        block_rows=16, ref_block_rows=40).first()["silhouette"]
    assert got == pytest.approx(float(np.mean(s)), abs=1e-9)


def test_dbscan_hot_spot_and_dense_cells(spark):
    """A pile of 300 identical points, a dense patch beside it, a sparse
    chain and scattered noise; tiny tile blocks force salting."""
    rng = np.random.default_rng(11)
    pile = np.zeros((300, 2))
    patch = rng.uniform([0.05, 0.0], [0.6, 0.3], size=(400, 2))
    chain = np.column_stack([np.linspace(0.7, 1.6, 12), np.full(12, 0.1)])
    noise = rng.uniform([-2, -2], [3, 3], size=(150, 2))
    X = np.vstack([pile, patch, chain, noise])
    ids = np.arange(len(X)) * 7 + 3
    df = spark.createDataFrame([(int(i), float(a), float(b)) for i, (a, b) in zip(ids, X)],
                               "k long, x double, y double")
    for eps, ms in [(0.1, 5), (0.05, 4)]:
        want = _brute_dbscan(ids, X, eps, ms)
        got = {r["id"]: r["cluster"] for r in DB.dbscan(df, "k", ["x", "y"], [eps], ms, block_rows=16).collect()}
        assert got == want
        assert len(set(want.values())) >= 3


def test_connected_components_long_path(spark):
    """A 3,000-node path with shuffled ids (the old label propagation needed
    a round per few hops) plus a second, separate path."""
    rng = np.random.default_rng(5)
    ids = rng.permutation(4000) + 10
    path_a, path_b = ids[:3000], ids[3000:]
    e = [(int(a), int(b)) for p in (path_a, path_b) for a, b in zip(p[:-1], p[1:])]
    nodes = spark.createDataFrame([(int(i),) for i in ids], "id long")
    edges = spark.createDataFrame(e + [(b, a) for a, b in e], "src long, dst long")
    got = {r["id"]: r["label"] for r in DB.connected_components(nodes, edges).collect()}
    want = {int(i): int(path_a.min()) for i in path_a} | {int(i): int(path_b.min()) for i in path_b}
    assert got == want
