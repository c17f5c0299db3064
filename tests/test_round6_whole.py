"""Radius joins of all rows, and sweeps of eps whose points stay on the
executors: rows of their own."""

import math

import numpy as np
from pyspark.sql import functions as F

from orrery import session
from orrery.operators import dbscan as DB
from orrery.operators import density as DN
from orrery.plans import q_cluster, registry


def _pairs(ids, x, eps):
    out = []
    for i in range(len(ids)):
        for j in range(len(ids)):
            d = math.sqrt(sum((p - q) * (p - q) for p, q in zip(x[i], x[j])))
            if ids[i] is not None and ids[j] is not None and ids[i] < ids[j] and d <= eps:
                out.append((ids[i], ids[j], round(d, 6)))
    return sorted(out)


def test_radius_join_of_all_customers(spark, tmp_path):
    """also customers whose keys are far apart are a pair; repeated and
    null keys, null balances."""
    registry.load_all()
    rng = np.random.default_rng(5)
    rows = [(int(k), round(float(rng.uniform(-999, 9999)), 2), int(rng.integers(25))) for k in range(0, 60_000, 100)]
    rows += [(7, 100.0, 3), (7, 110.0, 3), (450_000, 100.0, 3), (451_000, None, 3), (None, 100.0, 3), (452_000, 100.0, None)]
    spark.createDataFrame(rows, "c_custkey long, c_acctbal double, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    got = sorted(tuple(r) for r in registry.QUERIES["jn3_radius_join"](spark, str(tmp_path)).collect())
    rows = [r for r in rows if None not in r[1:]]
    assert got == _pairs([r[0] for r in rows], [(r[1] / 1000, r[2] / 3.0) for r in rows], 0.3)
    assert any(a // 150 != b // 150 for a, b, _ in got)


def test_radius_pairs_once_in_blocks(spark):
    """points that rounding puts two cells apart; a cell of many rows is
    dealt to several tasks; every pair once."""
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.uniform(-2, 2, (200, 2)), rng.normal(0.5, 0.02, (150, 2)), [[-1e-20, 9.0], [0.3, 9.0]]])
    ids = [int(i) for i in rng.permutation(len(x))]
    pts = spark.createDataFrame([(i, *map(float, v)) for i, v in zip(ids, x)], "id long, x double, y double")
    want = _pairs(ids, x.tolist(), 0.3)
    assert (min(ids[-2:]), max(ids[-2:]), 0.3) in want
    for block in (40, 5_000):
        both = DB.radius_pairs(pts, "id", ["x", "y"], 0.3, include_self=False, block_rows=block).collect()
        once = DB.radius_pairs(pts, "id", ["x", "y"], 0.3, once=True, block_rows=block)
        assert sorted((r[0], r[1], round(r[2], 6)) for r in once.collect()) == want
        assert sorted((r[0], r[1], round(r[2], 6)) for r in both) == sorted(want + [(b, a, d) for a, b, d in want])
    assert "BroadcastHashJoin" not in once._jdf.queryExecution().executedPlan().toString()


def test_points_of_a_sweep_are_not_broadcast(spark, tmp_path, monkeypatch):
    """tables with a row for each point stay on the executors, however
    few bytes their files have."""
    plans = {}

    def seen(name, cut=session.cut_lineage):
        def run(df, path=None):
            plans.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
            return cut(df, path)
        return run
    rng = np.random.default_rng(7)
    rows = [(i, round(float(rng.uniform(-999, 9999)), 2), int(rng.integers(25))) for i in range(400)]
    spark.createDataFrame(rows, "c_custkey long, c_acctbal double, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    for module in (session, DN, q_cluster):
        monkeypatch.setattr(module, "cut_lineage", seen(module.__name__))
    tree = DN.reachability(q_cluster._points(spark, str(tmp_path)).select("c_custkey", F.array("x", "y").alias("v")), "c_custkey", "v", 4, 1.0)
    cut = DN.cuts(*tree, [0.4, 1.0])
    both = spark.createDataFrame([(0, 1), (1, 0), (2, 1), (1, 2)], "src long, dst long")
    parts = DB.connected_components(both.select(F.col("src").alias("id")).distinct(), both)
    assert {r["label"] for r in parts.collect()} == {0}
    # numbering the clusters broadcasts one row for each partition (_p)
    found = [p for ps in plans.values() for p in ps] + [cut._jdf.queryExecution().executedPlan().toString()]
    assert sum("SortMergeJoin" in p for p in found) > 8
    bad = [p for p in found if p.count("BroadcastHashJoin") > p.count("struct<_p:int")]
    assert not bad, bad
    plans.clear()
    q_cluster._sweep_scores(spark, str(tmp_path), [0.4, 0.45])
    points = [p for p in plans[q_cluster.__name__] if "c_acctbal" in p]
    assert points and all("SortMergeJoin" in p for p in points)
