"""What grows with the tables: tasks that hold pages, blocks of vectors, cells
and dense points, each against brute force on rows of its own."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.functions import html as H
from orrery.operators import cluster as CL
from orrery.operators import dbscan as DB
from orrery.operators import density as DN
from orrery.operators import neighbors as NB
from orrery.operators import pivots

VEC = "id long, v array<double>"


def frame(spark, x, parts=4):
    return spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], VEC).repartition(parts)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_nested_cells_are_read_where_the_page_is(spark):
    """No task sorts or gathers the cells of many pages (F1)."""
    pages = spark.createDataFrame([(i, f"<table><tr><td>{i}</td><td><table a=b><tr><th>x</table></table></table><td>") for i in range(300)] + [(None, "<table><td>n")],
                                  "id long, html string")
    cells = H.table_cells(pages, "id", "html")
    assert not any(x in plan(cells) for x in ("Window", "Sort", "Exchange"))
    got = {tuple(r) for r in cells.filter("page_id >= 298 or page_id is null").collect()}
    assert got == {(i, *c) for i in (298, 299) for c in ((0, None, 1, "", 0, 0, False, str(i)), (0, None, 1, "", 0, 1, False, ""), (1, 0, 2, "a=b", 0, 0, True, "x"))}


def test_close_pairs_and_cosine_by_narrow_products():
    """Exact answers after a first look at narrow numbers (F5, F7, F8), with
    copies, ties at the limit, far off the origin and rows that are not finite."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 20))
    x[10:20] = x[9]
    for y in (x, x + 1e7, np.where(np.arange(300)[:, None] == 7, np.nan, x)):
        for metric in pivots.METRICS[:1] + pivots.METRICS[2:]:
            d = pivots.pair_distances(metric, y[:80], y)
            limit = np.nanquantile(d, 0.2, axis=1)
            row, col, got = pivots.close_pairs(metric, y[:80], y, np.nan_to_num(limit))
            want = np.nonzero(d <= np.nan_to_num(limit)[:, None])
            assert (row == want[0]).all() and (col == want[1]).all() and (got == d[want]).all()
    none = (np.zeros(0, int), np.zeros(0, int))
    row, col, got = NB._nearest_cosine(x[:50], x, 12, none)
    n = x / np.linalg.norm(x, axis=1)[:, None]
    want = 1 - (n[:50, None] * n[None]).sum(2)
    order = np.array([np.lexsort((np.arange(300), w))[:12] for w in want])
    assert (col.reshape(50, 12) == order).all() and np.allclose(got, np.take_along_axis(want, order, 1).ravel())


def test_distances_by_product_keep_copies_at_zero():
    """copies are at distance 0 also far off the origin."""
    x = np.random.default_rng(4).normal(size=(200, 16)) * 0.1 + 1000
    x[50:90] = x[3]
    d = CL._all_distances(x[:60], x)
    want = pivots.pair_distances("euclidean", x[:60], x)
    assert np.abs(d - want).max() < 1e-6 and (d[50:60, 50:90] == 0).all()


def test_blocks_grow_with_the_table(spark):
    """of rows twice as many no row is copied to twice as many tasks."""
    sizes = []
    for n in (40_000, 80_000):
        q = spark.range(n).selectExpr("id % 4 as shelf", "id as q_id", "array(0D) as q_vec", "0D as limit")
        r = spark.range(4).selectExpr("id as shelf", "array(0D) as vec")

        def one(left, right):
            import pyarrow as pa
            return pa.table({"n": pa.array([left.num_rows], pa.int64())})
        sizes.append(pivots.met(q, r, 4, one, "n long", None).count())
    assert sizes[1] < 1.7 * sizes[0]


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "chebyshev"])
def test_forest_of_boxes(metric):
    """two dense lines and loose points; as heavy as a forest of all
    pairs, from few of them."""
    rng = np.random.default_rng(5)
    x = np.concatenate([np.c_[rng.uniform(0, 10, 1500), np.zeros(1500)], np.c_[rng.uniform(0, 10, 1500), np.full(1500, 0.3)],
                        rng.uniform(0, 10, (200, 2))])
    core, ids = rng.uniform(0, 0.02, len(x)), rng.permutation(len(x)) + 5
    w = np.maximum(np.maximum(pivots.pair_distances(metric, x, x), core[:, None]), core[None])
    own = 2000
    a, b = np.nonzero((w <= 0.6) & (np.arange(len(x))[:, None] < np.arange(len(x))) & (np.arange(len(x))[:, None] < own))
    want = DN.forest(a, b, w[a, b])
    seen, real = [], pivots.pair_distances
    pivots.pair_distances = lambda m, q, r: seen.append(len(q) * len(r)) or real(m, q, r)
    try:
        got = DN.near_forest(metric, 0.6, ids, core, x, own, group=32)
    finally:
        pivots.pair_distances = real
    assert len(got[2]) == len(want) and abs(got[2].sum() - w[a, b][want].sum()) < 1e-9
    assert sum(seen) < len(x) ** 2 / 3


def test_cuts_of_a_tree_too_large_for_a_task(spark):
    x = np.concatenate([np.random.default_rng(6).normal(size=(400, 2)), [[50.0, 50.0]]])
    tree = DN.reachability(frame(spark, x), "id", "v", 4, 0.8)
    eps = [0.4, 0.1, 0.8, 0.2]
    small, large = (sorted(map(tuple, DN.cuts(*tree, eps, bound=b).collect())) for b in (10**6, 1))
    assert small == large and len(small) == 4 * len(x)


def test_grid_copies_only_sparse_points(spark):
    """a dense spot is not copied to its neighbour cells; F11: rows are
    dealt out before they become nine."""
    rng = random.Random(8)
    pts = spark.createDataFrame([(i, rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(500)], "id long, x double, y double").coalesce(1)
    p = plan(DB.radius_pairs(pts, "id", ["x", "y"], 0.2))
    below = p[p.index("Generate"):]
    assert "REPARTITION_BY_NUM" in below
    x = np.array([r[1:] for r in pts.orderBy("id").collect()])
    near = ((x[:, None] - x[None]) ** 2).sum(2) <= 0.2 ** 2
    assert {(r["id_a"], r["id_b"]) for r in DB.radius_pairs(pts, "id", ["x", "y"], 0.2).collect()} == set(zip(*map(list, np.nonzero(near))))
