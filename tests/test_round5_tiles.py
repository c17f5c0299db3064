"""Tiles of the pivot index: pairs met one way, sums of whole numbers, floats
that stay floats, queries that are written once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.operators import dbscan as DB
from orrery.operators import neighbors as NB
from orrery.operators import pivots
from orrery.plans import q_models

VEC = "id long, v array<float>"


@pytest.mark.parametrize("shelf_rows", [64, 1000])
def test_pairs_once(spark, shelf_rows):
    """every pair once, from half the distances; repeated and null ids."""
    x = np.random.default_rng(1).normal(size=(400, 9)).astype(np.float32)
    x[30:40] = x[3]
    ids = [None if i == 5 else i // 2 if i < 20 else i for i in range(400)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)] + [(900, None)], VEC).repartition(3)
    got = sorted((a, b) for a, b, _ in DB.ball_pairs(df, "id", "v", 3.0, shelf_rows=shelf_rows, once=True).collect())
    d = pivots.pair_distances("euclidean", x.astype(float), x.astype(float))
    want = sorted((ids[i], ids[j]) for i, j in zip(*np.nonzero(d <= 3.0)) if None not in (ids[i], ids[j]) and ids[i] < ids[j])
    assert got == want and len(want) > 300
    df = df.filter("id is not null")
    index = pivots.build(df, "id", "v", shelf_rows=40, max_pivots=12)
    both = pivots.within(df, index, 3.0, "id", "v").agg(F.sum("tested")).first()[0]
    once = pivots.pairs_once(index, spark, 3.0).agg(F.sum("tested")).first()[0]
    assert once < 0.75 * both


def test_whole_number_sums():
    """manhattan pairs by sums of 16-bit differences, exact afterwards."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 30))
    d = pivots.pair_distances("manhattan", x[:90], x)
    limit = np.quantile(d, 0.05, axis=1)
    qi, ri, cut = pivots._whole_numbers(x[:90], x, limit)
    assert qi.dtype == np.int16 and np.abs(qi[:, :, None].astype(int) - ri[None]).sum(1).max() < 2 ** 15
    # an outlier makes the numbers too coarse: floats take over
    assert pivots._whole_numbers(x[:90], np.concatenate([x, [[1e6] * 30]]), limit) is None
    for y in (x, np.concatenate([x, [[1e6] * 30]])):
        row, col, got = pivots.close_pairs("manhattan", x[:90], y, limit)
        w = np.nonzero(d <= limit[:, None])
        assert (row == w[0]).all() and (col == w[1]).all() and (got == d[w]).all()


def test_floats_travel_as_floats_and_queries_are_written_once(spark):
    """neither vectors nor routed queries are written wider or more
    often than they are stored."""
    x = np.random.default_rng(4).normal(size=(600, 10)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], VEC).repartition(3)
    index = pivots.build(df, "id", "v", keep_ids=4, shelf_rows=60)
    assert index.shelves > 5 and index.placed.schema["vec"].dataType.simpleString() == "array<float>"
    q = pivots._queries(df, "id", "v", 100.0)
    sent = pivots.routed(q, index, "all")
    assert sent.schema["q_vec"].dataType.simpleString() == "array<float>" and sent.count() == 600 * index.shelves
    written = spark.read.parquet(*sent.inputFiles())
    assert written.count() == 600
    d = pivots.pair_distances("euclidean", x.astype(float), x.astype(float))
    want = {(i, int(j)) for i in range(600) for j in np.argsort(d[i], kind="stable")[:4]}
    got = NB.knn(df, df, 4, q_id="id", r_id="id", q_vec="v", r_vec="v", ref_block_rows=60)
    assert {(r["q_id"], r["r_id"]) for r in got.collect()} == want


def test_random_features_are_made_once(spark, monkeypatch):
    """the classes are fitted on written features in few partitions."""
    from conftest import SF_SMALL
    seen = []

    class Stop(Exception):
        pass

    class Fake:
        def fit(self, df):
            seen.append(df)
            raise Stop

    monkeypatch.setattr(q_models.ML, "classifier", lambda *a, **k: Fake())
    with pytest.raises(Stop):
        q_models.ml11(spark, SF_SMALL)
    assert "ArrowEvalPython" not in seen[0]._jdf.queryExecution().executedPlan().toString()
    assert seen[0].rdd.getNumPartitions() == 1
