"""Whole jobs that the review of round 2 found cut short."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from orrery.operators import cluster as CL
from orrery.operators import features as FE
from orrery.plans import q_cluster as QC
from orrery.plans import q_models as QM
from orrery.plans import registry
from orrery.sources.tables import table


def _kmeans(x, c, max_iter=100):
    """Labels, inertia of the last centres and the rounds, until inertia stops falling."""
    least, rounds = np.inf, 0
    while True:
        d = ((x[:, None] - c[None]) ** 2).sum(2)
        near = d.argmin(1)
        cost = d.min(1).sum()
        if rounds == max_iter or not cost < least:
            return near, cost, rounds
        least, rounds = cost, rounds + 1
        c = np.array([x[near == j].mean(0) if (near == j).any() else c[j] for j in range(len(c))])


@pytest.fixture(scope="module")
def vectors(spark):
    e = QC._emb(spark, SF_SMALL)
    rows = e.orderBy("vec_id").collect()
    start = lambda k: np.array(CL.initial_centres(e, "vec_id", "v", k, seed=5))
    return [r["vec_id"] for r in rows], np.array([r["v"] for r in rows]), start


def test_kmeans_fits_until_inertia_stops_falling(spark, vectors):
    ids, x, start = vectors
    near, _, rounds = _kmeans(x, start(10))
    assert rounds > 4
    got = {r["vec_id"]: r["cluster"] for r in registry.QUERIES["ml13_kmeans_fit"](spark, SF_SMALL).collect()}
    assert got == dict(zip(ids, near))


def test_k_sweep_and_elbow_of_finished_fits(spark, vectors):
    _, x, start = vectors
    want = {k: _kmeans(x, start(k))[1] for k in QC._KS}
    got = {r["k"]: r["wsse"] for r in registry.QUERIES["ml14_k_sweep"](spark, SF_SMALL).collect()}
    assert got == {k: pytest.approx(w, abs=1e-4) for k, w in want.items()}
    slope = np.diff([want[k] for k in sorted(want)])
    hits = [i for i in range(1, len(slope)) if abs(slope[i - 1]) - abs(slope[i]) > 100]
    k = sorted(want)[hits[0] if hits else 1]
    elbow = registry.QUERIES["win1_elbow_kmeans"](spark, SF_SMALL).collect()
    assert [(r["k"], r["wsse"]) for r in elbow] == [(k, pytest.approx(want[k], abs=1e-4))]


def test_palette_of_a_finished_fit(spark, vectors):
    ids, x, start = vectors
    c = start(16)
    for _ in range(_kmeans(x, c)[2]):
        near = ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)
        c = np.array([x[near == j].mean(0) if (near == j).any() else c[j] for j in range(16)])
    d = ((x[:, None] - c.round(2)[None]) ** 2).sum(2)
    got = {r["vec_id"]: r for r in registry.QUERIES["ml17_vector_quantisation"](spark, SF_SMALL).collect()}
    assert [got[i]["code"] for i in ids] == d.argmin(1).tolist()
    assert np.allclose([got[i]["sq_error"] for i in ids], d.min(1), atol=1e-6)


def test_kmeans_keeps_a_centre_without_members_and_heeds_max_iter(spark):
    x = [[0.0], [1.0], [2.0], [9.0], [10.0], [30.0]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "id long, v array<double>").repartition(3)
    start = {2: [[0.0], [1.0]], 3: [[0.0], [1.0], [500.0]]}
    for rounds in (1, 2, 100):
        got = CL.lloyd(df, "v", start, rounds)
        for k, c in start.items():
            c = np.array(c)
            for _ in range(rounds):
                near = np.abs(np.array(x) - c.T).argmin(1)
                c = np.array([np.array(x)[near == j].mean(0) if (near == j).any() else c[j] for j in range(k)])
            assert np.allclose(got[k], c)
    assert CL.lloyd(df, "v", start)[3][2] == [500.0]


def test_one_hot_keeps_every_level(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    n = 1203
    df = spark.range(2 * n).select(F.format_string("l%04d", F.col("id") % n).alias("s"))
    levels = sorted(r["level"] for r in FE.level_table(df, "s").collect())
    assert levels == [f"l{i:04d}" for i in range(n)]
    model = Pipeline(stages=FE.one_hot_pipeline("s", "hot")).fit(df)
    some = spark.createDataFrame([("l0000",), ("l1202",), ("new",), (None,)], "s string")
    hot = [list(np.flatnonzero(r[0])) for r in model.transform(some).select(vector_to_array("hot")).collect()]
    assert hot == [[0], [1202], [], []]
    assert [sum(r) for r in some.select(*FE.one_hot("s", levels[-2:])).collect()] == [0, 1, 0, 0]


def test_best_model_by_accuracy_and_by_scores_of_a_class(spark):
    cols = "model string, ordinal int, accuracy double, macro_recall double, macro_precision double, class_recall double, class_precision double"
    rows = [("a", 0, 0.9, 0.5, 0.5, 0.2, 0.7), ("b", 1, 0.8, 0.5, 0.5, 0.6, 0.7), ("c", 2, 0.7, 0.5, 0.5, 0.6, 0.1)]
    got = QM.flag_best(spark.createDataFrame(rows, cols)).collect()
    best = lambda flag, rows: [r["model"] for r in rows if r[flag]]
    assert best("is_best", got) == ["a"] and best("is_best_recall", got) == ["b"] and best("is_best_precision", got) == ["a"]
    none = QM.flag_best(spark.createDataFrame([(*r[:5], None, None) for r in rows], cols)).collect()
    assert best("is_best", none) == ["a"] and not best("is_best_recall", none) and not best("is_best_precision", none)


def test_model_comparison_reports_the_class(spark):
    got = registry.QUERIES["ml20_model_comparison"](spark, SF_SMALL).collect()
    for score, flag in (("class_recall", "is_best_recall"), ("class_precision", "is_best_precision")):
        assert [r[score] for r in got if r[flag]] == [max(r[score] for r in got)]
