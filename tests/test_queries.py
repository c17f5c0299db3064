"""Every registered query against its DuckDB oracle on the smallest scale
factor; queries without an oracle must run and keep a stable schema."""

import os
import sys

import numpy as np
import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import duck, rows_of  # noqa: E402
from orrery.operators.relational import hash_order_sql  # noqa: E402

QUERIES = {k: f for k, f in E.queries().items() if not k.startswith("op") and k != "pipeline"}  # those: tests/llm
ORACLES = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


def held_out(con, seed=11):
    return {r[0]: r[1] for r in con.execute(
        f"SELECT vec_id, label FROM embeddings WHERE {hash_order_sql('vec_id', seed)} % 5 = 0").fetchall()}


def predictions(own_label=True, several=True):
    """One row for each held-out vector, with its label, and a label
    predicted that occurs.  (These labels do not follow from the vectors, so
    accuracy says nothing here: tests/test_round2.py has learnable ones.)"""
    def check(pdf, con):
        want = held_out(con)
        assert set(pdf.vec_id) == set(want) and len(pdf) == len(want)
        if own_label:
            assert dict(zip(pdf.vec_id, pdf.label)) == want
        assert set(pdf.prediction) <= {r[0] for r in con.execute("SELECT DISTINCT label FROM embeddings").fetchall()}
        assert not several or pdf.prediction.nunique() > 1
    return check


def emb(con):
    rows = con.execute("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall()
    return np.array([r[1] for r in rows], float)


def pca(pdf, con):
    x = emb(con)
    x = x - x.mean(0)
    val, vec = np.linalg.eigh(np.cov(x.T))
    val, vec = val[::-1], vec[:, ::-1]
    got = pdf.sort_values("vec_id")
    for i, c in ((0, "pc1"), (1, "pc2")):
        p = x @ vec[:, i]
        assert min(np.abs(got[c] - p).max(), np.abs(got[c] + p).max()) < 1e-6
        assert np.allclose(got[f"ratio{i + 1}"], val[i] / val.sum(), atol=1e-6)


def pca_fraction(pdf, con):
    val = np.linalg.eigvalsh(np.cov(emb(con).T))[::-1]
    share = np.cumsum(val) / val.sum()
    assert all(r.n_components == int(np.argmax(share >= r.fraction - 1e-12)) + 1 for r in pdf.itertuples())


def polynomials(pdf, con):
    x, y = (np.array(v) for v in zip(*con.execute("SELECT l_quantity / 10, l_extendedprice / 1000 FROM lineitem").fetchall()))
    assert sorted(pdf.degree) == [1, 2, 3, 4]
    for r in pdf.itertuples():
        want = np.polyfit(x, y, r.degree)
        assert np.allclose(r.coefficients, want, atol=1e-3)
        assert abs(r.r2 - (1 - ((y - np.polyval(want, x)) ** 2).sum() / ((y - y.mean()) ** 2).sum())) < 1e-5


def regression(pdf, con):
    t = con.execute(f"SELECT *, {hash_order_sql('l_orderkey', 3)} % 5 = 0 AS test FROM lineitem").df()
    num = t[["l_quantity", "l_discount", "l_tax"]].to_numpy(float)
    hot = np.stack([(t[c] == v).to_numpy(float) for c in ("l_returnflag", "l_linestatus") for v in sorted(t[c].unique())], axis=1)
    x = np.column_stack([np.ones(len(t)), num, hot])
    test = t.test.to_numpy(bool)
    w = np.linalg.lstsq(x[~test], t.l_extendedprice[~test], rcond=None)[0]
    y = t.l_extendedprice[test].to_numpy()
    least = ((y - x[test] @ w) ** 2).mean()
    assert len(pdf) == test.sum()
    assert ((pdf.l_extendedprice - pdf.prediction) ** 2).mean() < 1.02 * least  # as good as least squares


def pruned(pdf, con):
    assert pdf.kept.any() and set(pdf.kept) <= {True, False} and pdf.feature.is_unique


def ranked(pdf, con):
    d = pdf.sort_values("rank")
    assert d["rank"].iloc[0] == 1 and d.mean_score.is_monotonic_decreasing and d.mean_score.between(0, 1).all()
    assert d.mean_score.iloc[0] > 0.1


def compared(pdf, con):
    assert pdf.is_best.sum() == 1 and pdf[pdf.is_best].accuracy.iloc[0] == pdf.accuracy.max()
    assert pdf.accuracy.between(0, 1).all() and pdf.macro_recall.between(0, 1).all()


def points(pdf, con):
    keys = con.execute("SELECT count(*) FROM customer").fetchone()[0]
    assert len(pdf) > keys and pdf.groupby("kind").id.apply(lambda s: s.is_unique).all()
    ring = pdf[pdf.kind == "circles"]
    if len(ring):
        r = np.hypot(ring.x0, ring.x1).groupby(ring.label).mean()
        assert r.max() / r.min() > 1.3  # one ring inside the other


def same_after_reload(pdf, con):
    assert (pdf.fitted == pdf.reloaded).all() and pdf.from_disk.all() and dict(zip(pdf.vec_id, pdf.label)) == held_out(con)


def importances(pdf, con):
    assert len(pdf) == 64 and (pdf.importance >= 0).all() and abs(pdf.importance.sum() - 1) < 1e-6


def binary(pdf, con):
    marks = dict(con.execute("SELECT doc_id, quality FROM labels").fetchall())
    assert set(pdf.prediction) <= {0, 1} and pdf.doc_id.is_unique and len(pdf)
    got = (pdf.prediction == pdf.label).mean()
    assert got >= 0.6 and all(int(l) in (0, 1) for l in pdf.label) and set(pdf.doc_id) <= set(marks)


PROPERTIES = {
    "fe7_pca_projection": pca, "fe10_corr_prune_greedy": pruned, "fe8_pca_fraction": pca_fraction, "fe13_feature_importance": importances,
    "ml3_polynomial_regression": polynomials, "ml4_multi_feature_regression": regression, "src11_point_sets": points,
    "ml5_logistic_multinomial": predictions(), "ml5_logistic_binary": binary, "ml6_decision_tree": predictions(),
    "ml7_random_forest": predictions(), "ml8_gbt_one_vs_rest": predictions(own_label=False), "ml8_multinomial_boosting": predictions(), "ml9_multilayer_perceptron": predictions(),
    "ml10_linear_svm": predictions(), "ml11_rbf_svm_random_features": predictions(),
    "ml18_grid_search_cv": ranked, "ml18_grid_search_refit": predictions(several=False), "ml19_random_search_cv": ranked, "ml20_model_comparison": compared,
    "ml21_score_new_rows": predictions(), "ml21_score_new_rows_stream": predictions(), "snk3_fit_or_load": same_after_reload,
}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["l_returnflag", "slope", "intercept", "r2", "n"]
    assert df.count() >= 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    pdf = sdf.toPandas()
    assert len(pdf.columns) > 0
    check = PROPERTIES.get(name)
    if check is not None:
        check(pdf, con)
    if name not in ORACLES:
        assert check is not None, f"nothing checks {name}"
        return
    ddf = con.execute(ORACLES[name]).df()
    sc, sr = rows_of(pdf)
    dc, dr = rows_of(ddf)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr
