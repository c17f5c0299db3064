"""Ranks with payload columns, hash order, exact neighbours off the origin,
degenerate clusters, pages, model reload, text rules: against brute force."""

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import ROOT, SF_SMALL
from orrery import session
from orrery.functions import text as TX
from orrery.operators import cluster as CL
from orrery.operators import features as FE
from orrery.operators import models as ML
from orrery.operators import neighbors as NB
from orrery.operators import relational as rel
from orrery.operators import splits as SP
from orrery.operators import textops as TO
from orrery.sources import images as IMG
from orrery.sources import jsondocs as JD


def test_ranks_are_dense_with_payload_columns(spark):
    n = 240_000
    df = spark.range(n).select("id", (F.col("id") % 7).cast("string").alias("g"), F.sha1(F.col("id").cast("string")).alias("payload"),
                               F.rand(1).alias("more"))
    df = df.withColumn("g", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("g")))
    r = SP.group_index(df, ["g"], [rel.hash_order("id", 1), F.col("id")], "rank", 8)
    bad = r.groupBy("g").agg(F.count("*").alias("n"), F.countDistinct("rank").alias("d"), F.min("rank").alias("a"), F.max("rank").alias("b"))
    assert bad.filter("n != d or a != 0 or b != n - 1").count() == 0 and r.count() == n
    i = TO.global_index(df, [F.col("payload")], "idx", 8)
    assert i.agg(F.countDistinct("idx"), F.max("idx")).first() == (n, n - 1)
    nulls = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id long, g string")
    got = {r["id"]: r["rank"] for r in SP.group_index(nulls, ["g"], [F.col("id")]).collect()}
    assert got == {1: 0, 2: 1, 3: 0}


def test_hash_order_spreads_and_seeds_are_independent(spark):
    df = spark.range(100_000).select("id", (rel.hash_order("id", 1) % 5).alias("a"), (rel.hash_order("id", 2) % 5).alias("b"),
                                     (rel.hash_order(F.col("id") + 1000003, 1) % 5).alias("c"))
    for x, y in (("a", "b"), ("a", "c")):
        share = df.filter(f"{x} = 0 and {y} = 0").count() / df.filter(f"{x} = 0").count()
        assert abs(share - 0.2) < 0.01


@pytest.mark.parametrize("metric", ["euclidean", "sqeuclidean", "manhattan", "chebyshev", "cosine"])
def test_neighbours_off_the_origin(spark, metric):
    rng = np.random.default_rng(0)
    x = rng.random((300, 2)) + 1e8
    if metric == "cosine":
        x = rng.normal(size=(300, 2))
        x[5] = 0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    got = {}
    for r in NB.knn(df, df, 3, q_id="id", r_id="id", q_vec="v", r_vec="v", metric=metric, exclude_self=True,
                    block_rows=64, ref_block_rows=100).collect():
        got.setdefault(r["q_id"], []).append((r["rank"], r["r_id"], r["dist"]))
    assert len(got) == 300 and all(len(v) == 3 for v in got.values())
    for i in range(300):
        d = {"euclidean": lambda: np.sqrt(((x - x[i]) ** 2).sum(1)), "sqeuclidean": lambda: ((x - x[i]) ** 2).sum(1),
             "manhattan": lambda: np.abs(x - x[i]).sum(1), "chebyshev": lambda: np.abs(x - x[i]).max(1),
             "cosine": lambda: np.array([1 - (a @ x[i]) / (np.linalg.norm(a) * np.linalg.norm(x[i])) if a.any() and x[i].any() else 1.0
                                         for a in x])}[metric]()
        d[i] = np.inf
        assert np.allclose([t[2] for t in sorted(got[i])], np.sort(d)[:3])


def test_scores_of_degenerate_clusters(spark):
    rows = [(0, [0.0, 0.0], 1), (1, [0.0, 0.0], 1), (2, [0.0, 0.0], 2), (3, [0.0, 0.0], 2), (4, [5.0, 5.0], 3)]
    df = spark.createDataFrame(rows, "id long, v array<double>, c int")
    one = CL.silhouette(df.withColumn("l", F.array("c")), "id", "v", "l").first()["silhouette"]
    assert one == 0.0
    assert CL.davies_bouldin(df, "v", "c").first()["davies_bouldin"] == pytest.approx(0.0)
    assert CL.calinski_harabasz(df.filter("c = 3"), "v", "c").first()["calinski_harabasz"] == 1.0


def test_distances_to_many_centres_equal_the_inlined_ones(spark):
    rng = np.random.default_rng(3)
    pts = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.random((40, 3)))], "id long, v array<double>")
    cen = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.random((30, 3)))], "k long, c array<double>")
    a = NB.distances_to_centres(pts, "id", "v", cen, "k", "c")
    b = NB.distances_to_centres(pts, "id", "v", cen, "k", "c", inline_values=10, block_rows=7)
    assert a.columns == b.columns
    got = {r["id"]: r["distances"] for r in b.collect()}
    assert all(np.allclose(r["distances"], got[r["id"]]) for r in a.collect())


def test_named_levels_are_a_parameter(spark):
    df = spark.createDataFrame([(x,) for x in "aabbbcd"] + [(None,)], "s string")
    assert FE.fit_levels(df, "s", 2) == ["a", "b"] and FE.fit_levels(df, "s", 9) == list("abcd")
    assert {r["level"]: r["n"] for r in FE.level_table(df, "s").collect()} == {"a": 2, "b": 3, "c": 1, "d": 1}


def test_pages_of_a_hot_customer(spark):
    orders = spark.createDataFrame([(i * 70_000, 1 if i % 3 else 2, "O", 1.0 * i, "1-URGENT") for i in range(20)],
                                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string") \
        .withColumn("o_orderdate", F.to_timestamp(F.lit("1996-01-02")))
    lines = spark.createDataFrame([], "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string")
    cust = spark.createDataFrame([(1, "one", 0, "SEG")], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string")
    nation = spark.createDataFrame([(0, "N")], "n_nationkey int, n_name string")
    docs = JD.order_documents(orders, lines, cust, nation)
    d = docs.select("customer", "page", JD.parse_json("json", JD.ORDER_DOC_SCHEMA).alias("doc")).collect()
    by = {}
    for r in d:
        by.setdefault(r["customer"], []).append(r)
    assert {c: len(v) for c, v in by.items()} == {1: 7, 2: 4}  # 13 and 7 orders, two a page; no customer row for 2
    for c, pages in by.items():
        pages.sort(key=lambda r: r["page"])
        ids = [e["order"]["id"] for r in pages for e in r["doc"]["response"]]
        assert ids == sorted(ids) and {r["doc"]["results"] for r in pages} == {len(ids)}
        assert [r["doc"]["paging"]["current"] for r in pages] == list(range(1, len(pages) + 1))
        assert {r["doc"]["paging"]["total"] for r in pages} == {len(pages)}


def test_json_and_image_files_are_read(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"get": "x",\n "results": 2,\n "response": []}')
    (tmp_path / "b.json").write_text('{"get": "y"}')
    got = JD.read_json_documents(spark, str(tmp_path), JD.ORDER_DOC_SCHEMA).select("get", "results").collect()
    assert sorted((r["get"], r["results"]) for r in got) == [("x", 2), ("y", None)]
    ppm = tmp_path / "img"
    ppm.mkdir()
    import base64
    # a 1 x 1 red GIF
    (ppm / "p.gif").write_bytes(base64.b64decode("R0lGODdhAQABAIAAAP8AAAAAACwAAAAAAQABAAACAkQBADs="))
    rows = IMG.read_images(spark, str(ppm)).collect()
    assert len(rows) == 1


def test_text_rules(spark):
    df = spark.createDataFrame([("a b　c  d\n", "514- 848 -2424")], "t string, p string")
    r = df.select(TX.whitespace_tokens("t").alias("w"), TX.normalise_phone("p").alias("p")).first()
    assert r["w"] == ["a", "b", "c", "d"] and r["p"] == "(514) 848-2424"


@pytest.mark.parametrize("kind,least", [("logistic", 0.95), ("tree", 0.9), ("forest", 0.9), ("gbt", 0.9), ("mlp", 0.9), ("svm", 0.9)])
def test_classifiers_learn_what_can_be_learnt(spark, kind, least):
    from pyspark.ml.functions import array_to_vector
    rng = np.random.default_rng(5)
    y = np.arange(600) % 3
    x = np.stack([3 * (y == 0), 3 * (y == 1), 3 * (y == 2), 0 * y], 1) + rng.normal(size=(600, 4))
    df = spark.createDataFrame([(i, v.tolist(), float(c)) for i, (v, c) in enumerate(zip(x, y))], "id long, v array<double>, label double")
    df = df.select("id", array_to_vector("v").alias("features"), "label")
    kw = {"mlp": {"layers": [4, 8, 3]}}.get(kind, {})
    try:
        est = ML.classifier(kind, n_train=450, **kw)
    except (KeyError, ValueError):
        pytest.skip(f"no classifier is called {kind}")
    out = est.fit(df.filter("id < 450")).transform(df.filter("id >= 450"))
    assert out.filter("prediction = label").count() / 150 > least


def test_scratch_needs_a_shared_folder(monkeypatch, spark):
    class Conf:
        def get(self, k, d=None):
            return None

    class Ctx:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class S:
        sparkContext, conf = Ctx(), Conf()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(S())


CODE = """
import sys; sys.path.insert(0, {root!r})
from orrery.session import get_session
from orrery.plans import registry
registry.load_all()
s = get_session("local[2]", shuffle_partitions=2, extra={{"spark.checkpoint.dir": {folder!r}}})
rows = registry.QUERIES["snk3_fit_or_load"](s, {sf!r}).collect()
from orrery.plans.q_models import ML
print("SAME", all(r["fitted"] == r["reloaded"] for r in rows), len(rows))
"""


def test_model_is_reloaded_by_a_later_session(tmp_path):
    """Two processes share one model folder: the second must not fit."""
    run = lambda extra="": subprocess.run([sys.executable, "-c", extra + CODE.format(root=ROOT, folder=str(tmp_path), sf=SF_SMALL)],
                                          capture_output=True, text=True, timeout=300)
    a = run()
    assert "SAME True" in a.stdout, a.stderr[-2000:]
    saved = sorted(os.path.join(d, f) for d, _, fs in os.walk(tmp_path / "models") for f in fs)
    stamp = {f: os.path.getmtime(f) for f in saved}
    b = run()
    assert "SAME True" in b.stdout, b.stderr[-2000:]
    assert stamp and {f: os.path.getmtime(f) for f in saved} == stamp
