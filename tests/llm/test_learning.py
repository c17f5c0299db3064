"""op3 and op10: fits, held-out accuracy and defined results."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from orrery.llm import q_classify, quality, sampling, toxicity

DOC = "doc_id long, text string, score string, row int"


def held_out(spark, query, label):
    got = {r["doc_id"]: r for r in query(spark, SF_MID).collect()}
    marks = spark.read.parquet(f"{SF_MID}/labels.parquet").select("doc_id", label).collect()
    return got, [(got[r["doc_id"]], r[label]) for r in marks if got[r["doc_id"]]["held_out"]]


def test_quality_on_held_out_labels(spark):
    got, test = held_out(spark, q_classify.op3_quality, "quality")
    assert len(got) == 1000 and all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert sum(r["predicted"] == y for r, y in test) / len(test) > 0.94
    assert all((r["score"] >= 0.7) == (r["predicted"] == 1) and 0 <= r["score"] <= 1 for r in got.values())


def test_toxicity_on_held_out_labels(spark):
    got, test = held_out(spark, q_classify.op10_toxicity, "toxic")
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    clean, toxic = [r["predicted"] for r, y in test if not y], [r["predicted"] for r, y in test if y]
    assert sum(clean) <= 0.04 * len(clean) and sum(toxic) >= 0.5 * len(toxic)


def test_prior_and_risk_on_a_known_mixture():
    rng = np.random.default_rng(1)
    pos, neg = rng.normal(1.5, 1, (3000, 4)), rng.normal(-1.5, 1, (3000, 4))
    unl = np.concatenate([pos[1500:1500 + 900], neg[:600]])
    net, prior = quality.fit(pos[:1500], unl)
    assert 0.5 < prior < 0.72
    s = quality.sigmoid(net.logit(np.concatenate([pos[2400:], neg[600:1200]])))
    assert ((s > 0.5) == (np.arange(1200) < 600)).mean() > 0.95


def test_negative_risk_is_held_at_zero():
    x = np.random.default_rng(2).normal(size=(400, 3))
    net, prior = quality.fit(x, x)  # nothing but positives: nothing may be driven away from them
    assert prior > 0.75 and quality.sigmoid(net.logit(x)).mean() > 0.6


def rows(spark):
    return spark.createDataFrame([(1, None, "a", 1), (2, "", "b", 2), (3, "fine words here.", None, 3), (3, "fine words here.", None, 3),
                                  (None, "you idiot", "c", 4), (5, "long text " * 100_000, "d", 5)], DOC)


def test_defined_results(spark):
    docs = rows(spark)
    for model in (None, quality.fit(np.random.default_rng(0).normal(size=(50, 20)), np.random.default_rng(1).normal(size=(60, 20)))):
        out = quality.score(docs, model)
        assert out.columns == ["doc_id", "text", "row", "score"] and out.count() == 6
        assert all(0 <= r["score"] <= 1 for r in out.collect())
        kept = quality.accepted(docs, model, 0.0)
        assert kept.columns == docs.columns and sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
    bags = [("you idiot. ok then.", 1), ("what an idiot", 1), ("all is fine. ok then.", 0), ("nice words", 0)] * 6
    model = toxicity.fit(bags, {0: 1.0, 1: 1.0})
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert got[1]["score"] == got[2]["score"] == 0 and got[None]["score"] > 0.5 > got[5]["score"]
    assert [(s["start"], s["length"]) for s in got[None]["offending"]] == [(0, 9)]
    assert toxicity.clean(docs, model).columns == docs.columns and toxicity.clean(docs, model).count() == 5
    assert toxicity.score(docs, None).agg(F.max("score")).first()[0] == 0
    assert toxicity.score(docs.limit(0), model).count() == quality.score(docs.limit(0), None).count() == 0


def test_offending_sentences_are_located(spark):
    bags = [(f"Sentence number {i} is fine. {'You are scum!' if i % 2 else 'You are kind!'}\nAnd more follows here.", i % 2) for i in range(60)]
    model = toxicity.fit(bags, {0: 1.0, 1: 1.0})
    text = "Hello there, é.\nYou are scum! Good bye."
    r = toxicity.score(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert [text[s["start"]:s["start"] + s["length"]] for s in r["offending"]] == ["You are scum!"] and r["score"] > 0.5


def test_training_needs_both_labels_and_takes_bounded_samples(spark):
    docs = rows(spark).select("doc_id", "text")
    one = spark.createDataFrame([(3, 1), (None, 0), (77, 0)], "doc_id long, label int")
    assert toxicity.train(docs, one) is None  # the clean document is not there
    assert toxicity.train(docs, one.limit(0)) is None and quality.train(docs, one.limit(0)) is None
    assert quality.train(docs.limit(0), one) is None
    many = spark.range(1000).withColumnRenamed("id", "doc_id")
    a = sampling.in_hash_order(many, 50, 1, "x").collect()
    assert a == sampling.in_hash_order(many.repartition(9), 50, 1, "x").collect() and len(a) == 50
    both = spark.createDataFrame([(3, 1), (5, 0)], "doc_id long, label int")
    assert toxicity.train(docs, both, max_chars=1000) is None  # whole texts or none


@pytest.mark.parametrize("text", ["", " \n", "a", "|", "é", "A" * 50_000])
def test_features_are_finite(text):
    x = quality.text_features()(text)
    assert len(x) == 20 and np.isfinite(x).all()
