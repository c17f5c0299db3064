"""Bounds of the fits' samples, columns of any name, repeated rows and empty
tables; gradients of the fits; sketches from parts; deep pages."""

import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.llm import fingerprints, html_crf, quality, simhash, toxicity

DOC = "doc_id long, text string"
ODD = ["a.b", "_stay_id", "_row", "_t", "row", "t", "id", "n", "s", "u", "score", "class", "f", "tick`s"]


def odd(df):
    for c in ODD:
        df = df.withColumn(c, F.lit("own " + c))
    return df


@pytest.fixture(scope="module")
def hot(spark):
    """100,000 rows without an id, 50,000 of one id, 3,000 copies of one row, 40 others."""
    many = spark.range(150_000).select(F.when(F.col("id") >= 100_000, 1).cast("long").alias("doc_id"),
                                       F.concat(F.lit("text "), F.col("id")).alias("text"))
    copies = spark.range(3000).select(F.lit(2).cast("long").alias("doc_id"), F.lit("one copy").alias("text"))
    return many.unionByName(copies).unionByName(spark.range(3, 43).select(F.col("id").alias("doc_id"), F.concat(F.lit("own "), "id").alias("text")))


def test_quality_sample_is_bounded(spark, hot, monkeypatch):
    seen = {}
    monkeypatch.setattr(quality, "fit", lambda pos, unl, seed: seen.update(pos=len(pos), unl=len(unl)) or "net")
    labels = spark.createDataFrame([(i,) for i in [1, 1, 2, 3, 4, None, 99]], "doc_id long")
    quality.train(hot, labels, positives=3, unlabelled=20)
    assert seen["pos"] <= 3 and seen["unl"] == 20
    quality.train(hot, labels, positives=30, unlabelled=20)
    assert seen["pos"] == 4  # one text of ids 1, 2, 3 and 4


def test_toxicity_sample_is_bounded(spark, hot, monkeypatch):
    seen = {}
    monkeypatch.setattr(toxicity, "fit", lambda bags, weight: seen.update(bags=bags, weight=weight) or {"": 0.0})
    labels = spark.createDataFrame([(1, 1), (2, 1), (2, 1), (3, 0), (4, 0), (5, 0), (None, 0)], "doc_id long, label int")
    toxicity.train(hot, labels)
    assert sorted(k for _, k in seen["bags"]) == [0, 0, 0, 1, 1] and seen["weight"] == {0: 1.0, 1: 1.0}
    toxicity.train(hot, labels, docs_per_label=2, max_chars=22)  # 11 characters of each label
    for k in (0, 1):
        assert 1 <= sum(len(t) for t, y in seen["bags"] if y == k) <= 11


def test_page_sample_is_bounded(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(html_crf, "fit", lambda pages, seed: seen.update(pages=pages) or html_crf.FIXED)
    pages = spark.range(30_000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 3).alias("page_id"),
                                       F.concat(F.lit("<article>"), F.col("id") % 1000).alias("html"))
    html_crf.train(pages, n=12)
    assert len(seen["pages"]) == 12 == len(set(seen["pages"]))
    html_crf.train(pages, n=12, max_chars=30)
    assert 0 < sum(map(len, seen["pages"])) <= 30


def test_columns_of_any_name_are_carried(spark):
    rows = [(1, "some words in a row here"), (1, "some words in a row here"), (2, None), (None, "x"), (4, "entirely other words stand in this one")]
    docs = odd(spark.createDataFrame(rows, DOC))
    net = (quality.Net(np.zeros(20), np.ones(20), 4, 1), 0.5)
    keep = lambda df: sorted(map(tuple, df.select(*[f"`{c.replace('`', '``')}`" for c in docs.columns if c != "score"]).collect()), key=str)
    for out in (quality.score(docs, net), quality.score(docs, None), toxicity.score(docs, {"": -5.0}), toxicity.score(docs, None)):
        assert keep(out) == keep(docs) and out.columns[-1] in ("score", "offending")
    for out in (quality.accepted(docs, None), toxicity.clean(docs, {"": -5.0})):
        assert out.columns == docs.columns and out.count() == 5
    stay = simhash.first_of_each(docs)
    assert stay.columns == docs.columns and sorted(r["doc_id"] or 0 for r in stay.collect()) == [0, 1, 2, 4]
    assert {r["tick`s"] for r in stay.collect()} == {"own tick`s"}
    pages = odd(spark.createDataFrame([(1, "<article><p>Hello there."), (1, "<article><p>Hello there."), (None, None)], "page_id long, html string"))
    out = html_crf.extract(pages, html_crf.FIXED)
    assert sorted(r["text"] for r in out.collect()) == ["", "Hello there.", "Hello there."]
    assert out.columns == ["page_id", *ODD, "text"]


def test_empty_tables(spark):
    none = odd(spark.createDataFrame([], DOC))
    labels = spark.createDataFrame([], "doc_id long, label int")
    assert quality.train(none, labels) is None and toxicity.train(none, labels) is None
    for out in (quality.score(none, None), toxicity.score(none, {"": -5.0}), simhash.first_of_each(none), quality.accepted(none, None)):
        assert out.count() == 0
    pages = spark.createDataFrame([], "page_id long, html string")
    assert html_crf.extract(pages, html_crf.train(pages)).count() == 0


def test_only_the_text_column(spark):
    assert quality.score(spark.createDataFrame([("a",)], "text string"), None).columns == ["text", "score"]


# ---- gradients ----------------------------------------------------------------

def numerical(f, x, h=1e-6):
    out = np.zeros_like(x)
    for i in range(len(x)):
        up, down = x.copy(), x.copy()
        up[i] += h
        down[i] -= h
        out[i] = (f(up) - f(down)) / (2 * h)
    return out


@pytest.mark.parametrize("shift", [0.0, -4.0])
def test_non_negative_risk_gradient(shift):
    rng = np.random.default_rng(0)
    g, n, prior = rng.normal(size=30) * 2, 12, 0.6
    g[n:] += shift  # far down the unlabelled part turns the second term negative
    loss = lambda s: np.mean([math.log(1 + math.exp(-v)) for v in s])  # noqa: E731  the logistic loss, written out
    second = lambda g: loss(-g[n:]) - prior * loss(-g[:n])
    assert (second(g) < 0) == (shift < 0)
    risk = (lambda g: prior * loss(g[:n]) + second(g)) if second(g) >= 0 else (lambda g: -second(g))
    assert np.allclose(quality.risk_slopes(g[:n], g[n:], prior), numerical(risk, g), atol=1e-7)


def test_noisy_or_gradient_and_score(spark):
    rng = np.random.default_rng(1)
    bag_of, y = np.array([0, 0, 0, 1, 1, 2, 3, 3]), np.array([1.0, 0, 1, 0])
    imp, plain, base = np.array([0.2, 0.3, 0.4, 0.1]), np.array([2, 0, 1, 3]), 0.01

    def loss(z):
        total = 0.0
        for k in range(4):
            clean = (1 - base) ** plain[k]
            for i in np.flatnonzero(bag_of == k):
                clean *= 1 - 1 / (1 + math.exp(-z[i]))
            total -= imp[k] * math.log(1 - clean if y[k] else clean)
        return total
    z = rng.normal(size=8)
    g, _ = toxicity.bag_slopes(z, bag_of, y, imp, plain, base)
    assert np.allclose(g, numerical(loss, z), atol=1e-7)
    # the score of a document is the plain product over its sentences, without the bias' own share
    model = {"": -6.0, "=idiot": 7.0, "idi": 0.5, "=fool": 5.0}
    docs = spark.createDataFrame([(1, "Nice day. You idiot! What a fool. A fool fool"), (2, "Nothing here."), (3, "")], DOC)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    p = lambda v: 1 / (1 + math.exp(-v))
    want = 1 - math.prod((1 - p(v)) / (1 - p(-6.0)) for v in (-6 + 7.5, -6 + 5, -6 + 5))
    assert abs(got[1] - want) < 1e-12 and got[2] == 0 == got[3]


# ---- op2, op9 -------------------------------------------------------------------

def test_sketches_of_cut_texts_are_those_of_whole_texts(spark):
    """Text and edited text get the sketches that each would get alone; rows
    of one id are in order of their texts."""
    texts = ["", None, " ", "w", "a b", "a b c d", "a b c d e", " lead and trail \t\n ", "abcdefghijkl", "ΟΔΟΣ ΑΣ " * 9, "one two three four five six seven",
             "x" * 301, "\n\n a\x0bb\x0cc\rd e f g h ", "word " * 3000]
    docs = odd(spark.createDataFrame([(i // 3, t) for i, t in enumerate(texts)] * 2, DOC))
    pairs = fingerprints.edited_pairs(docs).collect()
    assert len(pairs) == 2 * len(texts)
    rows = sorted(((i // 3, t or "") for i, t in enumerate(texts)), key=lambda r: (r[0], r[1].encode()))
    rows = sorted(rows * 2, key=lambda r: (r[0], r[1].encode()))
    edited = [t[:len(t) - len(t) // 4] + rows[(i + 1) % len(rows)][1][:len(t) // 4] for i, (_, t) in enumerate(rows)]
    alone = lambda ts: [tuple(r[0]) for r in spark.createDataFrame([(t, i) for i, t in enumerate(ts)], "t string, i int").select(
        fingerprints.sketch(F.col("t")).alias("s"), "i").orderBy("i").select("s").collect()]
    want = sorted(zip([d for d, _ in rows], alone([t for _, t in rows]), alone(edited)))
    assert sorted((r["doc_id"], tuple(r["sketch"]), tuple(r["edited_sketch"])) for r in pairs) == want


def test_resemblance_and_containment_against_sets(spark):
    rng = np.random.default_rng(3)
    pairs = [([], []), ([1], []), ([], [2]), ([1, 2], [2, 3])]
    for size in (60, 400):
        a = sorted(set(rng.integers(-2**63, 2**63 - 1, size).tolist()))
        b = sorted(set(a[::2]) | set(rng.integers(-2**63, 2**63 - 1, size // 2).tolist()))
        pairs.append((a[:128], b[:128]))
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a array<bigint>, b array<bigint>")
    near = fingerprints.resemblance(F.col("a"), F.col("b"))
    got = df.select("i", near.alias("r"), fingerprints.containment(F.col("a"), F.col("b")).alias("c"),
                    fingerprints.containment(F.col("a"), F.col("b"), near=near).alias("d")).orderBy("i").collect()
    for (a, b), r in zip(pairs, got):
        low = sorted(set(a) | set(b))[:128]
        assert r["r"] == (len(set(a) & set(b) & set(low)) / len(low) if low else 1.0) and r["c"] == r["d"]


def test_deep_pages_are_read_in_linear_time():
    read = html_crf.extractor(html_crf.FIXED)
    t = time.time()
    assert read("<div>x " * 100_000 + "<article><p>" + "These words are the text. " * 9).endswith("These words are the text.")
    read("".join(f"<div class='c{'abcdefgh'[i % 8] * (i % 50)}'>x " for i in range(50_000)))
    read("<span>" * 30_000 + "<div></div>" * 30_000 + "</b>" * 30_000)
    assert time.time() - t < 40


def test_misnested_inline_elements_take_their_words_along():
    read = html_crf.tokens()
    ((_, (place, _)),) = read("<div><b class=ad><p></b>x y")
    assert not place.not_main and place.leaf == "p" and not place.words
    (_, (inside, _)), (_, (after, _)) = read("<div><span class=ad>x<p>y</p></span><p>z")[1:]
    assert inside.not_main and not after.not_main
