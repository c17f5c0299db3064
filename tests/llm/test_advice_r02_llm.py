"""Whole jobs that the review of round 2 found cut short: training-data operators."""

import numpy as np
from pyspark.sql import functions as F

from orrery.llm import html_crf, quality, toxicity


def test_toxicity_samples_only_labels_of_its_documents(spark, monkeypatch):
    docs = spark.range(0, 400, 4).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    labels = spark.range(400).select(F.col("id").alias("doc_id"), (F.col("id") % 8 == 0).cast("int").alias("label"))
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda bags, weight: seen.append((bags, weight)) or {"": 0.0})
    toxicity.train(docs, labels, docs_per_label=20)
    bags, weight = seen[0]
    assert [sum(y == k for _, y in bags) for k in (0, 1)] == [20, 20]
    assert weight == {0: 50 / 20, 1: 50 / 20}


def test_html_reader_keeps_text_of_valid_and_sloppy_pages():
    read = html_crf.tokens()
    text = lambda html: [t for t, _ in read(html)]
    assert text("<head><title>T</title><meta name=x><script>var a</script><main><p>One.</p><p>Two.</p></main>") == ["One.", "Two."]
    assert text("<html><head>\n<title>T</title>\n<noscript><img src=x></noscript><style>p{}</style>\n<p>One.") == ["One."]
    assert text("<head><title>T</title>Bare text<p>Two.") == ["Bare text", "Two."]
    assert text("<head><title>T</title></head><body><p>One.</p></body>") == ["One."]
    assert text("<p title=Bob's>One.</p><p>It's two.</p>") == ["One.", "It's two."]
    assert text("<p class=a\">One.</p><p id=x\">Two.</p>") == ["One.", "Two."]
    assert text("<p title=\"a>b\" class = 'c>d' data-x=q='>One.</p>") == ["One."]
    assert text("<p>So <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> holds.</p>") == ["So x=1 holds."]
    assert text("<p>So <math><mi>x</mi><annotation>x</math>, it holds.</p>") == ["So x, it holds."]


def test_quality_prior_is_estimated_in_one_way_at_every_size(monkeypatch):
    rng, real = np.random.default_rng(4), quality.estimate_prior
    for n in (8, 49, 50):
        sizes = []
        monkeypatch.setattr(quality, "estimate_prior", lambda p, u: sizes.append(len(p)) or real(p, u))
        quality.fit(rng.normal(1, 1, (n, 3)), rng.normal(0, 1, (200, 3)), steps=20)
        assert sizes == [n // 2, n]  # the held-out half, then the final fit
