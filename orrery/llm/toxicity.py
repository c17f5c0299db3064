"""Toxicity by multiple-instance learning over sentences.

A document is a bag of sentences of which only the bag is labelled.  A
sentence scores p = sigmoid(bias + sum of its distinct words' weights), and
the bag is toxic if any sentence is: 1 - prod(1 - p), the noisy-or.  The
bag's likelihood is maximised over the labelled documents; its gradient
flows to the sentences that explain the label, so the fitted sentence scores
locate the offending sentences.  The bias takes up labels that no word
explains; it is left out again when documents are scored, so that a text
does not become toxic by its length.

A word's weight is the sum of the weights of its features: the word itself
(lower case, without punctuation at its ends) and its beginnings of three to
nine letters.  Sentences end at ``.``, ``!``, ``?`` before white space and at
line breaks; longer ones are cut every ``WINDOW`` words.

Fitting uses at most ``docs_per_label`` documents of each label in hash
order and at most ``max_chars`` characters of whole texts (documented
bounds), weighted back to the labels' shares; scoring covers every document.

Defined results: null text is empty; a document without words has no
sentence and scores 0; without labels of both kinds every document scores
0; repeated rows get equal scores; other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from orrery.llm.base import carried, cut_lineage, quoted
from orrery.llm.sampling import fold, in_hash_order, keyed, one_row_each, texts_of

DOCS_PER_LABEL = 3000
MAX_CHARS = 24_000_000
THRESHOLD = 0.5
WINDOW = 40


def reader():
    """(sentences of a text as (start, end, words), features of a word)."""
    import re
    end = re.compile(r"(?<=[.!?])\s+|\n+")
    word = re.compile(r"\S+")
    strip = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„‘’…¡¿–—"

    def sentences(text):
        at = 0
        for stop in [*(m.span() for m in end.finditer(text)), (len(text), len(text))]:
            piece = text[at:stop[0]]
            w = piece.split()
            if len(w) <= WINDOW:
                if w:
                    yield at, stop[0], w
            else:
                spans = [m.span() for m in word.finditer(piece)]
                for i in range(0, len(spans), WINDOW):
                    part = spans[i:i + WINDOW]
                    yield at + part[0][0], at + part[-1][1], [piece[a:b] for a, b in part]
            at = stop[1]

    def features(w):
        w = w.lower().strip(strip)
        return ["=" + w, *(w[:n] for n in range(3, 10) if len(w) >= n)] if w else []

    return sentences, features


def bag_slopes(z, bag_of, y, imp, plain, base: float):
    """Derivatives of the bags' weighted -log likelihood in the sentences'
    logits ``z``, and their common factor for each bag.  ``plain``: a bag's
    further sentences, each offending with probability ``base``."""
    import numpy as np
    p = 1 / (1 + np.exp(-z))
    clean = np.bincount(bag_of, np.log1p(-p * (1 - 1e-9)), len(y)) + plain * np.log1p(-base)  # log of prod(1 - p)
    toxic = np.maximum(-np.expm1(clean), 1e-9)
    # p for a clean bag, -p * prod / (1 - prod) for a toxic one
    slope = np.where(y == 1, -np.exp(clean) / toxic, 1.0) * imp
    return slope[bag_of] * p, slope


def fit(bags: list[tuple[str, int]], weight: dict[int, float], enriched: float = 2.0, evidence: float = 1.5,
        steps: int = 800, rate: float = 1.0, relaxed: float = 0.1,
        lowest: float = -11.0) -> dict:
    """{feature: weight} with the bias under ``""``, from (text, label).

    Weights are not negative: clean words take nothing from an offending
    one.  Only features that are ``enriched`` times as common in toxic as in
    clean documents are learnt, and each pays an L1 price of ``evidence``
    standard deviations of what it would gain by chance from the toxic
    documents that have it, so that mislabelled documents teach no words.
    Halfway the chosen features go on at ``relaxed`` times that price.  The
    bias stays above ``lowest``, so that one offending word is enough."""
    import numpy as np
    sentences, features = reader()
    words, own, known = {}, [], {}
    word_of, sentence_of, bag_of = [], [], []
    doc_features = []  # per document: the numbers of its features
    n = 0
    for d, (text, _) in enumerate(bags):
        inside = set()
        for _, _, w in sentences(text):
            for x in set(w):
                i = words.setdefault(x, len(words))
                if i == len(own):
                    own.append([known.setdefault(f, len(known)) for f in features(x)])
                word_of.append(i)
                sentence_of.append(n)
                inside.update(own[i])
            bag_of.append(d)
            n += 1
        doc_features.append(np.fromiter(inside, np.int64, len(inside)))
    y = np.array([label for _, label in bags], float)
    imp = np.array([weight[label] for _, label in bags])
    imp /= imp.sum()
    size = len(known)
    toxic_docs, clean_docs = (np.zeros(size) for _ in range(2))
    for d, fs in enumerate(doc_features):
        (toxic_docs if y[d] else clean_docs)[fs] += 1
    del doc_features
    use = (toxic_docs > evidence ** 2) & (toxic_docs / max(1, y.sum()) > enriched * clean_docs / max(1, (1 - y).sum()))
    number = np.cumsum(use) - 1
    names = [f for f, i in known.items() if use[i]]
    pairs = np.array([(i, number[f]) for i, fs in enumerate(own) for f in fs if use[f]], np.int64).reshape(-1, 2)
    word_of, sentence_of, bag_of = (np.array(x, np.int64) for x in (word_of, sentence_of, bag_of))
    has = np.zeros(len(words), bool)
    has[pairs[:, 0]] = True
    at = has[word_of]  # other words weigh nothing
    word_of, sentence_of = word_of[at], sentence_of[at]
    per_bag = np.bincount(bag_of, minlength=len(y))
    told, sentence_of = np.unique(sentence_of, return_inverse=True)
    n, bag_of = len(told), bag_of[told] if len(told) else bag_of[:0]
    plain = per_bag - np.bincount(bag_of, minlength=len(y))  # sentences that score by the bias alone
    one = imp[y == 1].mean() * (1 / np.maximum(per_bag[y == 1], 1)).mean()  # a toxic document's share for a sentence
    price = evidence * np.sqrt(toxic_docs[use]) * one
    stiff = toxic_docs[use] * imp[y == 1].mean() + clean_docs[use] * imp[y == 0].mean()
    w, speed, bias = np.zeros(len(names)), np.zeros(len(names)), -5.0
    for t in range(steps):
        if t == steps // 2:  # words are chosen: their weights are no longer held down
            speed[w == 0], price = 0, np.where(w > 0, price * relaxed, 1e9)
        value = np.bincount(pairs[:, 0], w[pairs[:, 1]], len(words))
        z = np.clip(bias + np.bincount(sentence_of, value[word_of], n), -30, 30)
        base = 1 / (1 + np.exp(-bias))
        g, slope = bag_slopes(z, bag_of, y, imp, plain, base)
        gw = np.bincount(pairs[:, 1], np.bincount(word_of, g[sentence_of], len(words))[pairs[:, 0]], len(w))
        speed = 0.9 * speed - rate * (gw + price) / stiff
        w = w + speed
        speed[w < 0] = 0
        w = np.maximum(w, 0)
        bias = max(bias - np.clip(4 * (g.sum() + (slope * plain).sum() * base), -0.1, 0.1), lowest)
    model = {f: float(x) for f, x in zip(names, w) if x > 1e-3}
    model[""] = float(bias)
    return model


def train(docs: DataFrame, labels: DataFrame, docs_per_label: int = DOCS_PER_LABEL, max_chars: int = MAX_CHARS,
          seed: int = 5) -> dict | None:
    """Model from ``labels`` (doc_id, label 0/1) and ``docs`` (doc_id, text);
    labels of documents that are not in ``docs`` count for nothing."""
    here = docs.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id is not null").distinct()
    marks = cut_lineage(labels.filter("doc_id is not null and label in (0, 1)")
                        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int")).distinct()
                        .join(here, "doc_id", "left_semi"))
    total = {r["label"]: r["n"] for r in marks.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(total) < 2:
        return None
    rows = keyed(docs)
    picked = [(r["doc_id"], r["label"]) for k in (0, 1)
              for r in in_hash_order(marks.filter(F.col("label") == k), docs_per_label, seed, str(k)).collect()]
    # one text of each document, and lengths first: whole texts are taken in hash order while they fit
    ids = docs.sparkSession.createDataFrame(picked, "id long, label int")
    size = {(r["id"], r["label"]): (r["t"], r["n"]) for r in one_row_each(rows, ids, ["label"])}
    kept, used = [], {0: 0, 1: 0}
    for p in picked:
        if p in size and used[p[1]] + size[p][1] <= max_chars / 2:
            used[p[1]] += size[p][1]
            kept.append((p[0], size[p][0], p[1]))
    if len({k for *_, k in kept}) < 2:
        return None
    bags = [(r["text"], r["label"]) for r in texts_of(rows, sorted(kept), "label int").orderBy("id", "label").toLocalIterator()]
    got = {k: sum(label == k for _, label in bags) for k in (0, 1)}
    return fit(bags, {k: total[k] / max(1, got[k]) for k in (0, 1)})


LOCATED = "array<struct<start:int,length:int,score:double>>"


def _score_kernel(model, at_least: float):
    def run(batches):
        import math

        import pyarrow as pa
        sentences, features = reader()
        bias = model[""]
        leak, held = math.log1p(math.exp(bias)), {}

        def value(w):
            if len(held) > 400_000:
                held.clear()
            v = held[w] = sum(model.get(f, 0.0) for f in features(w))
            return v

        for b in batches:
            scores, found = [], []
            for text in b.column("text").to_pylist():
                clean, spots = 0.0, []  # log of the product
                for start, stop, w in sentences(text or ""):
                    z = bias + sum([held[x] if x in held else value(x) for x in set(w)])
                    if z > bias:  # the bias alone is left out: length is no offence
                        z = min(z, 30.0)
                        clean -= math.log1p(math.exp(z)) - leak
                        if z >= at_least:
                            spots.append({"start": start, "length": stop - start, "score": 1 / (1 + math.exp(-z))})
                scores.append(0.0 - math.expm1(clean))
                found.append(spots)
            kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64()), pa.array(found, kind)],
                                             names=["row", "text", "score", "offending"])
    return run


def score(docs: DataFrame, model: dict | None, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` and ``offending``: spans (code points) and
    scores of the sentences that reach ``threshold`` on their own."""
    import math
    rows, _ = carried(docs, "text", ("score", "offending"))
    if model is None:
        rows = rows.withColumn("score", F.lit(0.0)).withColumn("offending", F.array().cast(LOCATED))
    else:
        spot = StructType([StructField("start", IntegerType()), StructField("length", IntegerType()),
                           StructField("score", DoubleType())])
        schema = StructType([*rows.schema.fields, StructField("score", DoubleType()), StructField("offending", ArrayType(spot))])
        rows = rows.mapInArrow(_score_kernel(model, math.log(threshold / (1 - threshold))), schema)
    names = [c for c in docs.columns if c not in ("score", "offending")]
    return rows.select(*[(F.col("text") if c == "text" else F.col("row")[c]).alias(c) for c in names], "score", "offending")


def clean(docs: DataFrame, model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stay below the threshold, unchanged."""
    row = docs.select(F.struct(*[F.col(quoted(c)).alias(c) for c in docs.columns]).alias("row"), "text")
    return (score(row, model, threshold).filter(F.col("score") < threshold)
            .select(*[F.col("row")[c].alias(c) for c in docs.columns]))


def marked(labels: DataFrame, parts: int = 5, held_out: int = 0) -> DataFrame:
    """Training rows: (doc_id, label)."""
    return labels.filter(fold(F.col("doc_id"), parts) != held_out).select("doc_id", F.col("toxic").alias("label"))
