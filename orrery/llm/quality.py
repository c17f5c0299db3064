"""Quality classifier by positive-unlabelled learning.

Trusted positives (documents labelled good) and unlabelled web text are all
it learns from.  A small network g minimises the non-negative unbiased risk

    prior * E_pos[loss(g)] + max(0, E_unl[loss(-g)] - prior * E_pos[loss(-g)])

with the logistic loss, so that sigmoid(g) estimates the probability of a
good document.  When the second term turns negative the step goes against
it (the network is fitting the unlabelled positives as negatives).

The class prior is estimated: for scores of a first network that tells
positives from unlabelled text, the share of unlabelled text above a
threshold over the share of positives above it bounds the prior from above;
the smallest such ratio, with a margin for the sample's size, is taken, and
again after a first fit.

Features are statistics of the whole text only: shapes of words and lines,
repetition, symbols, letter case.  Fitting uses at most ``positives`` and
``unlabelled`` documents, drawn in hash order (documented bounds); scoring
covers every document.

Defined results: null text is empty and gets the score of an empty text;
without any trusted positive nothing can be learnt and every document
scores 1; rows are scored one by one, so repeated rows get equal scores;
other columns are carried along by ``score`` except one named score, which
is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from orrery.llm.base import carried, quoted
from orrery.llm.sampling import fold, in_hash_order, keyed, one_row_each, rows_in_hash_order, texts_of

POSITIVES = 6000
UNLABELLED = 12000
THRESHOLD = 0.7


def text_features():
    """A function: text -> list of numbers."""
    import math
    import re
    from collections import Counter
    symbols = re.compile(r"[^\w\s]{2,}")
    letters = re.compile(r"[^\W\d_]+")

    def of(text: str) -> list[float]:
        w = text.split()
        n, chars = len(w), len(text)
        if not n:
            return [1.0] + [0.0] * 19
        counts = Counter(w)
        lines = [x for x in text.split("\n") if x]
        raw = text.encode()
        alpha = sum(map(len, letters.findall(text)))
        upper = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
        digits = len(raw) - len(raw.translate(None, b"0123456789"))
        marks = len(raw) - len(raw.translate(None, b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"))
        plain = len(raw) - len(raw.translate(None, b".,"))
        same = sum(map(str.__eq__, w, w[1:]))
        runs = len(symbols.findall(text))
        bare = sum(not x[0].isalnum() and len(x) < 4 for x in w)
        ends = raw.count(b". ") + raw.count(b".\n") + raw.endswith(b".")
        shout = sum(map(str.isupper, w))
        longest = max(map(len, w))
        few = 1 / math.sqrt(n)
        return [0.0, math.log1p(n) / 5, few, chars / n / 8, math.log1p(longest) / 4, len(counts) / n,
                counts.most_common(1)[0][1] / n, same / n, runs / n, bare / n, ends / n, shout / n,
                alpha / chars, upper / max(1, alpha), digits / chars, marks / chars, (marks - plain) / chars,
                len(lines) / n, len(set(lines)) / len(lines), math.log1p(len(raw) / len(lines)) / 6]
    return of


class Net:
    """One hidden layer on standardised features; plain numpy."""

    def __init__(self, mean, scale, hidden: int, seed: int):
        import numpy as np
        r = np.random.default_rng(seed)
        d = len(mean)
        self.mean, self.scale = mean, scale
        self.p = [r.normal(0, 1 / np.sqrt(d), (d, hidden)), np.zeros(hidden),
                  r.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
        self.m, self.v, self.t = [x * 0 for x in self.p], [x * 0 for x in self.p], 0

    def hidden(self, x):
        import numpy as np
        return np.tanh(np.clip((x - self.mean) / self.scale, -8, 8) @ self.p[0] + self.p[1])

    def logit(self, x):
        return self.hidden(x) @ self.p[2] + self.p[3]

    def step(self, x, slope, rate: float, decay: float = 1e-4):
        """One Adam step for d(risk)/d(logit) = ``slope`` on rows ``x``."""
        import numpy as np
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(z @ self.p[0] + self.p[1])
        back = slope[:, None] * self.p[2] * (1 - h * h)
        grads = [z.T @ back, back.sum(0), h.T @ slope, slope.sum(keepdims=True)]
        self.t += 1
        for i, g in enumerate(grads):
            g = g + decay * self.p[i]
            self.m[i] = 0.9 * self.m[i] + 0.1 * g
            self.v[i] = 0.999 * self.v[i] + 0.001 * g * g
            self.p[i] = self.p[i] - rate * (self.m[i] / (1 - 0.9 ** self.t)) / (
                np.sqrt(self.v[i] / (1 - 0.999 ** self.t)) + 1e-8)


def sigmoid(x):
    import numpy as np
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def estimate_prior(score_pos, score_unl) -> float:
    """Share of positives in the unlabelled text, from scores of both."""
    import numpy as np
    cuts = np.quantile(score_pos, np.linspace(0.0, 0.9, 181))
    p = 1 - np.searchsorted(np.sort(score_pos), cuts, "left") / len(score_pos)
    u = 1 - np.searchsorted(np.sort(score_unl), cuts, "left") / len(score_unl)
    margin = np.sqrt(np.log(20) / 2 / len(score_pos)) + np.sqrt(np.log(20) / 2 / len(score_unl))
    best = int(np.argmin((u + margin) / np.maximum(p, 1e-9)))
    return float(np.clip(u[best] / p[best], 0.01, 0.99))


def risk_slopes(ga, gb, prior: float):
    """Derivatives of the non-negative risk in the logits of positives and of
    unlabelled text; those of minus its second term while that is negative."""
    import numpy as np
    negative = np.logaddexp(0, gb).mean() - prior * np.logaddexp(0, ga).mean()
    up_a, up_b = sigmoid(ga) / len(ga), sigmoid(gb) / len(gb)
    if negative >= 0:
        return np.concatenate([prior * (up_a - 1 / len(ga)) - prior * up_a, up_b])
    return np.concatenate([prior * up_a, -up_b])  # step back out of the negative part only


def fit(pos, unl, hidden: int = 24, steps: int = 500, batch: int = 1024, rate: float = 0.01, seed: int = 3):
    """(net, prior) from feature matrices of positives and unlabelled text."""
    import numpy as np
    rng = np.random.default_rng(seed)
    both = np.concatenate([pos, unl])
    mean, scale = both.mean(0), both.std(0) + 1e-6
    half = lambda x, k: x[np.arange(len(x)) % 2 == k] if len(x) > 1 else x

    def draw(x):
        return x[rng.integers(0, len(x), min(batch, 4 * len(x)))]

    first = Net(mean, scale, hidden, seed)
    for _ in range(steps // 2):  # positives against unlabelled text, on one half of each
        a, b = draw(half(pos, 0)), draw(half(unl, 0))
        x = np.concatenate([a, b])
        s = sigmoid(first.logit(x))
        slope = np.concatenate([(s[:len(a)] - 1) / len(a), s[len(a):] / len(b)])
        first.step(x, slope, rate)
    prior = estimate_prior(first.logit(half(pos, 1)), first.logit(half(unl, 1)))

    def risk(prior):
        net = Net(mean, scale, hidden, seed + 1)
        for i in range(steps):
            a, b = draw(pos), draw(unl)
            x = np.concatenate([a, b])
            g = net.logit(x)
            slope = risk_slopes(g[:len(a)], g[len(a):], prior)
            net.step(x, slope, rate * 0.5 * (1 + np.cos(np.pi * i / steps)) + 1e-4)
        return net

    net = risk(prior)
    prior = min(prior, estimate_prior(net.logit(pos), net.logit(unl)))
    return risk(prior), prior


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED,
          seed: int = 3):
    """(net, prior) from the rows of ``labels`` (doc_id) that name trusted
    positives and from ``docs`` (doc_id, text) as unlabelled text; None
    without positives."""
    import numpy as np
    rows = keyed(docs)
    good = in_hash_order(labels.select("doc_id").filter("doc_id is not null").distinct(), positives, seed, "positive")
    picked = [(r["id"], r["t"], True) for r in one_row_each(rows, good.withColumnRenamed("doc_id", "id"), [])]
    picked += [(r["id"], r["t"], False) for r in rows_in_hash_order(rows, unlabelled, seed, "unlabelled")]
    if not picked:
        return None
    rows = texts_of(rows, picked, "positive boolean").select("id", "t", "positive", "text")
    rows = rows.mapInArrow(_feature_kernel(), "id long, t long, positive boolean, x array<double>").collect()
    rows.sort(key=lambda r: (r["id"] is not None, r["id"], r["t"]))  # reruns see one order
    pos = np.array([r["x"] for r in rows if r["positive"]])
    unl = np.array([r["x"] for r in rows if not r["positive"]])
    if not len(pos) or not len(unl):
        return None
    return fit(pos, unl, seed=seed)


def _feature_kernel():
    def run(batches):
        import pyarrow as pa
        of = text_features()
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array([of(t) for t in b.column("text").to_pylist()], pa.list_(pa.float64()))],
                names=["id", "t", "positive", "x"])
    return run


def _score_kernel(net):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        of = text_features()
        for b in batches:
            x = np.array([of(t or "") for t in b.column("text").to_pylist()]).reshape(b.num_rows, -1)
            found = sigmoid(net.logit(x)) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.float64())], names=["row", "text", "score"])
    return run


def score(docs: DataFrame, model) -> DataFrame:
    """``docs`` with ``score`` from their whole texts."""
    rows, _ = carried(docs, "text", ("score",))
    if model is None:
        rows = rows.withColumn("score", F.lit(1.0))
    else:
        rows = rows.mapInArrow(_score_kernel(model[0]), StructType([*rows.schema.fields, StructField("score", DoubleType())]))
    names = [c for c in docs.columns if c != "score"]
    return rows.select(*[(F.col("text") if c == "text" else F.col("row")[c]).alias(c) for c in names], "score")


def accepted(docs: DataFrame, model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that reach the threshold, unchanged."""
    row = docs.select(F.struct(*[F.col(quoted(c)).alias(c) for c in docs.columns]).alias("row"), "text")
    return score(row, model).filter(F.col("score") >= threshold).select(*[F.col("row")[c].alias(c) for c in docs.columns])


def trusted(labels: DataFrame, parts: int = 4, held_out: int = 2) -> DataFrame:
    """Training rows that mark good documents."""
    return labels.filter((fold(F.col("doc_id"), parts) != held_out) & (F.col("quality") == 1))
