"""Trees grown by Spark aggregates: exact classification trees (ML-6) and
multinomial boosting (ML-8).

Both grow level by level.  What reaches the driver is one row for each node
of a level (bounded by the depth), the rows stay where they are.

* ``exact_tree`` looks at every distinct value of every feature as
  a threshold.  Class counts are summed per (node, feature, value); running
  sums over the sorted values come in two steps, over quantile ranges of a
  feature and within a range, so that a feature with as many values as rows
  is not sorted in one task.
* ``boost`` fits K regression trees a round to the residuals of the softmax.
  Features are cut into at most ``bins`` bins by quantiles.  A task adds its
  rows up to sums per (class, node, feature, bin); the best split of every
  (class, node) is the maximum over their running sums, taken by an aggregate.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.functions import vectors as V
from orrery.session import cut_lineage


# ------------------------------------------------------------ ML-6 exact --

@dataclass
class Tree:
    """``splits``: node -> (feature, threshold); ``counts``: node -> class
    counts.  The root is 1, the children of n are 2n (value <= threshold) and
    2n + 1."""
    classes: list
    splits: dict[int, tuple[int, float]] = field(default_factory=dict)
    counts: dict[int, list[int]] = field(default_factory=dict)

    def label(self, node: int):
        """The commonest class, the first on ties."""
        c = self.counts[node]
        return self.classes[c.index(max(c))]

    def _descend(self, vec: Column, leaf, node: int) -> Column:
        if node not in self.splits:
            return leaf(node)
        f, t = self.splits[node]
        return F.when(F.element_at(vec, f + 1) <= F.lit(t), self._descend(vec, leaf, 2 * node)).otherwise(
            self._descend(vec, leaf, 2 * node + 1))

    def predict(self, vec: str) -> Column:
        """The label of a vector, as an expression of nested comparisons."""
        return self._descend(V.as_double(vec), lambda n: F.lit(self.label(n)), 1)

    def node(self, vec: str) -> Column:
        return self._descend(V.as_double(vec), lambda n: F.lit(n).cast("long"), 1)


def _value_ranges(rows: DataFrame, vec: str, dims: int, ranges: int) -> list[list[float]]:
    """Per feature the inner bounds of its quantile ranges (at most
    ``ranges`` - 1 numbers each)."""
    at = [i / ranges for i in range(1, ranges)]
    got = (rows.select(F.posexplode(vec).alias("f", "x")).groupBy("f")
           .agg(F.percentile_approx("x", at, 20 * ranges).alias("q")).collect()) if at else []
    cuts = [[] for _ in range(dims)]
    for r in got:
        cuts[r["f"]] = sorted(set(r["q"] or []))
    return cuts


def exact_tree(df: DataFrame, vec: str, label: str, max_depth: int, min_split: int = 2, min_leaf: int = 1,
               ranges: int = 64) -> Tree:
    """ML-6: classification tree by Gini impurity with exact thresholds
    (midpoints of neighbouring values), ties to the first feature and the
    smallest threshold.  Rows without a vector or label take no part."""
    rows = cut_lineage(df.select(V.as_double(vec).alias("v"), F.col(label).alias("y")).filter("v is not null and y is not null"))
    classes = sorted(r["y"] for r in rows.select("y").distinct().collect())  # a parameter's worth: the label's values
    tree = Tree(classes)
    if not classes:
        return tree
    dims = rows.agg(F.max(F.size("v"))).first()[0]
    cuts = F.array(*[F.array(*[F.lit(float(x)) for x in c]).cast("array<double>") for c in _value_ranges(rows, "v", dims, ranges)])
    names = [f"c{k}" for k in range(len(classes))]
    per_class = [F.count_if(F.col("y") == F.lit(c)).alias(n) for n, c in zip(names, classes)]
    first = rows.agg(*per_class).first()
    tree.counts[1] = [first[n] for n in names]
    open_, depth = [1], 0
    while open_ and depth < max_depth:
        open_ = [n for n in open_ if sum(tree.counts[n]) >= max(min_split, 2 * min_leaf) and max(tree.counts[n]) < sum(tree.counts[n])]
        if not open_:
            break
        at = rows.withColumn("node", tree.node("v")).filter(F.col("node").isin(open_))
        x = at.select("node", "y", F.posexplode("v").alias("f", "x")).filter("x is not null")
        r = F.size(F.filter(F.element_at(cuts, F.col("f") + 1), lambda c: c < F.col("x")))
        per_value = x.groupBy("node", "f", r.alias("r"), "x").agg(*per_class)
        # running counts: whole ranges before this one, then the values within it
        spans = cut_lineage(per_value)
        whole = spans.groupBy("node", "f", "r").agg(*[F.sum(n).alias("s_" + n) for n in names], F.min("x").alias("low"))
        order = Window.partitionBy("node", "f").orderBy("r")
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        whole = whole.select("node", "f", "r", F.lead("low").over(order).alias("next_low"),
                             *[F.coalesce(F.sum("s_" + n).over(before), F.lit(0)).alias("b_" + n) for n in names])
        here = Window.partitionBy("node", "f", "r").orderBy("x")
        upto = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        run = spans.join(whole, ["node", "f", "r"]).select(
            "node", "f", "x", F.coalesce(F.lead("x").over(here), "next_low").alias("next"),
            *[(F.col("b_" + n) + F.sum(n).over(upto)).alias("l_" + n) for n in names]).filter("next is not null")
        # the node's own counts: one literal for each open node
        total = F.create_map(*[e for n in open_ for e in (F.lit(n).cast("long"), F.array(*[F.lit(c).cast("long") for c in tree.counts[n]]))])
        run = run.withColumn("t", total[F.col("node")])
        left, right = [F.col("l_" + n) for n in names], [F.col("t")[k] - F.col("l_" + n) for k, n in enumerate(names)]
        n_left, n_right = sum(left[1:], left[0]), sum(right[1:], right[0])
        squares = lambda cs: sum([(c * c) for c in cs[1:]], cs[0] * cs[0]).cast("double")
        gain = squares(left) / n_left + squares(right) / n_right  # Gini impurity falls as this rises
        middle = F.col("x") / 2 + F.col("next") / 2
        best = (run.filter((n_left >= min_leaf) & (n_right >= min_leaf))
                .select("node", F.struct(gain.alias("g"), (-F.col("f")).alias("f"), (-F.when(middle < F.col("next"), middle).otherwise(F.col("x"))).alias("t"),
                                         F.array(*left).alias("l")).alias("b"))
                .groupBy("node").agg(F.max("b").alias("b")).select("node", "b.*").collect())
        open_ = []
        for b in best:
            n, all_ = b["node"], tree.counts[b["node"]]
            tree.splits[n] = (-b["f"], -b["t"])
            tree.counts[2 * n] = list(b["l"])
            tree.counts[2 * n + 1] = [a - c for a, c in zip(all_, b["l"])]
            open_ += [2 * n, 2 * n + 1]
        depth += 1
    return tree


# -------------------------------------------------------- ML-8 boosting --

@dataclass
class Booster:
    """``start``: the classes' log priors; ``rounds``: a tree for each class
    and round, as node -> (feature, threshold) or the leaf's value."""
    classes: list
    start: list[float]
    rate: float
    cuts: list[list[float]]
    rounds: list[list[dict]] = field(default_factory=list)
    deviance: list[float] = field(default_factory=list)

    def score(self, x: np.ndarray, since: int = 0, base: np.ndarray | None = None) -> np.ndarray:
        """Scores (rows x classes) of the rounds from ``since`` on, on top of ``base``."""
        out = np.tile(np.array(self.start), (len(x), 1)) if base is None else base.copy()
        for trees in self.rounds[since:]:
            for k, tree in enumerate(trees):
                node = _leaf_of(tree, x)
                values = np.zeros(max(tree) + 1)
                for n, v in tree.items():
                    if not isinstance(v, tuple):
                        values[n] = v
                out[:, k] += self.rate * values[node]
        return out

    def predict(self, df: DataFrame, vec: str, out: str = "prediction") -> DataFrame:
        """``df`` with the class of the highest score (the first on ties)."""
        fitted, classes = self, self.classes

        @F.pandas_udf("int")
        def best(v):
            import pandas as pd
            x = np.vstack(v.to_numpy()) if len(v) else np.zeros((0, 1))
            return pd.Series(fitted.score(x).argmax(1) if len(v) else [], dtype="int32")
        labels = F.array(*[F.lit(c) for c in classes])
        return df.withColumn(out, F.element_at(labels, best(V.as_double(vec)) + 1))


def _leaf_of(tree: dict, x: np.ndarray) -> np.ndarray:
    node = np.ones(len(x), np.int64)
    for n in sorted(n for n, v in tree.items() if isinstance(v, tuple)):  # parents come first
        f, t = tree[n]
        at = node == n
        node[at] = 2 * n + (x[at, f] > t)
    return node


def _softmax(score: np.ndarray) -> np.ndarray:
    e = np.exp(score - score.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


_SUMS = "k int, node long, f int, bin int, n double, r double, h double"


def _histograms(model: Booster, growing: list[dict], since: int, bins: int):
    """Rows (v, y, score) -> sums per (class, node, feature, bin) of the
    nodes that are to be split; (class, -1, ...) holds the deviance."""
    def run(batches):
        import pyarrow as pa
        classes, open_ = len(model.classes), [sorted(n for n, v in t.items() if v is None) for t in growing]
        dims, total, deviance = len(model.cuts), {}, 0.0
        edges = [np.array(c) for c in model.cuts]
        for b in batches:
            if not b.num_rows:
                continue
            x = np.asarray(b.column("v").flatten(), float).reshape(b.num_rows, -1)
            y, base = np.asarray(b.column("y")), np.asarray(b.column("score").flatten(), float).reshape(b.num_rows, -1)
            p = _softmax(model.score(x, since, base))
            deviance -= np.log(np.maximum(p[np.arange(len(y)), y], 1e-300)).sum()
            place = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
            for k in range(classes):
                r = (y == k) - p[:, k]
                h, node = np.abs(r) * (1 - np.abs(r)), _leaf_of({n: v for n, v in growing[k].items() if isinstance(v, tuple)}, x)
                for n in open_[k]:
                    at = node == n
                    if not at.any():
                        continue
                    cell = (place[at] + np.arange(dims) * bins).ravel()
                    s = total.setdefault((k, n), np.zeros((3, dims * bins)))
                    for i, w in enumerate((np.ones(at.sum()), r[at], h[at])):
                        s[i] += np.bincount(cell, np.repeat(w, dims), dims * bins)
        rows = [(0, -1, 0, 0, 0.0, deviance, 0.0)]
        for (k, n), s in total.items():
            for c in np.flatnonzero(s[0]):
                rows.append((k, n, c // bins, c % bins, *s[:, c]))
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                         names=["k", "node", "f", "bin", "n", "r", "h"])
    return run


def _rescore(model: Booster, since: int):
    def run(batches):
        import pyarrow as pa
        for b in batches:
            x, s = (np.asarray(b.column(c).flatten(), float).reshape(b.num_rows, -1) for c in ("v", "score"))
            yield pa.RecordBatch.from_arrays([b.column("v"), b.column("y"), pa.array(list(model.score(x, since, s)), pa.list_(pa.float64()))],
                                             names=["v", "y", "score"])
    return run


def boost(df: DataFrame, vec: str, label: str, rounds: int = 10, max_depth: int = 3, rate: float = 0.1, bins: int = 32,
          min_leaf: int = 1, keep_every: int = 10) -> Booster:
    """ML-8: multinomial gradient boosting.  Every round fits, for each of
    the K classes, a regression tree to y_k - softmax_k; a leaf's value is
    (K - 1) / K * sum(r) / sum(|r| (1 - |r|)).  Splits maximise the fall of
    the squared error, ties to the first feature and bin.  Scores are written
    every ``keep_every`` rounds; between, tasks add the newest trees.

    ``deviance`` holds the mean -log likelihood before every round."""
    rows = df.select(V.as_double(vec).alias("v"), F.col(label).alias("l")).filter("v is not null and l is not null")
    per = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count(F.lit(1)).alias("n")).collect()}
    classes = sorted(per)
    n_rows, k_all = sum(per.values()), len(classes)
    if k_all < 2:
        return Booster(classes, [0.0] * k_all, rate, [])
    start = [math.log(per[c] / n_rows) for c in classes]
    dims = rows.agg(F.max(F.size("v"))).first()[0]
    model = Booster(classes, start, rate, _value_ranges(rows, "v", dims, bins))
    number = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("l")) - 1
    state = cut_lineage(rows.select("v", number.cast("int").alias("y"), F.array(*[F.lit(s) for s in start]).alias("score")))
    since = 0
    for t in range(rounds):
        growing = [{1: None} for _ in classes]
        for depth in range(max_depth + 1):
            if depth == max_depth or not any(v is None for tree in growing for v in tree.values()):
                break
            sums = (state.mapInArrow(_histograms(model, growing, since, bins), _SUMS)
                    .groupBy("k", "node", "f", "bin").agg(*[F.sum(c).alias(c) for c in ("n", "r", "h")]))
            whole = Window.partitionBy("k", "node", "f")
            upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
            run = sums.select("k", "node", "f", "bin", *[F.sum(c).over(upto).alias("l" + c) for c in "nrh"],
                              *[F.sum(c).over(whole).alias("t" + c) for c in "nrh"])
            rn = F.col("tn") - F.col("ln")
            gain = F.when((F.col("ln") >= min_leaf) & (rn >= min_leaf) & (rn > 0),
                          F.col("lr") * F.col("lr") / F.col("ln") + (F.col("tr") - F.col("lr")) * (F.col("tr") - F.col("lr")) / rn
                          - F.col("tr") * F.col("tr") / F.col("tn"))
            # without a split the node's totals still make its leaf
            best = run.groupBy("k", "node").agg(F.max(F.struct(F.round(gain, 12).alias("g"), (-F.col("f")).alias("f"), (-F.col("bin")).alias("bin"),
                                                               "ln", "lr", "lh", "tn", "tr", "th")).alias("b")).select("k", "node", "b.*").collect()
            for b in best:
                if b["node"] == -1:
                    if depth == 0:
                        model.deviance.append(b["tr"] / n_rows)
                    continue
                tree, n, f = growing[b["k"]], b["node"], -b["f"]
                leaf = lambda r, h: (k_all - 1) / k_all * r / h if h > 1e-150 else 0.0
                if b["g"] is None or b["g"] <= 0 or -b["bin"] >= len(model.cuts[f]):
                    tree[n] = leaf(b["tr"], b["th"])
                    continue
                tree[n] = (f, model.cuts[f][-b["bin"]])
                for child, r, h in ((2 * n, b["lr"], b["lh"]), (2 * n + 1, b["tr"] - b["lr"], b["th"] - b["lh"])):
                    tree[child] = leaf(r, h) if depth + 1 == max_depth else None
        model.rounds.append(growing)
        if (t + 1) % keep_every == 0 and t + 1 < rounds:
            state = cut_lineage(state.mapInArrow(_rescore(model, since), "v array<double>, y int, score array<double>"))
            since = t + 1
    return model
