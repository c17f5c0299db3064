"""Tables inside tables, automatic smoothing, term counts, model digests."""

import html.parser
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.functions import html as H
from orrery.operators import features as FE
from orrery.operators import models as ML
from orrery.operators import textops as TO


class Cells(html.parser.HTMLParser):
    """Cells of all tables by a parser with a stack."""

    def __init__(self):
        super().__init__()
        self.tables, self.stack, self.cells = 0, [], []

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.stack.append({"no": self.tables, "parent": self.stack[-1]["no"] if self.stack else None, "row": -1, "cell": -1, "at": None,
                               "depth": len(self.stack) + 1})
            self.tables += 1
        elif self.stack:
            t = self.stack[-1]
            if tag == "tr":
                t["row"], t["cell"], t["at"] = t["row"] + 1, -1, None
            elif tag in ("td", "th"):
                t["cell"] += 1
                t["at"] = [t["no"], t["parent"], t["depth"], t["row"], t["cell"], tag == "th", ""]
                self.cells.append(t["at"])

    def handle_endtag(self, tag):
        if self.stack:
            if tag == "table":
                self.stack.pop()
            elif tag in ("td", "th", "tr"):
                self.stack[-1]["at"] = None

    def handle_data(self, data):
        if self.stack and self.stack[-1]["at"]:
            self.stack[-1]["at"][-1] += data


def parsed(page):
    p = Cells()
    p.feed(page)
    p.close()
    return sorted((*c[:-1], c[-1].strip()) for c in p.cells)


def cells_of(spark, pages):
    df = spark.createDataFrame(list(enumerate(pages)), "id long, html string")
    got = {}
    for r in H.table_cells(df, "id", "html").collect():
        got.setdefault(r["page_id"], []).append(tuple(r[c] for c in ("table_no", "parent_no", "depth", "row_no", "cell_no", "is_header", "text")))
    return [sorted(got.get(i, []), key=lambda c: (c[0], c[3], c[4])) for i in range(len(pages))]


def test_tables_inside_tables(spark):
    page = ('<table id="a"><tr><th>h</th><td>x <b>bold</b><table class="in"><tr><td>1</td><td>2<table><tr><td>deep</td></tr></table> after</td></tr></table>'
            ' tail</td></tr><tr><td>second</table><p>out</p><TABLE><TR><TD>last &amp; least</TABLE>')
    (got,) = cells_of(spark, [page])
    assert got == [(0, None, 1, 0, 0, True, "h"), (0, None, 1, 0, 1, False, "x bold tail"), (0, None, 1, 1, 0, False, "second"),
                   (1, 0, 2, 0, 0, False, "1"), (1, 0, 2, 0, 1, False, "2 after"), (2, 1, 3, 0, 0, False, "deep"),
                   (3, None, 1, 0, 0, False, "last & least")]
    df = spark.createDataFrame([(1, page), (2, None), (3, ""), (4, "</table></td>no table")], "id long, html string")
    chosen = H.table_cells(df, "id", "html").filter("attributes = 'class=\"in\"'").select("page_id", "text").collect()
    assert sorted(tuple(r) for r in chosen) == [(1, "1"), (1, "2 after")]


def test_random_tables_against_a_parser(spark):
    rng = random.Random(3)

    def table(depth):
        rows = []
        for _ in range(rng.randrange(3)):
            cells = ""
            for _ in range(rng.randrange(4)):
                tag = rng.choice(["td", "td", "th"])
                inner = rng.choice(["", " a ", "b<i>c</i>"]) + (table(depth + 1) if depth < 4 and rng.random() < 0.4 else "") + rng.choice(["", "z"])
                cells += f"<{tag} class='k'>{inner}" + rng.choice([f"</{tag}>", ""])
            rows.append(f"<tr>{cells}" + rng.choice(["</tr>", ""]))
        return f"<table n={rng.randrange(9)}>{''.join(rows)}</table>"
    pages = ["text " + table(1) + rng.choice(["", "</table>", "x"]) + table(1) for _ in range(120)]
    got = cells_of(spark, pages)
    order = lambda cs: sorted(cs, key=lambda c: (c[0], c[3], c[4]))
    assert got == [order(parsed(p)) for p in pages]


def test_automatic_smoothing(spark):
    rng = np.random.default_rng(0)
    rows = [(str(rng.choice(["a", "b", "c"])), float(rng.normal(1e6, 2)), int(rng.integers(3))) for _ in range(90)]
    rows += [("one", 1e6 + 5, 0), (None, 1e6, 1), (None, 1e6 + 2, 2), ("flat", 7.0, 1), ("flat", 7.0, 2)]
    df = spark.createDataFrame(rows, "c string, y double, f int")

    def brute(train, level):
        y = np.array([r[1] for r in train])
        own = np.array([r[1] for r in train if r[0] == level])
        if not len(own):
            return y.mean()
        weight = len(own) * y.var() / (len(own) * y.var() + own.var())
        return weight * own.mean() + (1 - weight) * y.mean()
    new = spark.createDataFrame([("a",), ("one",), ("flat",), (None,), ("new",)], "c string")
    for r in FE.target_encoding_auto(df, new, "c", "y", "e").collect():
        assert r["e"] == pytest.approx(brute(rows, r["c"]), rel=1e-9)
    for r in FE.target_encoding_auto_out_of_fold(df, "c", "y", "f", "e").collect():
        assert r["e"] == pytest.approx(brute([t for t in rows if t[2] != r["f"]], r["c"]), rel=1e-9)
    same = spark.createDataFrame([("a", 3.0), ("b", 3.0)], "c string, y double")  # nothing varies
    assert [r["e"] for r in FE.target_encoding_auto(same, same, "c", "y", "e").collect()] == [3.0, 3.0]
    assert FE.target_encoding_auto(same.limit(0), new, "c", "y", "e").filter("e is null").count() == 5


def test_terms_are_counted_once(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["b"]), (3, []), (4, None), (2, ["c"])], "d long, t array<string>")
    terms = TO.document_terms(docs, "d", "t")
    assert sorted(tuple(r) for r in terms.collect()) == [(1, "a", 2), (1, "b", 1), (2, "b", 1), (2, "c", 1)]
    vocab = TO.vocabulary_of(terms, 2)
    assert [tuple(r) for r in vocab.orderBy("idx").collect()] == [("a", 2, 0), ("b", 2, 1)] == [tuple(r) for r in TO.vocabulary(docs, "t", 2).orderBy("idx").collect()]
    assert sorted(tuple(r) for r in TO.bag_of_words(terms, "d", vocab).collect()) == [(1, 0, 2), (1, 1, 1), (2, 1, 1)]


def test_saved_model_belongs_to_its_rows_and_settings(spark, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    def pipeline(reg=0.0):
        return Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="f"), LinearRegression(featuresCol="f", labelCol="y", regParam=reg)])
    df = spark.createDataFrame([(float(i), 2.0 * i) for i in range(20)], "x double, y double")
    path = str(tmp_path / "m")
    assert ML.fit_or_load(pipeline(), df, path)[1] is False
    assert ML.fit_or_load(pipeline(), df.repartition(7), path)[1] is True  # the same rows in any order
    assert ML.fit_or_load(pipeline(0.5), df, path)[1] is False  # other settings
    other, loaded = ML.fit_or_load(pipeline(), df.withColumn("y", F.col("x") * 3), path)  # other rows
    assert loaded is False and other.stages[1].coefficients[0] == pytest.approx(3.0)
