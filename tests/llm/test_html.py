"""op9: reader, field and extraction."""

import itertools
import random
import re
from html import unescape

import pytest

from conftest import SF_MID, SF_SMALL
from orrery.llm import html_crf, q_html


def article(html):
    a = html.split("<article>", 1)[1].split("</article>")[0] if "<article>" in html else ""
    return " ".join(unescape(re.sub("<[^>]*>", " ", a)).split())


def test_every_page_gives_its_article(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    got = q_html.op9_html_text(spark, SF_SMALL).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r["text"] == article(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"])
        assert r["url"] == pages[r["page_id"]]["url"]


@pytest.fixture(scope="module")
def model():
    import duckdb
    return html_crf.fit([h for h, in duckdb.sql(f"select html from '{SF_MID}/pages.parquet' order by page_id").fetchall()])


PAGE = """<!doctype html><html><head><title>T</title><script>if(a<b){x("</p>")}</script><style>.a{}</style></head><body>
<header class="site-header"><a href="/">Site name</a><nav><ul><li><a href=1>Home</a><li><a href=2>News &amp; views</a></ul></nav></header>
<div class="cookie-banner"><p>We use cookies to improve your experience. <button>Accept</button></p></div>
<div id="wrap"><div class="sidebar"><h3>Popular</h3><ul><li><a href=3>One thing you should read</a></li></ul></div>
%s<h1>The title of the story</h1><p>First paragraph of the story, which has a good <b>num</b>ber of words in it &mdash; indeed.</p>
<p>Second  paragraph,\n less long.<br>After a break.</p><div class="advert"><p>Buy now our great product today.</p></div>
<blockquote>Quoted words by somebody of note, at length.</blockquote><p>A last line.</p>%s
<form action="/s"><label>Your mail</label><input><p>Subscribe to our newsletter</p></form>
<section id="comments"><h2>3 Comments</h2><div class="comment"><p>I liked this article a lot, thank you for writing it.</p></div></section>
</div><footer><p>&copy; 2020 Some company. All rights reserved.</p></footer></body></html>"""
STORY = ("The title of the story First paragraph of the story, which has a good number of words in it — indeed. Second paragraph, less long. "
         "After a break. Quoted words by somebody of note, at length. A last line.")


@pytest.mark.parametrize("shell", [("<article>", "</article>"), ("<main>", "</main>"), ("<div class='post-body'>", "</div>"),
                                   ("<div class='content'><article>", "</article></div>")])
def test_other_layouts(model, shell):
    assert html_crf.extractor(model)(PAGE % shell) == STORY


@pytest.mark.parametrize("html,text", [
    ("", ""), (None, ""), ("<article><p>a &lt; b &amp;amp; c &#233;&nbsp;d</p></article>", "a < b &amp; c é d"),
    ("<article><p>cut <a href=\"/The", "cut"), ("<article><p>wo<em>rd</em>s<p>next", "words next"),
    ("<article><!-- <p>no</p> --><p>yes indeed.</p><script>var x='<p>no</p>'</script><noscript>no</noscript></article>", "yes indeed."),
    ("<nav><a href=x>Home</a></nav><footer>foot</footer>", "")])
def test_cases(model, html, text):
    assert html_crf.extractor(model)(html) == text


def test_long_page(model):
    body = "".join(f"<p>Paragraph number {i} of this long story.</p>" for i in range(20_000))
    assert len(html_crf.extractor(model)(f"<body><article>{body}</article></body>").split("Paragraph")) == 20_001


def test_viterbi_is_the_best_of_all_sequences():
    rng = random.Random(3)
    for _ in range(100):
        n = rng.randint(1, 7)
        s, t, a = [rng.gauss(0, 2) for _ in range(n)], [[rng.gauss(0, 1) for _ in range(2)] for _ in range(2)], [rng.gauss(0, 1) for _ in range(2)]

        def total(y):
            return a[y[0]] + sum(x for x, k in zip(s, y) if k) + sum(t[i][j] for i, j in zip(y, y[1:]))
        best = max(itertools.product((0, 1), repeat=n), key=total)
        assert total(html_crf.viterbi(s, t, a)) == pytest.approx(total(best))


def test_rows(spark, model):
    schema = "page_id long, url string, html string, text string, extra int"
    df = spark.createDataFrame([(1, None, None, "old", 1), (None, "u", "<article><p>Some words.</p></article>", "old", 2)] * 2, schema)
    got = sorted(map(tuple, html_crf.extract(df, model).collect()), key=str)
    assert got == sorted([(1, None, 1, ""), (None, "u", 2, "Some words.")] * 2, key=str)
    assert html_crf.extract(df.limit(0), model).count() == 0
    assert html_crf.train(df.limit(0)) is html_crf.FIXED
    assert html_crf.extractor(html_crf.FIXED)(PAGE % ("<article>", "</article>")) == STORY
