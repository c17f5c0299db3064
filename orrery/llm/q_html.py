"""op9: main text of whole pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.llm import html_crf
from orrery.llm.base import query, table


@query("op9_html_text")
def op9_html_text(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    found = html_crf.extract(pages, html_crf.train(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
