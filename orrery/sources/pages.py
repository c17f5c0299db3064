"""Page sources.

``pages`` rows are stored HTML (SRC-9).  ``directory_pages`` renders a
table into HTML pages (one page per block of keys, rows in key order), the
kind of input the table extractors (HTM-3..5) read.  Each page gathers at
most ``rows_per_page`` rows, so no page grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def directory_pages(customer: DataFrame, rows_per_page: int = 64) -> DataFrame:
    """Customers as directory pages: a decoy legend table, then a table
    labelled ``directory`` with a header row and one row per customer.
    Customers with a negative balance get a short row (two cells)."""
    c = customer.select(
        "c_custkey", "c_name", "c_mktsegment", "c_acctbal",
        (F.col("c_custkey") / rows_per_page).cast("long").alias("page_id"))
    cells = F.when(F.col("c_acctbal") < 0,
                   F.format_string("<tr><th>%s</th><td>%s</td></tr>", "c_name", "c_mktsegment")) \
        .otherwise(F.format_string("<tr><th>%s</th><td>%s</td><td>%.2f</td></tr>",
                                   "c_name", "c_mktsegment", "c_acctbal"))
    rows = c.select("page_id", "c_custkey", cells.alias("tr"))
    grouped = rows.groupBy("page_id").agg(
        F.array_sort(F.collect_list(F.struct("c_custkey", "tr"))).alias("rows"))
    body = F.array_join(F.transform("rows", lambda r: r["tr"]), "\n")
    html = F.concat(
        F.lit("<html><body><table aria-labelledby=\"legend\"><tr><th>Key</th><td>Value</td></tr></table>\n"
              "<table class=\"dir\" aria-labelledby=\"directory\">\n"
              "<tr><th>Name</th><th>Segment</th><th>Balance</th></tr>\n"),
        body, F.lit("\n</table></body></html>"))
    return grouped.select("page_id", html.alias("html"))


def nested_order_pages(orders: DataFrame, lineitem: DataFrame, keys_per_page: int = 128) -> DataFrame:
    """Orders as pages with a table inside every row: a table labelled
    ``orders``, one row per order (key as header cell, status and the table of
    its lines, price), one page per block of keys."""
    line = F.format_string("<tr><td>%d</td><td>%.2f</td></tr>", "l_linenumber", "l_quantity")
    lines = lineitem.groupBy("l_orderkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list(
        F.struct("l_linenumber", line.alias("tr")))), lambda x: x["tr"]), "").alias("trs"))
    row = F.format_string('<tr><th>%d</th><td> %s <table class="lines">%s</table></td><td>%.2f</td></tr>', "o_orderkey", "o_orderstatus",
                          F.coalesce("trs", F.lit("")), "o_totalprice")
    o = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    g = o.groupBy(F.expr(f"o_orderkey div {keys_per_page}").alias("page_id")).agg(
        F.sort_array(F.collect_list(F.struct("o_orderkey", row.alias("tr")))).alias("rows"))
    return g.select("page_id", F.concat(F.lit('<html><body><table aria-labelledby="orders">'),
                                        F.array_join(F.transform("rows", lambda x: x["tr"]), ""), F.lit("</table></body></html>")).alias("html"))
