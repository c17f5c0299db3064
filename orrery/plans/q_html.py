"""HTML extraction queries over ``pages`` and over directory
pages rendered from ``customer``."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.functions import html as H
from orrery.functions.constants import FOLD_ROW_CANDIDATES
from orrery.plans.registry import query
from orrery.sources.pages import directory_pages, nested_order_pages
from orrery.sources.tables import table


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _dec(x: str) -> str:
    for ent, ch in H.ENTITIES:
        x = f"replace({x}, {q(ent)}, {q(ch)})"
    return x


def _inner(x: str) -> str:
    return _dec(f"regexp_replace({x}, {q(H.TAG_RE)}, '', 'g')")


CLEAN = f"regexp_replace(html, {q(H.NOISE_RE)}, '', 'g')"


@query("htm1_paragraphs", f"""
WITH s AS (SELECT page_id, regexp_split_to_array({CLEAN}, {q(H.P_START_RE)}) AS parts FROM pages),
b AS (SELECT page_id, unnest(generate_series(0, len(parts) - 2)) AS para_no, unnest(parts[2:]) AS body FROM s)
SELECT page_id, CAST(para_no AS BIGINT) AS para_no,
       {_inner(f"regexp_replace(body, {q(H.P_END_RE)}, '')")} AS text
FROM b
""")
def htm1(spark, sf):
    p = table(spark, sf, "pages")
    ex = p.select("page_id", F.posexplode(H.paragraphs("html")).alias("para_no", "text"))
    return ex.withColumn("para_no", F.col("para_no").cast("long"))


def _tag_sql(tag: str) -> str:
    pat = f"(?s)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}>"
    return f"list_transform(regexp_extract_all({CLEAN}, {q(pat)}, 1), lambda x: {_inner('x')})"


@query("htm1_tag_texts", f"""
SELECT page_id, {_tag_sql('title')}[1] AS title, {_tag_sql('h1')}[1] AS h1, {_tag_sql('li')} AS items
FROM pages
""")
def htm1b(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id",
                    F.try_element_at(H.tag_texts("html", "title"), F.lit(1)).alias("title"),
                    F.try_element_at(H.tag_texts("html", "h1"), F.lit(1)).alias("h1"),
                    H.tag_texts("html", "li").alias("items"))


_HREF = "<a\\s[^>]*?\\bhref=\"([^\"]*)\""


@query("htm2_links", f"""
WITH l AS (SELECT page_id, url, regexp_extract_all({CLEAN}, {q(_HREF)}, 1) AS hrefs FROM pages),
u AS (SELECT page_id, url, unnest(generate_series(0, len(hrefs) - 1)) AS pos, unnest(hrefs) AS href FROM l)
SELECT page_id, CAST(pos AS BIGINT) AS pos, href,
       CASE WHEN regexp_matches(href, '^[a-z]+://') THEN href
            WHEN starts_with(href, '/') THEN regexp_extract(url, '^([a-z]+://[^/]+)', 1) || href
            ELSE regexp_replace(url, '[^/]*$', '') || href END AS absolute
FROM u
""")
def htm2(spark, sf):
    p = table(spark, sf, "pages")
    ex = p.select("page_id", "url", F.posexplode(H.attribute_values("html", "a", "href")).alias("pos", "href"))
    return ex.select("page_id", F.col("pos").cast("long").alias("pos"), "href",
                     H.join_url("url", "href").alias("absolute"))


def _attr_sql(tag: str, attr: str) -> str:
    pat = f"<{tag}\\s[^>]*?\\b{attr}=\"([^\"]*)\""
    return f"regexp_extract({CLEAN}, {q(pat)}, 1)"


@query("htm2_page_attributes", f"""
SELECT page_id, {_attr_sql('html', 'lang')} AS lang, {_attr_sql('meta', 'charset')} AS charset,
       {_attr_sql('div', 'class')} AS div_class
FROM pages
""")
def htm2b(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", H.first_attribute("html", "html", "lang").alias("lang"),
                    H.first_attribute("html", "meta", "charset").alias("charset"),
                    H.first_attribute("html", "div", "class").alias("div_class"))


def _directory_cells(spark, sf):
    pages = directory_pages(table(spark, sf, "customer"))
    t = H.select_table("html", "aria-labelledby", "directory")
    rows = pages.select("page_id", F.posexplode(H.table_rows(t)).alias("row_no", "tr"))
    rows = rows.filter(F.col("row_no") > 0)  # header row
    return rows.select("page_id", F.col("row_no").cast("long").alias("row_no"),
                       H.row_cells("tr").alias("cells"))


_DIR_SQL = """(SELECT c_custkey // 64 AS page_id,
        row_number() OVER (PARTITION BY c_custkey // 64 ORDER BY c_custkey) AS row_no,
        c_name, c_mktsegment, c_acctbal FROM customer)"""


@query("htm3_table_cells", f"""
SELECT page_id, row_no, CASE WHEN c_acctbal < 0 THEN 'unknown' ELSE c_name END AS name,
       CASE WHEN c_acctbal < 0 THEN 'unknown' ELSE c_mktsegment END AS segment,
       CASE WHEN c_acctbal < 0 THEN 'unknown' ELSE printf('%.2f', c_acctbal) END AS balance
FROM {_DIR_SQL} d
""")
def htm3(spark, sf):
    """Rows of the table chosen by its aria label: header cell, second and
    third cell, trimmed; a row that is too short has ``unknown`` in all."""
    c = _directory_cells(spark, sf)

    def cell(i):
        return F.when(F.size("cells") >= 3, F.trim(F.get("cells", F.lit(i)))).otherwise(F.lit("unknown"))

    return c.select("page_id", "row_no", cell(0).alias("name"), cell(1).alias("segment"), cell(2).alias("balance"))


@query("htm3_nested_tables", """
WITH o AS (SELECT o_orderkey // 128 AS page_id, o_orderkey, o_orderstatus, o_totalprice,
                  row_number() OVER (PARTITION BY o_orderkey // 128 ORDER BY o_orderkey) - 1 AS r FROM orders),
l AS (SELECT o.page_id, o.r, l_linenumber, l_quantity, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, printf('%.2f', l_quantity)) - 1 AS k
      FROM o JOIN lineitem ON l_orderkey = o_orderkey)
SELECT page_id, 0 AS table_no, NULL::BIGINT AS parent_no, 1 AS depth, r AS row_no, 0 AS cell_no, true AS is_header, CAST(o_orderkey AS VARCHAR) AS text FROM o
UNION ALL SELECT page_id, 0, NULL, 1, r, 1, false, o_orderstatus FROM o
UNION ALL SELECT page_id, 0, NULL, 1, r, 2, false, printf('%.2f', o_totalprice) FROM o
UNION ALL SELECT page_id, r + 1, 0, 2, k, 0, false, CAST(l_linenumber AS VARCHAR) FROM l
UNION ALL SELECT page_id, r + 1, 0, 2, k, 1, false, printf('%.2f', l_quantity) FROM l
""")
def htm3_nested(spark, sf):
    """Cells of tables inside tables, each in its own table: orders with a
    table of lines in a cell of every row."""
    pages = nested_order_pages(table(spark, sf, "orders"), table(spark, sf, "lineitem"))
    cells = H.table_cells(pages, "page_id", "html")
    return cells.filter(F.col("attributes").rlike('^(aria-labelledby="orders"|class="lines")$')).drop("attributes")


@query("htm4_numeric_cells", f"""
SELECT page_id, row_no, round(c_acctbal, 2) AS value FROM {_DIR_SQL} d WHERE c_acctbal >= 0
""")
def htm4(spark, sf):
    c = _directory_cells(spark, sf)
    v = c.select("page_id", "row_no", F.explode(H.numeric_cells("cells")).alias("value"))
    return v


_CANDS = ", ".join(str(n) for n in FOLD_ROW_CANDIDATES)


@query("htm5_fold_columns", f"""
WITH l AS (SELECT c_custkey // 64 AS page_id, list(round(c_acctbal, 2) ORDER BY c_custkey) AS vals
           FROM customer WHERE c_acctbal >= 0 GROUP BY c_custkey // 64),
n AS (SELECT page_id, vals, list_filter([{_CANDS}], lambda k: len(vals) % k = 0)[1] AS n FROM l),
u AS (SELECT page_id, n, unnest(generate_series(0, len(vals) - 1)) AS i, unnest(vals) AS value
      FROM n WHERE n IS NOT NULL)
SELECT page_id, CAST(n AS INTEGER) AS n_rows, CAST(i % n AS BIGINT) AS row_idx,
       CAST(i // n AS BIGINT) AS col_idx, value FROM u
""")
def htm5(spark, sf):
    """Fold each page's flat list of numeric cells into columns: the row
    count is the first candidate dividing the length; element i goes to
    column i div n, row i mod n.  Pages with no fitting candidate are
    skipped."""
    c = _directory_cells(spark, sf)
    num = c.select("page_id", "row_no", F.explode(H.numeric_cells("cells")).alias("value"))
    lists = num.groupBy("page_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("row_no", "value"))), lambda s: s["value"]).alias("vals"))
    lists = lists.withColumn("n_rows", H.fold_rows(F.size("vals"), FOLD_ROW_CANDIDATES))
    ex = lists.filter(F.col("n_rows").isNotNull()).select(
        "page_id", "n_rows", F.posexplode("vals").alias("i", "value"))
    return ex.select("page_id", "n_rows", (F.col("i") % F.col("n_rows")).cast("long").alias("row_idx"),
                     (F.col("i") / F.col("n_rows")).cast("long").alias("col_idx"), "value")


@query("htm2_by_class_and_attribute", """
SELECT p_partkey // 16 AS page_id, CAST(row_number() OVER (PARTITION BY p_partkey // 16 ORDER BY p_partkey) - 1 AS BIGINT) AS pos,
       p_name AS title, printf('%.2f', floor(p_retailprice * 100 + 0.5) / 100) AS price, p_brand AS rating,
       'parts ' || CAST(p_partkey // 16 AS VARCHAR) AS description
FROM part
""")
def htm2c(spark, sf):
    """Shop pages made from the parts: product blocks picked by class token,
    price by class, rating as the second class token, title by attribute,
    page description by ``meta[name=description]``."""
    p = table(spark, sf, "part").withColumn("page_id", F.floor(F.col("p_partkey") / 16))
    price = F.format_string("%.2f", F.floor(F.col("p_retailprice") * 100 + 0.5) / 100)
    block = F.format_string('<article class="product_pod hot"><h3><a href="/p" title="%s">x</a></h3><p class="instock">y</p>'
                            '<p class="price_color big">%s</p><p class="star-rating %s">s</p></article>',
                            "p_name", price, "p_brand")
    pages = p.groupBy("page_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("p_partkey", block.alias("b")))),
                                                              lambda s: s["b"]), "").alias("body"))
    pages = pages.select("page_id", F.concat(F.lit('<html><head><meta name="author" content="a"><meta content="parts '), F.col("page_id"),
                                             F.lit('" name="description"></head><body><p class="price">no</p>'), F.col("body"),
                                             F.lit("</body></html>")).alias("html"))
    pods = pages.select("page_id", H.attribute_where("html", "meta", "content", "name", "description").alias("description"),
                        F.posexplode(H.elements_of_class("html", "article", "product_pod")).alias("pos", "pod"))
    rating = H.class_tokens(F.regexp_extract("pod", 'class="(star-rating [^"]*)"', 1))
    return pods.select("page_id", F.col("pos").cast("long").alias("pos"), H.first_attribute("pod", "a", "title").alias("title"),
                       F.get(H.elements_of_class("pod", "p", "price_color"), F.lit(0)).alias("price"),
                       F.get(rating, F.lit(1)).alias("rating"), "description")
