"""JSON queries: documents derived from the tables
with ``to_json``, parsed back with explicit schemas and flattened."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.operators import jsonflat as JF
from orrery.plans.registry import query
from orrery.sources import jsondocs as JD
from orrery.session import scratch_path
from orrery.sources.tables import table


def _order_docs(spark, sf, stats: bool = False):
    docs = JD.order_documents(table(spark, sf, "orders"), table(spark, sf, "lineitem"),
                              table(spark, sf, "customer"), table(spark, sf, "nation"), stats)
    return docs.select("customer", "season", F.col("page").cast("long").alias("page"),
                       JD.parse_json("json", JD.ORDER_DOC_SCHEMA).alias("doc"))


_ORD = """(SELECT *, (row_number() OVER w - 1) // 2 AS page, CAST(count(*) OVER (PARTITION BY o_custkey, season) AS INTEGER) AS results
           FROM (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS season FROM orders) q
           WINDOW w AS (PARTITION BY o_custkey, season ORDER BY o_orderkey))"""
_LINES = "(SELECT l_orderkey, count(*) AS n, min(l_quantity) AS mn, max(l_quantity) AS mx FROM lineitem GROUP BY 1)"


@query("jsn1_nested_field", """
SELECT event_id, CAST(props->>'k' AS INTEGER) AS k FROM events
""")
def jsn1(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", JD.parse_json("props", "k int")["k"].alias("k"))


@query("jsn1_array_field_lists", f"""
SELECT o.o_custkey AS customer, o.season, o.page,
       list(o.o_orderkey ORDER BY o.o_orderkey) AS order_ids,
       list(CAST(coalesce(l.n, 0) AS INTEGER) ORDER BY o.o_orderkey) AS line_counts
FROM {_ORD} o LEFT JOIN {_LINES} l ON o.o_orderkey = l.l_orderkey
GROUP BY o.o_custkey, o.season, o.page
""")
def jsn1b(spark, sf):
    d = _order_docs(spark, sf)
    return d.select("customer", "season", "page",
                    F.transform(JF.pluck("doc.response", "order"), lambda o: o["id"]).alias("order_ids"),
                    F.transform("doc.response", lambda r: F.size(r["lines"])).alias("line_counts"))


@query("jsn2_entry_min_max", f"""
SELECT o.o_custkey AS customer, o.o_orderkey AS order_id, n.n_name AS country,
       l.mn AS min_qty, l.mx AS max_qty
FROM {_ORD} o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN {_LINES} l ON o.o_orderkey = l.l_orderkey
""")
def jsn2(spark, sf):
    d = JF.entries(_order_docs(spark, sf), "doc", "response", keep=["customer"])
    qty = JF.pluck("entry.lines", "qty")
    return d.select("customer", F.col("entry.order.id").alias("order_id"),
                    F.col("entry.country.name").alias("country"),
                    F.array_min(qty).alias("min_qty"), F.array_max(qty).alias("max_qty"))


@query("jsn3_entries_with_parameters", f"""
SELECT o.o_orderkey AS order_id, o.o_custkey AS param_customer, CAST(o.season AS INTEGER) AS param_season,
       o.o_orderstatus AS status
FROM {_ORD} o
""")
def jsn3(spark, sf):
    d = _order_docs(spark, sf)
    e = JF.entries(d, "doc", "response", keep=[F.col("doc.parameters.customer").alias("param_customer"),
                                                F.col("doc.parameters.season").alias("param_season")])
    return e.select(F.col("entry.order.id").alias("order_id"), "param_customer", "param_season",
                    F.col("entry.order.status").alias("status"))


@query("jsn4_two_level_explode", f"""
SELECT o.o_orderkey AS order_id, l.l_linenumber AS line, l.l_quantity AS qty
FROM {_ORD} o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey
""")
def jsn4(spark, sf):
    d = _order_docs(spark, sf)
    x = JF.explode_two(d, "doc.response", "lines")
    return x.select(F.col("entry.order.id").alias("order_id"), F.col("item.line").alias("line"),
                    F.col("item.qty").alias("qty"))


_WIDE = {
    "get": "doc.get", "param_customer": "doc.parameters.customer", "param_season": "doc.parameters.season",
    "results": "doc.results", "paging_current": "doc.paging.current", "paging_total": "doc.paging.total",
    "order_id": "entry.order.id", "order_status": "entry.order.status",
    "order_priority": "entry.order.priority", "order_total": "entry.order.total",
    "customer_id": "entry.customer.id", "customer_name": "entry.customer.name",
    "customer_segment": "entry.customer.segment", "country_name": "entry.country.name",
    "order_date": "entry.order.date",
    **{f"lines_{k}": f"entry.stats.lines.{k}" for k in ("total", "returned", "accepted", "open", "shipped")},
    **{f"{g}_{k}": f"entry.stats.{g}.{k}" for g in ("qty", "price") for k in ("total", "min", "max")},
    **{f"{g}_{k}": f"entry.stats.{g}.{k}" for g in ("discount", "tax") for k in ("min", "max")},
    "ship_first": "entry.stats.ship.first", "ship_last": "entry.stats.ship.last",
}


@query("jsn5_wide_flatten", f"""
SELECT 'orders' AS get, o.o_custkey AS param_customer, o.season AS param_season,
       o.results, CAST(o.page + 1 AS INTEGER) AS paging_current, CAST(ceil(o.results / 2) AS INTEGER) AS paging_total,
       o.o_orderkey AS order_id, o.o_orderstatus AS order_status, o.o_orderpriority AS order_priority,
       o.o_totalprice AS order_total, c.c_custkey AS customer_id, c.c_name AS customer_name,
       c.c_mktsegment AS customer_segment, n.n_name AS country_name, strftime(o.o_orderdate, '%Y-%m-%d') AS order_date,
       lines_total, lines_returned, lines_accepted, lines_open, lines_shipped, qty_total, qty_min, qty_max, price_total, price_min,
       price_max, discount_min, discount_max, tax_min, tax_max, ship_first, ship_last
FROM {_ORD} o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN (SELECT l_orderkey, count(*) AS lines_total, count(*) FILTER (WHERE l_returnflag = 'R') AS lines_returned,
    count(*) FILTER (WHERE l_returnflag = 'A') AS lines_accepted, count(*) FILTER (WHERE l_linestatus = 'O') AS lines_open,
    count(*) FILTER (WHERE l_linestatus = 'F') AS lines_shipped, round(sum(l_quantity), 2) AS qty_total, min(l_quantity) AS qty_min,
    max(l_quantity) AS qty_max, round(sum(l_extendedprice), 2) AS price_total, min(l_extendedprice) AS price_min,
    max(l_extendedprice) AS price_max, min(l_discount) AS discount_min, max(l_discount) AS discount_max, min(l_tax) AS tax_min,
    max(l_tax) AS tax_max, strftime(min(l_shipdate), '%Y-%m-%d') AS ship_first, strftime(max(l_shipdate), '%Y-%m-%d') AS ship_last
    FROM lineitem GROUP BY l_orderkey) s ON s.l_orderkey = o.o_orderkey
""")
def jsn5(spark, sf):
    """32 columns out of nested documents and their statistics."""
    d = _order_docs(spark, sf, stats=True)
    e = d.select("doc", F.explode("doc.response").alias("entry"))
    return JF.flatten_paths(e, _WIDE)


@query("jsn6_paging_remaining", f"""
SELECT DISTINCT o_custkey AS customer, season, page, 'orders' AS get, results,
       CAST(ceil(results / 2) - page - 1 AS INTEGER) AS pages_remaining
FROM {_ORD} x
""")
def jsn6(spark, sf):
    d = _order_docs(spark, sf)
    return d.select("customer", "season", "page", F.col("doc.get").alias("get"), F.col("doc.results").alias("results"),
                    (F.col("doc.paging.total") - F.col("doc.paging.current")).alias("pages_remaining"))


@query("jsn7_category_stats", """
WITH g AS (SELECT user_id, event_type, count(*) AS n, sum(value) AS total FROM events GROUP BY 1, 2)
SELECT user_id, event_type AS category, 'events' AS display_name, CAST(n AS VARCHAR) AS display_value,
       NULL::VARCHAR AS per_game, CASE WHEN n >= 15 THEN '#' || CAST(n // 5 AS VARCHAR) END AS rank_value,
       NULL::VARCHAR AS description
FROM g
UNION ALL
SELECT user_id, event_type, 'value', printf('%.2f', floor(total * 100 + 0.5) / 100),
       CASE WHEN event_type = 'purchase' THEN printf('%.2f', floor(total / n * 100 + 0.5) / 100) END, NULL, NULL
FROM g
""")
def jsn7(spark, sf):
    """Double-encoded statistics documents: decode twice, explode the
    categories and their stats; absent optional keys come out as NULL."""
    docs = JD.stats_documents(table(spark, sf, "events"))
    d = docs.select("user_id", JD.parse_double_encoded("payload", JD.STATS_DOC_SCHEMA).alias("doc"))
    c = d.select("user_id", F.explode("doc.statistics.splits.categories").alias("cat"))
    s = c.select("user_id", F.col("cat.name").alias("category"), F.explode("cat.stats").alias("st"))
    return s.select("user_id", "category", F.col("st.displayName").alias("display_name"),
                    F.col("st.displayValue").alias("display_value"),
                    F.col("st.perGameDisplayValue").alias("per_game"),
                    F.col("st.rankDisplayValue").alias("rank_value"),
                    F.col("st.description").alias("description"))


@query("src8_json_documents", f"""
SELECT o_custkey AS customer, season, page, min(results) AS results, round(sum(o_totalprice), 2) AS total
FROM {_ORD} x GROUP BY 1, 2, 3
""")
def src8(spark, sf):
    """Documents written as JSON files and read with an explicit schema;
    per-document totals."""
    docs = JD.order_documents(table(spark, sf, "orders"), table(spark, sf, "lineitem"),
                              table(spark, sf, "customer"), table(spark, sf, "nation"))
    path = scratch_path(spark, "src8")
    docs.select("json").write.text(path)
    d = JD.read_json_documents(spark, path, JD.ORDER_DOC_SCHEMA, multi_line=False)
    return d.select(F.col("parameters.customer").alias("customer"), F.col("parameters.season").alias("season"),
                    (F.col("paging.current") - 1).cast("long").alias("page"), "results",
                    F.round(F.aggregate(F.transform("response", lambda r: r["order"]["total"]),
                                        F.lit(0.0), lambda a, x: a + x), 2).alias("total"))
