"""Relational queries: projections, filters, nulls, grouping, order, sets,
lookups (SURVEY 2.1-2.7).  Each query reads whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.operators import relational as rel
from orrery.plans.registry import query
from orrery.session import bounded_broadcast
from orrery.sources.tables import table


def R(c, d: int = 6):
    return F.round(F.col(c) if isinstance(c, str) else c, d)


# ------------------------------------------------------------ flagship ----

@query("ml1_linefit_by_flag", """
SELECT l_returnflag,
       round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept,
       round(regr_r2(l_extendedprice, l_quantity), 6) AS r2,
       count(*) AS n
FROM lineitem GROUP BY l_returnflag
""")
def ml1_linefit_by_flag(spark, sf):
    """ML-1 per group: least-squares line of price on quantity per flag."""
    li = table(spark, sf, "lineitem")
    y, x = F.col("l_extendedprice"), F.col("l_quantity")
    return li.groupBy("l_returnflag").agg(
        R(F.regr_slope(y, x)).alias("slope"),
        R(F.regr_intercept(y, x)).alias("intercept"),
        R(F.regr_r2(y, x)).alias("r2"),
        F.count(F.lit(1)).alias("n"))


# ----------------------------------------------------------------- PRJ ----

@query("prj1_keep_columns", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
""")
def prj1(spark, sf):
    return rel.keep_columns(table(spark, sf, "lineitem"),
                            ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"])


@query("prj2_drop_columns", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
""")
def prj2(spark, sf):
    return rel.drop_columns(table(spark, sf, "orders"), ["o_orderdate", "o_orderpriority"])


@query("prj3_columns_except", """
SELECT c_custkey, c_nationkey, c_acctbal FROM customer
""")
def prj3(spark, sf):
    return rel.columns_except(table(spark, sf, "customer"), ["c_name", "c_mktsegment"])


@query("prj4_columns_by_position", """
SELECT p_partkey, p_name, p_brand, p_type, p_size FROM part
""")
def prj4(spark, sf):
    return rel.columns_by_position(table(spark, sf, "part"), None, -1)


@query("prj5_rename", """
SELECT s_suppkey AS supplier_id, s_name, s_nationkey, s_acctbal AS balance FROM supplier
""")
def prj5(spark, sf):
    return rel.rename_columns(table(spark, sf, "supplier"),
                              {"s_suppkey": "supplier_id", "s_acctbal": "balance"})


@query("prj6_cast_truncate", """
SELECT l_orderkey, l_linenumber,
       CAST(trunc(l_extendedprice) AS INTEGER) AS price_int,
       CAST(round(l_discount * 100) AS SMALLINT) AS discount_pct
FROM lineitem
""")
def prj6(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     rel.truncate_int("l_extendedprice").alias("price_int"),
                     rel.round_narrow(F.col("l_discount") * 100, "short").alias("discount_pct"))


@query("prj7_recode", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END AS status_code
FROM orders
""")
def prj7(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", rel.recode("o_orderstatus", {"F": 0, "O": 1}).alias("status_code"))


@query("prj8_lump_levels", """
SELECT p_partkey,
       CASE WHEN p_brand IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4', 'Brand#5')
            THEN p_brand ELSE 'other' END AS brand_group
FROM part
""")
def prj8(spark, sf):
    p = table(spark, sf, "part")
    keep = ["Brand#1", "Brand#2", "Brand#3", "Brand#4", "Brand#5"]
    return p.select("p_partkey", rel.lump_levels("p_brand", keep).alias("brand_group"))


@query("prj8_lump_by_count", """
WITH common AS (SELECT p_brand FROM part GROUP BY p_brand HAVING count(*) >= 80)
SELECT p.p_partkey,
       CASE WHEN c.p_brand IS NOT NULL THEN p.p_brand ELSE 'other' END AS brand_group
FROM part p LEFT JOIN common c ON p.p_brand = c.p_brand
""")
def prj8b(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_brand")
    scaled = 80
    out = rel.lump_by_count(p, "p_brand", scaled, out="brand_group")
    return out.select("p_partkey", "brand_group")


@query("prj9_binarise", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_quantity >= 25 THEN 1 ELSE 0 END AS big_qty,
       CASE WHEN l_extendedprice > 50000 THEN 255 ELSE 0 END AS price_level
FROM lineitem
""")
def prj9(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     rel.binarise("l_quantity", 25).alias("big_qty"),
                     rel.binarise("l_extendedprice", 50000, strict=True, hi=255).alias("price_level"))


@query("prj10_align_columns", """
SELECT count(*) FILTER (WHERE c_mktsegment = 'AUTOMOBILE') AS AUTOMOBILE,
       count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS BUILDING,
       count(*) FILTER (WHERE c_mktsegment = 'FURNITURE') AS FURNITURE,
       0 AS HOUSEHOLD, 0 AS MACHINERY, c_nationkey
FROM customer GROUP BY c_nationkey
""")
def prj10(spark, sf):
    """Scoring frame that only saw three segments, aligned to the fitted
    schema of five segment columns plus the key (missing -> 0)."""
    c = table(spark, sf, "customer")
    seen = ["AUTOMOBILE", "BUILDING", "FURNITURE"]
    wide = (c.groupBy("c_nationkey").pivot("c_mktsegment", seen).count().na.fill(0, seen))
    fitted = ["c_nationkey", "AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    return rel.align_columns(wide, fitted)


# ----------------------------------------------------------------- FLT ----

@query("flt1_filter_membership", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'F'
""")
def flt1(spark, sf):
    o = table(spark, sf, "orders")
    o = rel.filter_in(o, "o_orderpriority", ["1-URGENT", "2-HIGH"])
    return rel.filter_in(o, "o_orderstatus", "F").select("o_orderkey", "o_totalprice")


def _orders_with_nulls(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey",
                    F.expr("nullif(o_orderpriority, '5-LOW')").alias("priority"),
                    F.expr("nullif(o_orderstatus, 'P')").alias("status"),
                    "o_totalprice")


_ORDERS_NULLS_SQL = """(SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority,
        nullif(o_orderstatus, 'P') AS status, o_totalprice FROM orders)"""


@query("flt2_rows_with_null", f"""
SELECT * FROM {_ORDERS_NULLS_SQL} t WHERE priority IS NULL OR status IS NULL OR o_totalprice IS NULL
""")
def flt2a(spark, sf):
    return rel.rows_with_any_null(_orders_with_nulls(spark, sf))


@query("flt2_drop_null", f"""
SELECT * FROM {_ORDERS_NULLS_SQL} t WHERE priority IS NOT NULL AND status IS NOT NULL
""")
def flt2b(spark, sf):
    return rel.drop_any_null(_orders_with_nulls(spark, sf))


@query("flt3_exact_else_prefix", """
WITH s AS (SELECT * FROM (VALUES ('red'), ('small ring')) v(search)),
cand AS (
  SELECT s.search, p.p_partkey, p.p_name,
         CASE WHEN p.p_name = s.search THEN 1 WHEN starts_with(p.p_name, s.search) THEN 2 END AS prio
  FROM part p, s)
SELECT search, p_partkey, p_name FROM cand c
WHERE prio IS NOT NULL AND prio = (SELECT min(prio) FROM cand c2 WHERE c2.search = c.search AND c2.prio IS NOT NULL)
""")
def flt3(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    outs = []
    for text in ("red", "small ring"):
        outs.append(rel.exact_else_prefix(p, "p_name", text)
                    .select(F.lit(text).alias("search"), "p_partkey", "p_name"))
    return rel.stack(outs)


@query("flt4_envelope_check", """
SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'accepted' ELSE 'rejected' END AS envelope
FROM events
""")
def flt4(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type")
    ok, bad = rel.split_by(e, F.col("event_type") == "purchase")
    return rel.stack([ok.select("event_id", F.lit("accepted").alias("envelope")),
                      bad.select("event_id", F.lit("rejected").alias("envelope"))])


# ----------------------------------------------------------------- NUL ----

@query("nul1_fill_constant", """
SELECT p_partkey, coalesce(CASE WHEN p_size < 5 THEN NULL ELSE p_size END, 0) AS size_filled
FROM part
""")
def nul1(spark, sf):
    p = table(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_size") < 5, None).otherwise(F.col("p_size")).alias("size_filled"))
    return rel.fill_constant(p, 0, ["size_filled"])


@query("nul2_fill_group_mean", """
WITH c AS (SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS bal
           FROM customer)
SELECT c_custkey, c_mktsegment,
       round(coalesce(bal, avg(bal) OVER (PARTITION BY c_mktsegment)), 6) AS acctbal_filled
FROM c
""")
def nul2(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey", "c_mktsegment",
        F.when(F.col("c_acctbal") < 0, None).otherwise(F.col("c_acctbal")).alias("bal"))
    f = rel.fill_group_mean(c, ["c_mktsegment"], "bal")
    return f.select("c_custkey", "c_mktsegment", R("bal").alias("acctbal_filled"))


@query("win5_group_mean_to_rows", """
SELECT l_orderkey, l_linenumber,
       round(avg(l_quantity) OVER (PARTITION BY l_returnflag), 6) AS group_avg_qty
FROM lineitem
""")
def win5(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    j = rel.group_stat(li, ["l_returnflag"], "l_quantity", F.avg, "g")
    return j.select("l_orderkey", "l_linenumber", R("g").alias("group_avg_qty"))


# ------------------------------------------------------------------ AG ----

@query("ag1_null_counts", f"""
SELECT 'o_orderkey' AS column_name, count(*) FILTER (WHERE o_orderkey IS NULL) AS null_count FROM {_ORDERS_NULLS_SQL} t
UNION ALL SELECT 'priority', count(*) FILTER (WHERE priority IS NULL) FROM {_ORDERS_NULLS_SQL} t
UNION ALL SELECT 'status', count(*) FILTER (WHERE status IS NULL) FROM {_ORDERS_NULLS_SQL} t
UNION ALL SELECT 'o_totalprice', count(*) FILTER (WHERE o_totalprice IS NULL) FROM {_ORDERS_NULLS_SQL} t
""")
def ag1(spark, sf):
    return rel.null_counts(_orders_with_nulls(spark, sf))


@query("ag2_value_counts", """
SELECT p_brand, count(*) AS cnt FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand
""")
def ag2(spark, sf):
    return rel.value_counts(table(spark, sf, "part"), "p_brand")


@query("ag3_min_max", """
SELECT min(l_quantity) AS min_qty, max(l_quantity) AS max_qty,
       min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price
FROM lineitem
""")
def ag3(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.agg(F.min("l_quantity").alias("min_qty"), F.max("l_quantity").alias("max_qty"),
                  F.min("l_extendedprice").alias("min_price"), F.max("l_extendedprice").alias("max_price"))


@query("ag5_distinct_values", """
SELECT DISTINCT event_type FROM events
""")
def ag5a(spark, sf):
    return table(spark, sf, "events").select("event_type").distinct()


@query("ag5_count_distinct_if", """
SELECT event_type, count(DISTINCT CASE WHEN value > 10 THEN user_id END) AS users_over_10
FROM events GROUP BY event_type
""")
def ag5b(spark, sf):
    e = table(spark, sf, "events")
    return e.groupBy("event_type").agg(
        F.count_distinct(F.when(F.col("value") > 10, F.col("user_id"))).alias("users_over_10"))


@query("ag5_first_per_key", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT o_custkey, o_orderkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders) t WHERE rn = 1
""")
def ag5c(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    first = rel.first_per_key(o, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")])
    return first.select("o_custkey", "o_orderkey", "o_totalprice")


@query("ag5_distinct_all_columns", """
SELECT DISTINCT value FROM (SELECT p_brand AS value FROM part UNION ALL SELECT p_type FROM part) t
""")
def ag5d(spark, sf):
    return rel.distinct_values_all_columns(table(spark, sf, "part"), ["p_brand", "p_type"])


@query("ag6_majority_label", """
SELECT l_suppkey, majority FROM (
  SELECT l_suppkey, l_returnflag AS majority,
         row_number() OVER (PARTITION BY l_suppkey ORDER BY cnt DESC, l_returnflag) AS rn
  FROM (SELECT l_suppkey, l_returnflag, count(*) AS cnt FROM lineitem GROUP BY 1, 2) c) t
WHERE rn = 1
""")
def ag6(spark, sf):
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag")
    return rel.majority_label(li, ["l_suppkey"], "l_returnflag")


@query("ag7_three_way_vote", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN a = b THEN a WHEN a = c THEN a WHEN b = c THEN b ELSE c END AS vote
FROM (SELECT l_orderkey, l_linenumber, l_linenumber % 3 AS a,
             CAST(trunc(l_quantity) AS INTEGER) % 3 AS b, CAST(l_partkey % 3 AS INTEGER) AS c
      FROM lineitem) t
""")
def ag7(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        (F.col("l_linenumber") % 3).alias("a"),
        (F.col("l_quantity").cast("int") % 3).alias("b"),
        (F.col("l_partkey") % 3).cast("int").alias("c"))
    return li.select("l_orderkey", "l_linenumber", rel.vote3("a", "b", "c").alias("vote"))


@query("ag19_pivot_long_to_wide", """
SELECT user_id,
       round(sum(value) FILTER (WHERE event_type = 'click'), 6) AS click,
       round(sum(value) FILTER (WHERE event_type = 'purchase'), 6) AS purchase,
       round(sum(value) FILTER (WHERE event_type = 'view'), 6) AS view
FROM events GROUP BY user_id
""")
def ag19(spark, sf):
    """Per-user stat rows (stat_name, stat_value), deduped, pivoted to the
    chosen stats only."""
    e = table(spark, sf, "events")
    long = (e.groupBy("user_id", F.col("event_type").alias("stat_name"))
             .agg(F.sum("value").alias("stat_value")))
    wide = rel.long_to_wide(long, ["user_id"], "stat_name", "stat_value",
                            ["click", "purchase", "view"])
    return wide.select("user_id", *[R(c).alias(c) for c in ("click", "purchase", "view")])


# ----------------------------------------------------------------- ORD ----

@query("ord1_top_n", """
SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY l_orderkey
ORDER BY n_lines DESC, l_orderkey LIMIT 15
""")
def ord1(spark, sf):
    li = table(spark, sf, "lineitem")
    cnt = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"))
    return rel.top_n(cnt, 15, [F.desc("n_lines"), F.asc("l_orderkey")])


@query("ord2_sort_nulls_last", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS bal
FROM customer ORDER BY bal ASC NULLS LAST, c_custkey
""")
def ord2(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") < 0, None).otherwise(F.col("c_acctbal")).alias("bal"))
    return rel.sort_nulls_last(c, "bal", True, ["c_custkey"])


@query("ord4_random_order", """
SELECT o_orderkey, CAST('0x' || substr(md5('7:' || CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 1000003 AS shuffle_key
FROM orders ORDER BY shuffle_key, o_orderkey
""")
def ord4(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    return rel.random_order(o.withColumn("shuffle_key", rel.hash_order("o_orderkey", 7)),
                            seed=7, key="o_orderkey")


@query("ord5_head", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10
""")
def ord5(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return rel.top_n(o, 10, [F.col("o_orderkey")])


# ----------------------------------------------------------------- SET ----

@query("set1_union_by_name", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS acctbal, 'customer' AS kind FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_acctbal, 'supplier' FROM supplier
""")
def set1(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("acctbal"), F.lit("customer").alias("kind"))
    s = table(spark, sf, "supplier").select(
        F.lit("supplier").alias("kind"), F.col("s_acctbal").alias("acctbal"),
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    return rel.stack([c, s])


@query("set2_distinct_union_sorted", """
SELECT DISTINCT value FROM (SELECT c_nationkey AS value FROM customer
                            UNION SELECT s_nationkey FROM supplier) t ORDER BY value
""")
def set2(spark, sf):
    return rel.distinct_union(table(spark, sf, "customer"), table(spark, sf, "supplier")
                              .withColumnRenamed("s_nationkey", "c_nationkey"), "c_nationkey")


# ------------------------------------------------------------------ JN ----

@query("jn4_code_lookup", """
SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def jn4(spark, sf):
    n = table(spark, sf, "nation")
    r = bounded_broadcast(table(spark, sf, "region"), 10_000)
    return n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")


@query("jn5_align_by_key", """
SELECT o.o_orderkey, o.o_totalprice AS actual, round(p.predicted, 6) AS predicted,
       round(o.o_totalprice - p.predicted, 6) AS residual
FROM orders o JOIN (SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS predicted
                    FROM lineitem GROUP BY l_orderkey) p ON o.o_orderkey = p.l_orderkey
""")
def jn5(spark, sf):
    """Predictions (rebuilt order totals) aligned with actuals on the key,
    never by position."""
    li = table(spark, sf, "lineitem")
    pred = li.groupBy("l_orderkey").agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("p"))
    o = table(spark, sf, "orders")
    j = o.join(pred, o.o_orderkey == pred.l_orderkey)
    return j.select("o_orderkey", F.col("o_totalprice").alias("actual"), R("p").alias("predicted"),
                    R(F.col("o_totalprice") - F.col("p")).alias("residual"))


def _customer_years(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    return c.select("c_custkey", F.explode(F.sequence(F.lit(1995), F.lit(2001))).alias("year"))


def _cached_customer_years(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year"))


_GRID_SQL = "(SELECT c_custkey, CAST(y AS INTEGER) AS year FROM customer, range(1995, 2002) t(y))"


@query("jn6_pending_keys", f"""
SELECT g.c_custkey, g.year FROM {_GRID_SQL} g
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = g.c_custkey AND year(o.o_orderdate) = g.year)
""")
def jn6a(spark, sf):
    """Requested (customer, year) keys that have no cached result yet: an
    anti join of the request grid against what already exists."""
    return _customer_years(spark, sf).join(_cached_customer_years(spark, sf),
                                           ["c_custkey", "year"], "left_anti")


@query("jn6_cached_keys", f"""
SELECT g.c_custkey, g.year FROM {_GRID_SQL} g
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = g.c_custkey AND year(o.o_orderdate) = g.year)
""")
def jn6b(spark, sf):
    """Requested keys served from the cache (semi join)."""
    return _customer_years(spark, sf).join(_cached_customer_years(spark, sf),
                                           ["c_custkey", "year"], "left_semi")


@query("jn7_keys_by_years", """
SELECT s_suppkey, CAST(y AS INTEGER) AS year FROM supplier, range(2019, 2024) t(y)
""")
def jn7(spark, sf):
    """Every supplier x every year of a given range (the loading grid).  The
    year range is a parameter, so each key row expands in place; no join."""
    s = table(spark, sf, "supplier").select("s_suppkey")
    return s.select("s_suppkey", F.explode(F.sequence(F.lit(2019), F.lit(2023))).alias("year"))
