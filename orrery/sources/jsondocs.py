"""JSON sources (SRC-8) and JSON documents derived from the tables.

Reading: ``read_json_documents`` reads multi-line JSON files;
``parse_json`` / ``parse_double_encoded`` decode string columns with an
explicit schema (no inference pass over the data).

Deriving: API-style response documents are built from ``orders`` and
``lineitem`` with ``to_json`` - one document per page of a (customer, year), each
order holding its line items (at most a handful per order) - and per-user
statistics documents from ``events``, double-encoded like a cached API
reply that stored JSON text inside a JSON string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.operators.splits import group_index

ORDER_DOC_SCHEMA = """
get string, parameters struct<customer: bigint, season: int>, errors array<string>,
results int, paging struct<current: int, total: int>,
response array<struct<
  order: struct<id: bigint, status: string, priority: string, total: double, date: string>,
  customer: struct<id: bigint, name: string, segment: string>,
  country: struct<name: string>,
  lines: array<struct<line: int, qty: double, price: double, flag: string>>,
  stats: struct<lines: struct<total: bigint, returned: bigint, accepted: bigint, open: bigint, shipped: bigint>,
                qty: struct<total: double, min: double, max: double>, price: struct<total: double, min: double, max: double>,
                discount: struct<min: double, max: double>, tax: struct<min: double, max: double>,
                ship: struct<first: string, last: string>>,
  seasons: array<struct<year: int>>>>
"""

STATS_DOC_SCHEMA = """
statistics struct<splits: struct<categories: array<struct<
  name: string,
  stats: array<struct<displayName: string, displayValue: string, perGameDisplayValue: string,
                      rankDisplayValue: string, description: string>>>>>>
"""


def read_json_documents(spark: SparkSession, path: str, schema: str | None = None,
                        multi_line: bool = True) -> DataFrame:
    """SRC-8: JSON files with an explicit schema; one document per file
    (``multi_line``) or per line."""
    r = spark.read.option("multiLine", multi_line)
    if schema:
        r = r.schema(schema)
    return r.json(path)


def parse_json(c, schema: str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.from_json(col, schema)


def double_encode(c) -> Column:
    """JSON text -> a JSON string literal holding that text."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract(F.to_json(F.struct(col.alias("s"))), '^\\{"s":(.*)\\}$', 1)


def parse_double_encoded(c, schema: str) -> Column:
    """SRC-8 double-encoded: a JSON string literal whose content is JSON.
    A bare string root is not accepted by ``from_json``, so the literal is
    wrapped as ``{"s": ...}``, decoded to text, then decoded again."""
    col = F.col(c) if isinstance(c, str) else c
    inner = F.from_json(F.concat(F.lit('{"s":'), col, F.lit("}")), "s string")["s"]
    return F.from_json(inner, schema)


#: orders on one page of a response, as the API pages them: a document (one
#: row, one task) does not grow with a hot customer
PAGE_ORDERS = 2


def _line_stats() -> Column:
    """The nested statistics of an order's lines."""
    count = lambda c, v: F.count_if(F.col(c) == v)
    ends = lambda c: [F.min(c).alias("min"), F.max(c).alias("max")]
    total = lambda c: F.round(F.sum(c), 2).alias("total")
    day = lambda f: F.date_format(f("l_shipdate"), "yyyy-MM-dd")
    return F.struct(
        F.struct(F.count(F.lit(1)).alias("total"), count("l_returnflag", "R").alias("returned"), count("l_returnflag", "A").alias("accepted"),
                 count("l_linestatus", "O").alias("open"), count("l_linestatus", "F").alias("shipped")).alias("lines"),
        F.struct(total("l_quantity"), *ends("l_quantity")).alias("qty"),
        F.struct(total("l_extendedprice"), *ends("l_extendedprice")).alias("price"),
        F.struct(*ends("l_discount")).alias("discount"), F.struct(*ends("l_tax")).alias("tax"),
        F.struct(day(F.min).alias("first"), day(F.max).alias("last")).alias("ship"))


def order_documents(orders: DataFrame, lineitem: DataFrame, customer: DataFrame,
                    nation: DataFrame, stats: bool = False) -> DataFrame:
    """(customer, season, page, json) API-style documents, one per page of
    ``PAGE_ORDERS`` orders of a customer and year, in order-key order.
    ``results`` and ``paging.total`` count all pages; ``stats`` adds the
    nested statistics of each order's lines.  Orders are numbered
    by a distributed rank, so a customer with a third of all orders is no
    single group; an order without a customer or nation row keeps NULLs."""
    lines = lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(
        F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("qty"),
        F.col("l_extendedprice").alias("price"), F.col("l_returnflag").alias("flag")))).alias("lines"),
        *([_line_stats().alias("stats")] if stats else []))
    cust = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left").select(
        "c_custkey", "c_name", "c_mktsegment", "n_name")
    listed = orders.withColumn("season", F.year("o_orderdate"))
    keys = listed.select("o_custkey", "season", "o_orderkey")
    place = group_index(keys, ["o_custkey", "season"], [F.col("o_orderkey")], "_rank").select(
        F.col("o_orderkey").alias("_ok"), F.expr(f"_rank div {PAGE_ORDERS}").cast("int").alias("_page"))
    many = keys.groupBy(F.col("o_custkey").alias("_c"), F.col("season").alias("_s")).agg(
        F.count("*").cast("int").alias("_results"))
    o = (listed.join(place, F.col("o_orderkey") == F.col("_ok"))
               .join(many, F.col("o_custkey").eqNullSafe(F.col("_c")) & F.col("season").eqNullSafe(F.col("_s")))
               .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
               .join(cust, F.col("o_custkey") == F.col("c_custkey"), "left"))
    entry = F.struct(
        F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"),
                 F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("total"),
                 F.date_format("o_orderdate", "yyyy-MM-dd").alias("date")).alias("order"),
        F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                 F.col("c_mktsegment").alias("segment")).alias("customer"),
        F.struct(F.col("n_name").alias("name")).alias("country"),
        F.coalesce(F.col("lines"), F.array().cast(
            "array<struct<line:int,qty:double,price:double,flag:string>>")).alias("lines"),
        *([F.col("stats")] if stats else []),
        F.array(F.struct(F.col("season").alias("year"))).alias("seasons"))
    docs = o.groupBy("o_custkey", "season", F.col("_page").alias("page"), F.col("_results").alias("results")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("o_orderkey").alias("_k"), entry.alias("_e")))).alias("_r"))
    resp = F.transform("_r", lambda s: s["_e"])
    doc = F.struct(
        F.lit("orders").alias("get"),
        F.struct(F.col("o_custkey").alias("customer"), F.col("season").alias("season")).alias("parameters"),
        F.array().cast("array<string>").alias("errors"),
        F.col("results").alias("results"),
        F.struct((F.col("page") + 1).alias("current"),
                 F.ceil(F.col("results") / PAGE_ORDERS).cast("int").alias("total")).alias("paging"),
        resp.alias("response"))
    return docs.select(F.col("o_custkey").alias("customer"), "season", "page", F.to_json(doc).alias("json"))


def _cents(x):
    """Round half up to 2 decimals before formatting; ``%.2f`` itself
    rounds ties differently from one formatter to the next."""
    return F.floor(x * 100 + 0.5) / 100


def stats_documents(events: DataFrame) -> DataFrame:
    """(user_id, payload) per-user statistics documents, double-encoded.
    Optional keys are left out where they have no value (``to_json`` drops
    NULL fields): ``rankDisplayValue`` only with at least 15 events,
    ``perGameDisplayValue`` only for purchases, ``description`` never."""
    g = events.groupBy("user_id", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    stat = F.array(
        F.struct(F.lit("events").alias("displayName"), F.col("n").cast("string").alias("displayValue"),
                 F.lit(None).cast("string").alias("perGameDisplayValue"),
                 F.when(F.col("n") >= 15, F.format_string("#%d", (F.col("n") / 5).cast("int")))
                  .alias("rankDisplayValue")),
        F.struct(F.lit("value").alias("displayName"),
                 F.format_string("%.2f", _cents(F.col("total"))).alias("displayValue"),
                 F.when(F.col("event_type") == "purchase",
                        F.format_string("%.2f", _cents(F.col("total") / F.col("n")))).alias("perGameDisplayValue"),
                 F.lit(None).cast("string").alias("rankDisplayValue")))
    cat = F.struct(F.col("event_type").alias("name"), stat.alias("stats"))
    per_user = g.groupBy("user_id").agg(
        F.array_sort(F.collect_list(cat)).alias("categories"))
    doc = F.struct(F.struct(F.struct(F.col("categories").alias("categories")).alias("splits")).alias("statistics"))
    return per_user.select("user_id", double_encode(F.to_json(doc)).alias("payload"))
