"""Sources and sinks: files written from the given tables,
read back through the reader under test, compared with the table itself.

Each query writes its input files under the session's checkpoint folder
(shared storage on a cluster), so the amount of work grows with the
tables."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from orrery.plans.registry import query
from orrery.sources import files as FS
from orrery.sources import images as IM
from orrery.sources import synthetic as SY
from orrery.sources.tables import table


def R(c, d: int = 6):
    return F.round(F.col(c) if isinstance(c, str) else c, d)


# ---------------------------------------------------------------- SRC-1 --

@query("src1_csv_header", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
""")
def src1(spark, sf):
    """CSV with a header line, read with an explicit schema."""
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    path = FS.write_csv(c, FS.scratch_path(spark, "src1"), header=True)
    return FS.read_csv(spark, path, "c_custkey long, c_name string, c_nationkey int, "
                                    "c_acctbal double, c_mktsegment string", header=True)


@query("src1_csv_inferred", """
SELECT count(*) AS n_rows, 'int' AS t_key, 'double' AS t_balance, 'string' AS t_name
FROM customer
""")
def src1_inferred(spark, sf):
    """Exploration path: types inferred from the CSV text."""
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    path = FS.write_csv(c, FS.scratch_path(spark, "src1i"), header=True)
    df = FS.read_csv(spark, path, None, header=True)
    types = dict(df.dtypes)
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(types["c_custkey"]).alias("t_key"),
        F.lit(types["c_acctbal"]).alias("t_balance"), F.lit(types["c_name"]).alias("t_name"))


# ---------------------------------------------------------------- SRC-2 --

@query("src2_csv_null_token", """
SELECT p_partkey, p_brand, CASE WHEN p_size > 40 THEN NULL ELSE p_size END AS p_size, p_retailprice
FROM part
""")
def src2(spark, sf):
    """Headerless CSV, names given by the reader, ``?`` marks a missing
    value (sizes above 40 are written as missing)."""
    p = table(spark, sf, "part").select(
        "p_partkey", "p_brand", F.when(F.col("p_size") <= 40, F.col("p_size")).alias("p_size"), "p_retailprice")
    path = FS.write_csv(p, FS.scratch_path(spark, "src2"), header=False, null_value="?")
    return FS.read_csv(spark, path, "p_partkey long, p_brand string, p_size int, p_retailprice double",
                       header=False, null_value="?")


# ---------------------------------------------------------------- SRC-3 --

@query("src3_gzip_csv_target_last", """
SELECT l_orderkey, l_linenumber,
       [l_quantity, l_extendedprice, l_discount, l_tax] AS features,
       l_returnflag AS target
FROM lineitem
""")
def src3(spark, sf):
    """Gzip CSV without header; the last column is the target, the others
    (after the two key columns) the features.  Gzip is not splittable: the
    rows are spread over the shuffle partitions after the read."""
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
    path = FS.write_csv(li, FS.scratch_path(spark, "src3"), header=False, compression="gzip")
    df = FS.read_csv(spark, path, "l_orderkey long, l_linenumber int, l_quantity double, "
                                  "l_extendedprice double, l_discount double, l_tax double, l_returnflag string",
                     header=False, min_partitions=int(spark.conf.get("spark.sql.shuffle.partitions")))
    return FS.split_target(df, -1, keep=2)


# ---------------------------------------------------------------- SRC-4 --

_DIMS = 64


@query("src4_numeric_matrix", """
SELECT CAST(label AS DOUBLE) AS label,
       CAST(embedding AS DOUBLE[]) AS features
FROM embeddings
""")
def src4(spark, sf):
    """All-numeric matrix file, header skipped, label in the first column:
    every column read as double, the rest gathered into one array."""
    e = table(spark, sf, "embeddings")
    cols = [F.col("label").cast("double").alias("label")] + \
        [F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(_DIMS)]
    path = FS.write_csv(e.select(*cols), FS.scratch_path(spark, "src4"), header=True)
    schema = ", ".join(["label double"] + [f"e{i} double" for i in range(_DIMS)])
    m = FS.read_csv(spark, path, schema, header=True)
    return m.select("label", F.array(*[f"e{i}" for i in range(_DIMS)]).alias("features"))


# ---------------------------------------------------------------- SRC-5 --

@query("src5_xy_text", """
SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem
""")
def src5(spark, sf):
    """Two-column ``x,y`` text with a header line."""
    li = table(spark, sf, "lineitem").select(F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"))
    path = FS.write_csv(li, FS.scratch_path(spark, "src5"), header=True)
    return FS.read_csv(spark, path, "x double, y double", header=True)


# ---------------------------------------------------------------- SRC-6 --

@query("src6_label_from_file_name", """
SELECT d.doc_id, l.quality AS label, length(d.text) AS n_chars, md5(d.text) AS text_md5
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
""")
def src6(spark, sf):
    """Labelled documents stored under paths named ``<doc_id>_<quality>``,
    packed; id and label are parsed from the path."""
    d = table(spark, sf, "documents").select("doc_id", "text")
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    named = d.join(lab, "doc_id").select(
        F.concat_ws("_", F.col("doc_id").cast("string"), F.col("quality").cast("string")).alias("fname"), "text")
    path = FS.write_packed(named, FS.scratch_path(spark, "src6"), "fname", "text")
    got = FS.read_packed(spark, path, r"name=(\d+)_(\d+)/", {"doc_id": 1, "label": 2})
    return got.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"),
                      F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5"))


# ---------------------------------------------------------------- SRC-9 --

@query("src9_stored_pages", """
SELECT page_id, length(html) AS n_chars, md5(html) AS html_md5 FROM pages
""")
def src9(spark, sf):
    """Stored HTML pages, packed, id parsed from the path."""
    p = table(spark, sf, "pages").select("page_id", "html")
    path = FS.write_packed(p, FS.scratch_path(spark, "src9"), "page_id", "html")
    got = FS.read_packed(spark, path, r"name=(\d+)/", {"page_id": 1})
    return got.select(F.col("page_id").cast("long").alias("page_id"),
                      F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("html_md5"))


# --------------------------------------------------------------- SRC-10 --

_CH_SQL = """
WITH v AS (
  SELECT vec_id, i - 1 AS pixel,
         CAST(floor((CAST(embedding[i] AS DOUBLE) + 1) * 127.5) AS INTEGER) AS q
  FROM embeddings, range(1, 65) t(i)
), c AS (
  SELECT vec_id, pixel, least(greatest(q, 0), 255) AS r FROM v
)
"""


@query("src10_pixel_rows", _CH_SQL + """
SELECT CAST(vec_id AS VARCHAR) AS origin, pixel, CAST(pixel // 8 AS INTEGER) AS y,
       CAST(pixel % 8 AS INTEGER) AS x, CAST(r AS SMALLINT) AS r,
       CAST(255 - r AS SMALLINT) AS g, CAST((r * 7) % 256 AS SMALLINT) AS b
FROM c
""")
def src10(spark, sf):
    """Every embedding as an 8 x 8 RGB image in the image-source layout
    (red = scaled value, green = 255 - red, blue = 7 * red mod 256), then
    decoded into (h * w) pixel rows, row after row."""
    e = table(spark, sf, "embeddings")
    red = F.transform("embedding", lambda v: F.least(F.greatest(
        F.floor((v.cast("double") + 1) * 127.5).cast("int"), F.lit(0)), F.lit(255)))
    e = e.select("vec_id", red.alias("red"))
    img = IM.image_from_channels(F.col("vec_id").cast("string"), 8, 8, F.col("red"),
                                 F.transform("red", lambda r: 255 - r),
                                 F.transform("red", lambda r: (r * 7) % 256))
    return IM.pixel_rows(e.select(img.alias("image")))


# --------------------------------------------------------------- SRC-11 --

def _points_sql() -> str:
    u = lambda stream, key="id": SY.uniform_sql(key, 7, str(stream))
    n = lambda stream: SY.normal_sql("id", 7, str(stream))
    pi = f"{math.pi!r}::DOUBLE"
    blob = [f"-10 + 20 * {u(1000 + j, '(-1 - label)')} + {n(10 + j)}" for j in (0, 1)]
    return f"""
WITH c AS (SELECT c_custkey AS id, CAST(least(floor({u(1)} * 3), 2) AS INT) AS third, CASE WHEN {u(1)} >= 0.5 THEN 1 ELSE 0 END AS half,
                  {u(2)} AS t FROM customer),
p AS (
  SELECT 'blobs' AS kind, id, label, {blob[0]} AS x0, {blob[1]} AS x1 FROM (SELECT id, third AS label FROM c) b
  UNION ALL SELECT 'outlier', -1, -1, 25.0, 25.0
  UNION ALL SELECT 'circles', id, half, (1 - 0.5 * half) * cos(2 * {pi} * t) + 0.05 * {n(3)}, (1 - 0.5 * half) * sin(2 * {pi} * t) + 0.05 * {n(4)} FROM c
  UNION ALL SELECT 'moons', id, half, CASE WHEN half = 0 THEN cos({pi} * t) ELSE 1 - cos({pi} * t) END + 0.05 * {n(3)},
                   CASE WHEN half = 0 THEN sin({pi} * t) ELSE 0.5 - sin({pi} * t) END + 0.05 * {n(4)} FROM c
  UNION ALL SELECT 'separable', id, half, {n(10)} + 4.0 * half, {n(11)} + 4.0 * half FROM c)
SELECT kind, id, label, round(x0, 6) AS x0, round(x1, 6) AS x1 FROM p
"""


@query("src11_point_sets", _points_sql())
def src11(spark, sf):
    """Seeded point sets keyed by customer: 3 Gaussian blobs, circles
    (factor 0.5), moons, two separable classes, and one outlier."""
    c = table(spark, sf, "customer").select("c_custkey")
    b = SY.with_outlier(SY.blobs(c, "c_custkey", 3, 2, 1.0, seed=7), [25.0, 25.0])
    parts = [b.withColumn("kind", F.when(F.col("id") == -1, "outlier").otherwise("blobs")),
             SY.circles(c, "c_custkey", 0.5, 0.05, seed=7).withColumn("kind", F.lit("circles")),
             SY.moons(c, "c_custkey", 0.05, seed=7).withColumn("kind", F.lit("moons")),
             SY.separable(c, "c_custkey", 2, 4.0, seed=7).withColumn("kind", F.lit("separable"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("kind", "id", "label", R(F.col("x")[0]).alias("x0"), R(F.col("x")[1]).alias("x1"))


# ---------------------------------------------------------------- SNK-1 --

@query("snk1_csv_append_roundtrip", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
""")
def snk1(spark, sf):
    """Delimited output in two writes, the second appended: finished
    orders first, then the others; the folder read back holds all."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    path = FS.scratch_path(spark, "snk1")
    FS.write_csv(o.filter(F.col("o_orderstatus") == "F"), path, header=True)
    FS.write_csv(o.filter((F.col("o_orderstatus") != "F") | F.col("o_orderstatus").isNull()), path,
                 header=True, mode="append")
    return FS.read_csv(spark, path, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double")


# ---------------------------------------------------------------- SNK-2 --

@query("snk2_json_roundtrip", """
SELECT l_orderkey, l_linenumber, l_returnflag, [l_quantity, l_extendedprice] AS amounts FROM lineitem
""")
def snk2(spark, sf):
    """JSON documents with a nested key struct and an array, written one
    per line and read back with a schema."""
    li = table(spark, sf, "lineitem")
    docs = li.select(F.struct(F.col("l_orderkey").alias("order"), F.col("l_linenumber").alias("line")).alias("key"),
                     F.col("l_returnflag").alias("flag"),
                     F.array("l_quantity", "l_extendedprice").alias("amounts"))
    path = FS.write_json(docs, FS.scratch_path(spark, "snk2"))
    back = FS.read_json(spark, path, "key struct<order:long, line:int>, flag string, amounts array<double>")
    return back.select(F.col("key.order").alias("l_orderkey"), F.col("key.line").alias("l_linenumber"),
                       F.col("flag").alias("l_returnflag"), "amounts")
