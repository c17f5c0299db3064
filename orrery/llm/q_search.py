"""op5 and op6: exact top-k search and the WARC round trip."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.llm import topk, warc
from orrery.llm.base import query, table


@query("op5_topk", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 5
""")
def op5_topk(spark, sf):
    v = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), topk.quantised(F.col("embedding"), 256).alias("v"))
    return topk.top_k(v.filter(F.col("id") % 50 == 0), v, k=5).withColumnRenamed("id", "vec_id")


@query("op6_warc", """
WITH d AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n, sha1(coalesce(html, '')) AS x FROM pages),
b AS (SELECT page_id, n, x, array_to_string(list_transform(list_transform(range(8), lambda g:
             CAST('0x' || substr(x, g * 5 + 1, 5) AS BIGINT)), lambda v:
             substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> 15) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> 10) % 32 + 1, 1)
             || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> 5) % 32 + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', v % 32 + 1, 1)), '') AS digest,
             max(page_id) OVER (PARTITION BY x) AS top FROM d)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM b
""")
def op6_warc(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    root = warc.archive_folder(spark)
    captures = warc.write_archives(pages, root, min_bytes=0)
    level = warc.write_index(captures, root)
    return warc.look_up(captures, level).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
