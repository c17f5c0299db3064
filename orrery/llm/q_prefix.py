"""op11: trie of the prefixes of rebuilt conversations, with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.llm import prefix_trie
from orrery.llm.base import query, table

#: unsigned CRC-32 (reversed polynomial 0xEDB88320) of an ASCII string, in DuckDB
CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({0}) + 1), lambda i:
    CAST(ascii(substr({0}, CAST(i AS INT), 1)) AS BIGINT))), lambda acc, byte:
    list_reduce(list_prepend(xor(acc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, zero:
      xor(x >> 1, (x & 1) * 3988292384::BIGINT))), 4294967295::BIGINT)"""


@query("op11_prefix_trie", f"""
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT conv_id, count(*) AS n, CAST(conv_id AS VARCHAR) AS s FROM own GROUP BY conv_id),
crc AS (SELECT conv_id, n, conv_id - conv_id % 5 AS base, {CRC32.format('s')} % 9 AS h FROM ids),
convs AS (SELECT a.*, least(a.h, coalesce(b.n, 0)) AS taken FROM crc a LEFT JOIN crc b ON b.conv_id = a.base),
turns AS (
  SELECT c.conv_id, c.taken + o.pos - c.h AS pos, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.pos > c.h
  UNION ALL
  SELECT c.conv_id, o.pos, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.base AND o.pos <= c.taken),
steps AS (
  SELECT conv_id, pos AS depth, CAST(strlen(text) AS BIGINT) AS bytes,
         string_agg(md5(md5(role) || md5(text)), '' ORDER BY pos) OVER (PARTITION BY conv_id ORDER BY pos) AS prefix FROM turns
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
paths AS (
  SELECT conv_id, depth, bytes, prefix, lag(prefix) OVER w AS parent, lead(prefix) OVER w AS child
  FROM steps WINDOW w AS (PARTITION BY conv_id ORDER BY depth)),
nodes AS (
  SELECT prefix, min(conv_id) AS conv_id, min(depth) AS depth, min(parent) AS parent, count(*) AS n_convs, min(bytes) AS bytes,
         count(DISTINCT child) AS n_children,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE child IS NULL), '')) AS ends_sha256
  FROM paths GROUP BY prefix),
-- every node lies on the path of its smallest member
below AS (
  SELECT a.prefix, count(*) FILTER (WHERE n.n_children = 0) AS n_leaves, sum((n.n_convs - 1) * n.bytes) AS saved
  FROM paths a JOIN nodes n ON n.conv_id = a.conv_id AND n.depth >= a.depth GROUP BY a.prefix)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
       b.n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.prefix = n.prefix LEFT JOIN nodes p ON p.prefix = n.parent
""")
def op11_prefix_trie(spark, sf):
    turns = prefix_trie.ordered_turns(table(spark, sf, "conversations").select("conv_id", "turn", "role", "text"))
    conv = F.col("conv_id")
    turns, convs = prefix_trie.rebuilt(turns, conv - conv % 5, (F.crc32(conv.cast("string")) % 9).cast("long"))
    nodes, ends = prefix_trie.prefix_trie(turns, convs)
    none = F.sha2(F.lit(""), 256)
    return (nodes.join(prefix_trie.ends_digest(ends), prefix_trie.NODE, "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", none).alias("ends_sha256")))
