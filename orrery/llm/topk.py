"""Exact top-k search by inner product.

Queries are dealt into blocks and vectors into shards; each (block, shard)
tile is one matrix product, from which every query keeps its ``k`` best
(partial selection), so a tile emits at most block x k rows.  The tiles'
short lists are merged as a tree: ``fan_in`` lists at a time until one per
query is left.  Tile sides are bounded, so memory does not grow with the
tables; blocks and shards are dealt by a hash of the whole row, so equal
vectors or ids do not gather in one tile.

Products are exact integers: a tile uses floating-point matrix products
when its largest possible score is below 2^53 and integers otherwise.

Defined results: vectors that are null or hold null or non-finite
components take no part; vectors of unequal lengths are no candidates of
each other (an empty vector scores 0 with empty ones); a query's own row is
the row of the same id (repeated rows of that id included); equal scores go
to the smaller id, null ids last; a query with fewer than k candidates gets
all; an empty table gives no rows; columns other than id and v are ignored; repeated equal query rows give one list; a score beyond the range of a
long is given as that range's end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.base import shuffle_partitions

SHARD_ROWS = (2048, 65536)
BLOCK_ROWS = (8192, 65536)
#: a block's components, as they are sent
BLOCK_BYTES = 32 << 20
FAN_IN = 64
CELLS = 4_000_000


def quantised(vec: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as a long; null where the vector
    takes no part."""
    usable = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(usable, F.transform(vec, lambda x: F.floor(x.cast("double") * float(scale)).cast("long")))


def _tile_kernel(k: int, cells: int):
    """Cogroup kernel: Arrow tables (id, qv, v) and (rid, rv) of one tile."""
    def run(key, left, right):
        import numpy as np
        import pyarrow as pa

        def matrix(t, name):
            col = t.column(name).combine_chunks()
            flat = col.flatten().to_numpy(zero_copy_only=False)
            return flat.reshape(len(col), -1)

        empty = pa.table({"query_id": pa.array([], pa.int64()), "qv": pa.array([], pa.int64()),
                          "tile": pa.array([], pa.int64()), "id": pa.array([], pa.int64()),
                          "score": pa.array([], pa.int64())})
        if left.num_rows == 0 or right.num_rows == 0:
            return empty
        ids = right.column("rid").combine_chunks()
        null = ids.is_null().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(2**63 - 1).to_numpy()
        order = np.lexsort((null, ids))
        ids, null, vecs = ids[order], null[order], matrix(right, "rv")[order]
        qid, qv, qs = left.column("id").to_numpy(), left.column("qv").to_numpy(), matrix(left, "v")
        top = float(np.abs(vecs.astype(np.float64)).max(initial=0)) * float(np.abs(qs.astype(np.float64)).max(initial=0))
        fast = top * max(1, vecs.shape[1]) < 2.0**53
        small = top * max(1, vecs.shape[1]) < 2.0**62
        kind = np.float64 if fast else np.int64 if small else object
        vt, none = vecs.astype(kind).T, (-np.inf if fast else -2**63 if small else -10**50)
        out = []
        step = max(1, cells // len(ids))
        for a in range(0, len(qid), step):
            s = qs[a:a + step].astype(kind) @ vt
            if vecs.shape[1] == 0:
                s = np.zeros((len(qs[a:a + step]), len(ids)), dtype=kind)
            lo, hi = np.searchsorted(ids, qid[a:a + step], "left"), np.searchsorted(ids, qid[a:a + step], "right")
            for r in np.nonzero(hi > lo)[0]:
                own = np.arange(lo[r], hi[r])
                s[r, own[~null[own]]] = none
            n = s.shape[1]
            cut = np.partition(s, n - k, axis=1)[:, n - k] if n > k else s.min(axis=1)
            row, col = np.nonzero((s >= cut[:, None]) & (s != none))
            val = s[row, col]
            by = np.lexsort((col, -val, row))
            row, col, val = row[by], col[by], val[by]
            first = np.searchsorted(row, row, "left")
            keep = np.arange(len(row)) - first < k
            row, col, val = row[keep], col[keep], val[keep]
            if kind is object:
                val = np.array([min(max(int(v), -2**63), 2**63 - 1) for v in val], dtype=np.int64)
            out.append(pa.table({
                "query_id": pa.array(qid[a + row], pa.int64()), "qv": pa.array(qv[a + row], pa.int64()),
                "tile": pa.array(np.full(len(row), key[2].as_py()), pa.int64()),
                "id": pa.array(ids[col], pa.int64(), mask=null[col]),
                "score": pa.array(val.astype(np.int64), pa.int64())}))
        return pa.concat_tables(out) if out else empty
    return run


def _shape(rows: DataFrame):
    """Rows, components of the longest vector, and the bytes (2, 4 or 8) that
    every component fits into."""
    # -(x + 1) of a negative x does not overflow
    size = F.greatest(F.array_max("v"), -(F.array_min("v") + 1))
    r = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d"), F.max(size).alias("m")).first()
    return r["n"], r["d"] or 0, 2 if (r["m"] or 0) < 1 << 15 else 4 if r["m"] < 1 << 31 else 8


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 5, shard_rows: int | None = None,
          block_rows: int | None = None, fan_in: int = FAN_IN, cells: int = CELLS) -> DataFrame:
    """``queries`` and ``vectors``: (id long, v array<long>).  Returns
    (query_id, rank, id, score).

    Every vector is sent once for each block of queries, so blocks are as
    large as memory allows and components as narrow as they are."""
    spark = vectors.sparkSession
    q = queries.filter("id is not null and v is not null").select("id", "v").distinct()
    v = vectors.filter("v is not null").select("id", "v")
    (n, _, wide), (m, q_dims, q_wide) = _shape(v), _shape(q)
    if shard_rows is None:
        shard_rows = min(SHARD_ROWS[1], max(SHARD_ROWS[0], n // (2 * shuffle_partitions(spark))))
    if block_rows is None:
        block_rows = min(BLOCK_ROWS[1], max(BLOCK_ROWS[0], m // (2 * shuffle_partitions(spark))),
                         max(1, BLOCK_BYTES // max(1, q_dims * q_wide)))
    sent = lambda width: "array<%s>" % {2: "smallint", 4: "int", 8: "bigint"}[width]
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-m // block_rows))
    q = (q.withColumn("qv", F.xxhash64("v")).withColumn("dim", F.size("v")).withColumn("v", F.col("v").cast(sent(q_wide)))
         .withColumn("block", F.pmod(F.xxhash64("id", "qv"), F.lit(blocks)))
         .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))))
    # names of its own for this side: both may come from one table
    v = (v.select(F.col("id").alias("rid"), F.col("v").cast(sent(wide)).alias("rv"), F.size("v").alias("rdim"),
                  F.pmod(F.xxhash64("id", "v"), F.lit(shards)).alias("rshard"))
         .withColumn("rblock", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))))
    found = (q.groupBy("dim", "block", "shard").cogroup(v.groupBy("rdim", "rblock", "rshard"))
             .applyInArrow(_tile_kernel(k, cells), "query_id long, qv long, tile long, id long, score long"))
    best = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    while shards > fan_in:
        found = found.withColumn("tile", F.floor(F.col("tile") / fan_in))
        near = Window.partitionBy("query_id", "qv", "tile").orderBy(*best)
        found = found.withColumn("rank", F.row_number().over(near)).filter(F.col("rank") <= k).drop("rank")
        shards = -(-shards // fan_in)
    near = Window.partitionBy("query_id", "qv").orderBy(*best)
    return (found.withColumn("rank", F.row_number().over(near)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "id", "score"))
