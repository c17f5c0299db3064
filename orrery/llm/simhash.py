"""SimHash near-duplicates found by Golay-code fuzzy hashing.

Fingerprint: XXH64 (seed 42) of every shingle of ``n`` words (ASCII lower
case, joined by single spaces, repeats included); a bit is 1 if it is set
in more than half of the hashes.

Candidates: the 64 bits are cut into three segments of 22, 21 and 21 bits,
read as 23-bit words of the binary Golay code.  The code is perfect: every
word lies within 3 bits of exactly one codeword, whose 12-bit index is the
word's *own* key; the indices of its 23 neighbours' codewords (six keys at
most, usually) are its *near* keys.  Words at distance 1 have the own key of
each among the near keys of the other; words at distance 2 share a near key
(their midpoint's).  Two fingerprints within 4 bits leave, besides their
worst segment, two segments with 0 + 0, 0 + 1, 1 + 1 or 0 + 2 wrong bits:

* both at most 1 (own key of one x near key of the other, either way), or
* 2 + 2 + 0: one segment is equal and the next one is 2 bits off, so the
  equal bits themselves with the next one's near keys.

That is the pigeonhole rule for ``max_bits`` = 4 (smaller limits use the same
keys).  Rows that meet in a key are compared bit by bit.

Verifying never lists pairs.  Distinct fingerprints are the nodes; within a
key a search from node to node over the not yet reached ones emits one edge
for each node reached, a spanning forest of the links among that key's
fingerprints.  Every link lies within some key's forest, so the connected
components of all forests are those of all links.  Keys with more than
``group`` fingerprints are not searched in one task: their rows are dealt to
all pairs of salted parts, and each pair of parts is searched alone.

Defined results: null text is empty; texts without words have fingerprint
zero, which links like any other; fewer than ``n`` words are one shingle;
repeated rows are members of one component; a null doc_id is never a
component's smallest id unless it has no other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.base import cut_lineage, quoted, shuffle_partitions, text_or_empty
from orrery.operators.dbscan import connected_components

SHINGLE = 4
MAX_BITS = 4
GROUP = 20_000
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, bits
#: generator polynomial of the binary Golay code: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
GOLAY = 0b110001110101


def _hash_kernel(n: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh64_intdigest

        def fingerprint(text: str) -> int:
            # bytes.lower and bytes.split know ASCII only: A-Z, and the six white-space characters
            w = text.encode().lower().split()
            if not w:
                return 0
            joined = b" ".join(w)
            if len(w) <= n:
                return xxh64_intdigest(joined, 42)
            size = np.fromiter(map(len, w), np.int64, len(w)) + 1
            end = np.cumsum(size)
            starts, ends = (end - size)[:len(w) - n + 1].tolist(), (end[n - 1:] - 1).tolist()
            total = np.zeros(64, np.int64)
            for a in range(0, len(starts), 65536):  # a long text is counted in blocks
                h = np.array([xxh64_intdigest(joined[i:j], 42) for i, j in zip(starts[a:a + 65536], ends[a:a + 65536])],
                             np.uint64)
                bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                total += bits.sum(axis=0, dtype=np.int64)
            on = 2 * total > len(starts)
            return int(np.packbits(on, bitorder="little").view(np.uint64)[0])

        for b in batches:
            f = np.array([fingerprint(t) for t in b.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("t"), pa.array(f, pa.int64())],
                                             names=["doc_id", "t", "f"])
    return run


def fingerprints(docs: DataFrame, n: int = SHINGLE) -> DataFrame:
    """(doc_id, t, f): ``f`` is the 64-bit fingerprint of a row's whole text,
    as a long; ``t`` (XXH64 of the text) tells rows of one id apart."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"),
                       F.xxhash64(text_or_empty()).alias("t"))
    return rows.mapInArrow(_hash_kernel(n), "doc_id long, t long, f long")


def hex_digits(f: Column) -> Column:
    return F.lpad(F.lower(F.hex(f)), 16, "0")


def golay_tables():
    """``own``: codeword index of each 23-bit word; ``syndromes`` of the code."""
    import numpy as np

    def remainder(words):
        r = words.copy()
        for bit in range(22, 10, -1):
            r ^= np.where((r >> bit) & 1, GOLAY << (bit - 11), 0)
        return r

    one = 1 << np.arange(23)
    errors = [np.zeros(1, np.int64), one, (one[:, None] | one)[np.triu_indices(23, 1)]]
    errors.append(np.unique([a | b for a in errors[2].tolist() for b in one.tolist() if not a & b]))
    flat = np.concatenate(errors).astype(np.int64)
    leader = np.zeros(2048, np.int64)  # the error pattern of every remainder: 1 + 23 + 253 + 1771 = 2048
    leader[remainder(flat)] = flat
    return remainder, leader


def _keys_kernel():
    """Distinct fingerprints -> (key, f), all keys of each."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        remainder, leader = golay_tables()

        def index(words):  # 12-bit index of the codeword around each word
            return (words ^ leader[remainder(words)]) >> 11

        flips = np.concatenate([[0], 1 << np.arange(23)]).astype(np.int64)
        for b in batches:
            f = b.column("f").to_numpy()
            u = f.view(np.uint64)
            seg = [((u >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in SEGMENTS]
            own = [index(s) for s in seg]
            near = [np.sort(index((s[:, None] ^ flips).ravel()).reshape(-1, 24), axis=1) for s in seg]
            fresh = [np.concatenate([np.ones((len(x), 1), bool), x[:, 1:] != x[:, :-1]], axis=1) for x in near]
            keys, rows = [], []
            for kind, (i, j) in enumerate(((0, 1), (1, 2), (2, 0))):
                # own of i with near of j; near of i with own of j, but for the pair already there
                r, c = np.nonzero(fresh[j])
                keys.append((own[i][r] << 12 | near[j][r, c]) << 3 | kind)
                rows.append(r)
                r, c = np.nonzero(fresh[i] & (near[i] != own[i][:, None]))
                keys.append((near[i][r, c] << 12 | own[j][r]) << 3 | kind)
                rows.append(r)
                # i itself with near of j
                r, c = np.nonzero(fresh[j])
                keys.append((seg[i][r] << 12 | near[j][r, c]) << 3 | (kind + 3))
                rows.append(r)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(f[np.concatenate(rows)])],
                                             names=["key", "f"])
    return run


def forest(f, max_bits: int, side=None):
    """Edges of a spanning forest of the links within ``max_bits`` among
    distinct fingerprints.  With ``side`` (booleans) links between the two
    sides count too, as do those within each."""
    import numpy as np
    src, dst = [], []
    left = f.view(np.uint64).copy()
    while len(left) > 1:
        queue, left = [left[:1]], left[1:]
        while queue and len(left):
            x = queue.pop()
            for a in range(len(x)):
                hit = np.bitwise_count(left ^ x[a]) <= max_bits
                if hit.any():
                    got = left[hit]
                    src.append(np.full(len(got), x[a]))
                    dst.append(got)
                    queue.append(got)
                    left = left[~hit]
                    if not len(left):
                        break
    if not src:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(src).view(np.int64), np.concatenate(dst).view(np.int64)


def _search_kernel(max_bits: int, group: int):
    """Rows (key, f) sorted by key -> edges (src, dst, null); rows of a key
    with more than ``group`` fingerprints -> (f, null, key), to be dealt."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        def batch(src, dst, key, large):
            return pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64()),
                                               pa.array(key, pa.int64()), pa.array(large, pa.bool_())],
                                              names=["src", "dst", "key", "large"])

        def edges(key, f):
            ends = np.flatnonzero(np.diff(key)) + 1
            out = []
            starts, stops = np.concatenate([[0], ends]), np.concatenate([ends, [len(key)]])
            size = stops - starts
            two = size == 2  # most keys that are shared at all are shared by two
            a, b = f[starts[two]], f[starts[two] + 1]
            hit = np.bitwise_count((a ^ b).view(np.uint64)) <= max_bits
            out.append((a[hit], b[hit]))
            for i in np.flatnonzero(size > 2):
                out.append(forest(f[starts[i]:stops[i]], max_bits))
            src, dst = (np.concatenate(x) for x in zip(*out))
            return src, dst

        held, wide = [], None  # the rows of the last key so far; the key whose rows go on to be dealt

        def rows(key, f, last):
            nonlocal held, wide
            if wide is not None:
                n = int(np.searchsorted(key, wide, "right"))
                if n:
                    yield batch(f[:n], np.zeros(n, np.int64), key[:n], np.ones(n, bool))
                key, f = key[n:], f[n:]
                if len(key):
                    wide = None
            if held and len(key):
                key, f = np.concatenate([held[0], key]), np.concatenate([held[1], f])
                held = []
            if not len(key):
                if last and held:
                    key, f = held
                    held = []
                else:
                    return
            done = len(key) if last else int(np.searchsorted(key, key[-1], "left"))
            if done:
                src, dst = edges(key[:done], f[:done])
                yield batch(src, dst, np.zeros(len(src), np.int64), np.zeros(len(src), bool))
            key, f = key[done:], f[done:]
            if len(key) > group:
                wide = int(key[0])
                yield batch(f, np.zeros(len(f), np.int64), key, np.ones(len(f), bool))
            elif len(key):
                held = [key, f]

        for b in batches:
            yield from rows(b.column("key").to_numpy(), b.column("f").to_numpy(), False)
        yield from rows(np.zeros(0, np.int64), np.zeros(0, np.int64), True)
    return run


def _tile_kernel(max_bits: int):
    def run(key, t):
        import numpy as np
        import pyarrow as pa
        f = np.unique(t.column("f").combine_chunks().to_numpy())
        src, dst = forest(f, max_bits)
        return pa.table({"src": pa.array(src, pa.int64()), "dst": pa.array(dst, pa.int64())})
    return run


def links(distinct: DataFrame, max_bits: int = MAX_BITS, group: int = GROUP) -> DataFrame:
    """(src, dst): edges that connect exactly the fingerprints ``distinct``
    (f) which links within ``max_bits`` connect."""
    if not 0 <= max_bits <= 4:
        raise ValueError("the three segments are made for limits of 0 to 4 bits")
    spark = distinct.sparkSession
    keyed = distinct.mapInArrow(_keys_kernel(), "key long, f long")
    found = cut_lineage(keyed.repartition(shuffle_partitions(spark), "key").sortWithinPartitions("key")
                        .mapInArrow(_search_kernel(max_bits, group), "src long, dst long, key long, large boolean"))
    edges = found.filter("not large").select("src", "dst")
    large = found.filter("large").select("key", F.col("src").alias("f"))
    if large.limit(1).count() == 0:
        return edges
    parts = large.groupBy("key").agg(F.ceil(F.count("*") / F.lit(group / 2)).cast("int").alias("parts"))
    dealt = (large.join(parts, "key").withColumn("p", F.pmod(F.xxhash64("f", "key"), F.col("parts")).cast("int"))
             .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("key", F.least("p", "o").alias("a"), F.greatest("p", "o").alias("b"), "f"))
    more = dealt.groupBy("key", "a", "b").applyInArrow(_tile_kernel(max_bits), "src long, dst long")
    return edges.unionByName(cut_lineage(more))


def near_duplicates(docs: DataFrame, n: int = SHINGLE, max_bits: int = MAX_BITS, group: int = GROUP) -> DataFrame:
    """(doc_id, t, f, class, component_id) of every row: its text's hash, its
    fingerprint, the smallest fingerprint (as a long) that links lead to, and
    the smallest doc_id of that class."""
    prints = cut_lineage(fingerprints(docs, n))
    nodes = cut_lineage(prints.groupBy("f").agg(F.min("doc_id").alias("smallest")))
    edges = links(nodes.select("f"), max_bits, group)
    both = cut_lineage(edges.union(edges.select("dst", "src")).distinct())
    linked = both.select(F.col("src").alias("id")).distinct()
    member = (connected_components(linked, both).join(nodes, F.col("id") == F.col("f"))
              .select("f", F.col("label").alias("class"), "smallest"))
    least = member.groupBy("class").agg(F.min("smallest").alias("component_id"))
    found = member.join(least, "class").select(F.col("f").alias("_f"), "class", "component_id")
    # fingerprints without links are classes of their own
    whole = cut_lineage(nodes.join(found, F.col("f") == F.col("_f"), "left")
                        .select("f", F.coalesce("class", "f").alias("class"),
                                F.when(F.col("_f").isNull(), F.col("smallest")).otherwise(F.col("component_id"))
                                .alias("component_id")))
    return prints.join(whole, "f").select("doc_id", "t", "f", "class", "component_id")


def first_of_each(docs: DataFrame, n: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each class does:
    the one with the smallest doc_id (null last), then text hash; of
    repeated rows one.  All columns are kept, whatever their names; an empty
    table stays empty."""
    found = near_duplicates(docs, n, max_bits)
    rows = found.groupBy("class", "doc_id", "t").agg(F.count("*").alias("n"))
    stay = cut_lineage(rows.groupBy("class").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "t", "n")).alias("s")).select("s.*"))
    # the row travels as one struct: no name of its columns can clash
    row = F.struct(*[F.col(quoted(c)).alias(c) for c in docs.columns]).alias("row")
    kept = docs.select(row, F.col("doc_id").cast("long").alias("id"), F.xxhash64(text_or_empty()).alias("t")).join(
        stay.select(F.col("doc_id").alias("s"), F.col("t").alias("u"), "n"),
        F.col("id").eqNullSafe(F.col("s")) & (F.col("t") == F.col("u")))
    if stay.filter("n > 1").limit(1).count():
        once = kept.filter("n > 1").groupBy("id", "t").agg(F.first("row").alias("row"))
        kept = kept.filter("n = 1").select("row").unionByName(once.select("row"))
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])
