"""Trie of conversation prefixes by vertical bitmaps.

A node of depth d stands for one sequence of first d turns; its members are
the conversations that begin with it, its ends those that stop there.

Conversations are numbered by ascending id and dealt into shards of
``shard`` consecutive numbers, their turns into bands of ``band`` positions.
In every (shard, band) the index is vertical: for each (position, turn) a
bitset of the conversations that have this turn there.  The tree is walked
depth first: a node's bitset meets the posting of the next turn of its lowest
remaining conversation, which yields a child; the child's members leave the
rest, and so on until the rest is empty.  Popcounts are member counts, the
lowest bit is the smallest member, and the meeting with the bitset of
conversations of that length is the shard's end list.

A band starts from the classes of conversations with equal beginnings, which
are known from a running digest (XOR of 128-bit position hashes), so bands
and shards need nothing of each other: no task holds more than
``shard`` x ``band`` turns, however long a conversation or common a beginning is.
A node found in several shards is summed over them by (depth, digest); there
are at most as many such rows as shards.

Sums over a subtree use that every node lies on the path of its smallest
member: that conversation carries the node's weight at the node's depth, a
leaf is one flag on its smallest member, and the sum below a node is the sum
over its members of what they carry from its depth on.  A second pass over
the bitsets of nodes with two members or more adds that up, deepest first.

Defined results: rows without a conv_id belong to no conversation; null role
or text is empty; null turns come first; equal turn numbers are ordered by
role and text, so repeated rows are turns of their own; an empty table has no
nodes, not even a root; columns other than those named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.base import cut_lineage, shuffle_partitions
from orrery.operators.textops import global_index
from orrery.session import small_side

SHARD = 1024
BAND = 64
#: turns of one conversation that share a key of a join
BLOCK = 4096
#: children of one node beyond which it is joined from a broadcast table
MANY_CHILDREN = 500
NODE = ["depth", "d1", "d2"]


def ordered_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, k1, k2, n_bytes) of (conv_id, turn, role, text): the
    turn's place from 1, a 128-bit hash of role and text, and the text's
    UTF-8 bytes.

    One range sort; a conversation may span tasks, whose counts become
    offsets.  The sorted keys are written once, without texts, because range
    bounds are sampled."""
    spark = rows.sparkSession
    t = rows.filter(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    s = cut_lineage(t.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order).select(
        "conv_id", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_at"),
        F.xxhash64("role", "text").alias("k1"), F.xxhash64("text", F.lit(1), "role").alias("k2"),
        F.octet_length("text").cast("long").alias("n_bytes")))
    parts = s.groupBy("conv_id", "_p").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("conv_id").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    # at most one conversation comes into a task from the one before
    later = parts.withColumn("_off", before).filter("_off > 0").select("conv_id", "_p", "_off")
    here = F.row_number().over(Window.partitionBy("_p", "conv_id").orderBy("_at"))
    return (s.withColumn("_l", here.cast("long")).join(F.broadcast(later), ["conv_id", "_p"], "left")
            .select("conv_id", (F.col("_l") + F.coalesce("_off", F.lit(0))).alias("pos"), "k1", "k2", "n_bytes"))


def rebuilt(turns: DataFrame, base: Column, head: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first ``head`` turns are those of the conversation
    ``base`` (both columns of conv_id; all if it has fewer, none if it is
    absent), followed by their own turns after the first ``head``: turns as
    given, and (conv_id, length) of every conversation, turnless ones included.

    Long conversations meet their figures by (conv_id, block of positions)."""
    turns = cut_lineage(turns)
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumn("base", base).withColumn("h", head)
    sizes = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = cut_lineage(convs.join(sizes, "base", "left")
                        .withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
                        .select("conv_id", "n", "base", "h", "taken",
                                (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")))
    blocks = convs.select("conv_id", "h", "taken", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {BLOCK}"))).alias("_b"))
    own = (turns.withColumn("_b", F.expr(f"(pos - 1) div {BLOCK}")).join(blocks, ["conv_id", "_b"]).filter("pos > h")
           .select("conv_id", (F.col("taken") + F.col("pos") - F.col("h")).alias("pos"), "k1", "k2", "n_bytes"))
    heads = turns.withColumnRenamed("conv_id", "base").join(
        convs.filter("taken > 0").select("conv_id", "base", F.explode(F.sequence(F.lit(1).cast("long"), "taken")).alias("pos")),
        ["base", "pos"]).select("conv_id", "pos", "k1", "k2", "n_bytes")
    return own.unionByName(heads), convs.select("conv_id", "length")


_PART = ("shard long, band long, depth long, d1 long, d2 long, p1 long, p2 long, n long, conv_id long, n_bytes long, "
         "ends array<long>, bits binary")


def _walk(band_size: int):
    def run(table):
        import pyarrow as pa
        conv, bit, length = (table.column(c).to_pylist() for c in ("conv_id", "bit", "length"))
        s1, s2, turns = (table.column(c).to_pylist() for c in ("s1", "s2", "turns"))
        shard, band = table.column("shard")[0].as_py(), table.column("band")[0].as_py()
        first = band * band_size
        conv_of, turns_of, postings, n_bytes, ended, classes = {}, {}, {}, {}, {}, {}
        for c, b, n, a1, a2, ts in zip(conv, bit, length, s1, s2, turns):
            one = 1 << b
            conv_of[b] = c
            turns_of[b] = path = {}
            for t in ts:
                key = (t["pos"], t["x1"], t["x2"])
                path[t["pos"]] = key
                postings[key] = postings.get(key, 0) | one
                n_bytes[key] = t["n_bytes"]
            ended[n] = ended.get(n, 0) | one
            classes[a1, a2] = classes.get((a1, a2), 0) | one
        found, stack = [], [(first, d1, d2, bits) for (d1, d2), bits in classes.items()]
        while stack:
            depth, d1, d2, bits = stack.pop()
            rest = bits & ~ended.get(depth, 0)
            if depth == first + band_size:
                continue
            while rest:
                key = turns_of[(rest & -rest).bit_length() - 1][depth + 1]
                child = rest & postings[key]
                rest ^= child
                e1, e2, ends, last = d1 ^ key[1], d2 ^ key[2], [], child & ended.get(depth + 1, 0)
                while last:
                    ends.append(conv_of[(last & -last).bit_length() - 1])
                    last &= last - 1
                found.append((shard, band, depth + 1, e1, e2, d1, d2, child.bit_count(),
                              conv_of[(child & -child).bit_length() - 1], n_bytes[key], ends,
                              child.to_bytes((child.bit_length() + 7) // 8, "little")))
                stack.append((depth + 1, e1, e2, child))
        kinds = [pa.int64()] * 10 + [pa.list_(pa.int64()), pa.binary()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kinds)],
                                    names=[f.strip().split(" ")[0] for f in _PART.split(",")])
    return run


def _carry(shard_size: int):
    def run(nodes, convs):
        import numpy as np
        import pyarrow as pa
        below, leaf, at = np.zeros(shard_size, np.int64), np.zeros(shard_size, np.int64), {}
        for b, later, is_leaf, ws in zip(*(convs.column(c).to_pylist() for c in ("bit", "later", "leaf", "ws"))):
            below[b], leaf[b] = later, is_leaf
            for w in ws or []:
                at.setdefault(w["depth"], []).append((b, w["w"]))
        rows = sorted(zip(*(nodes.column(c).to_pylist() for c in (*NODE, "bits"))), reverse=True)
        depths, out = sorted(at, reverse=True), []
        for depth, d1, d2, bits in rows:
            while depths and depths[0] >= depth:
                for b, w in at[depths.pop(0)]:
                    below[b] += w
            member = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").nonzero()[0]
            out.append((depth, d1, d2, int(leaf[member].sum()), int(below[member].sum())))
        cols = list(zip(*out)) or [()] * 5
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in cols], names=[*NODE, "n_leaves", "saved_tokens"])
    return run


def _chained(batches):
    """Digest of the ends of each node; rows come sorted by node and shard."""
    from hashlib import sha256

    import pyarrow as pa
    schema = pa.schema([(c, pa.int64()) for c in NODE] + [("ends_sha256", pa.string())])
    now, state = None, None
    for b in batches:
        out = []
        for *node, ids in zip(*(b.column(c).to_pylist() for c in (*NODE, "ends"))):
            text = ",".join(map(str, ids)).encode()
            if node != now:
                if now is not None:
                    out.append((*now, state.hexdigest()))
                now, state = node, sha256(text)
            else:
                state.update(b"," + text)
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema=schema)
    if now is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*now, state.hexdigest())))], schema=schema)


def ends_digest(ends: DataFrame) -> DataFrame:
    """(depth, d1, d2, ends_sha256) from the end lists of ``prefix_trie``:
    SHA-256 of the ids in ascending order, comma-joined.  The lists of a node
    stream through one task in shard order and are never held together."""
    return (ends.repartition(*NODE).sortWithinPartitions(*NODE, "shard").select(*NODE, "ends")
            .mapInArrow(_chained, "depth long, d1 long, d2 long, ends_sha256 string"))


def prefix_trie(turns: DataFrame, convs: DataFrame, shard: int = SHARD, band: int = BAND) -> tuple[DataFrame, DataFrame]:
    """The trie's nodes and end lists.

    ``turns``: (conv_id, pos, k1, k2, n_bytes), positions from 1 without gaps;
    ``convs``: (conv_id, length) of every conversation.  Nodes: depth, d1, d2
    (digest of the prefix; with depth it names the node), conv_id (smallest
    member), parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (sum
    over the subtree of (members - 1) x bytes of the last text).  Ends:
    (depth, d1, d2, shard, ends), ids ascending, at most ``shard`` a row."""
    numbered = cut_lineage(global_index(convs.select("conv_id", "length"), [F.col("conv_id")], "_i")
                           .select("conv_id", "length", F.expr(f"_i div {shard}").alias("shard"),
                                   (F.col("_i") % shard).alias("bit")))
    placed = turns.select("conv_id", F.expr(f"(pos - 1) div {band}").alias("band"), F.struct(
        "pos", F.xxhash64("k1", "k2", "pos").alias("x1"), F.xxhash64("pos", "k2", "k1").alias("x2"), "n_bytes").alias("t"))
    runs = placed.groupBy("conv_id", "band").agg(F.collect_list("t").alias("turns"), F.bit_xor("t.x1").alias("b1"),
                                                 F.bit_xor("t.x2").alias("b2"))
    earlier = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    start = lambda c: F.coalesce(F.bit_xor(c).over(earlier), F.lit(0).cast("long"))
    spans = cut_lineage(runs.withColumn("s1", start("b1")).withColumn("s2", start("b2")).drop("b1", "b2")
                        .join(numbered.hint("shuffle_merge"), "conv_id"))
    parts = cut_lineage(spans.groupBy("shard", "band").applyInArrow(_walk(band), _PART))

    nodes = parts.groupBy(*NODE).agg(F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"),
                                     F.min("n_bytes").alias("n_bytes"), F.min(F.struct("p1", "p2")).alias("p"))
    nodes = cut_lineage(nodes.select(*NODE, "n_convs", "conv_id", "n_bytes", "p.p1", "p.p2"))
    zero = F.lit(0).cast("long")
    root = (numbered.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).filter("n_convs > 0")
            .select(zero.alias("depth"), zero.alias("d1"), zero.alias("d2"), "n_convs", "conv_id", zero.alias("n_bytes"),
                    F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2")))
    nodes = nodes.unionByName(root)
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("d1"),
                                                 F.col("p2").alias("d2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = cut_lineage(nodes.join(children, NODE, "left").fillna(0, ["n_children"]))

    # a parent of very many children is broadcast, so that no join key is hot
    up = [(F.col("depth") - 1).alias("_pd"), "p1", "p2"]
    parents = nodes.filter("n_children > 0").select(F.col("depth").alias("_pd"), F.col("d1").alias("p1"), F.col("d2").alias("p2"),
                                                    F.col("conv_id").alias("parent_conv_id"), "n_children")
    often = small_side(parents.filter(F.col("n_children") > MANY_CHILDREN).drop("n_children"))
    below = nodes.filter("depth > 0").select("*", *up[:1])
    linked = (below.join(often, ["_pd", "p1", "p2"])
              .unionByName(below.join(often, ["_pd", "p1", "p2"], "left_anti").join(parents.drop("n_children"), ["_pd", "p1", "p2"]))
              .select(*NODE, "parent_conv_id"))

    # what the smallest members carry, and its sum over the members of shared nodes
    weighed = nodes.filter("depth > 0").select("*", ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("w"))
    carried = weighed.filter("w > 0").groupBy("conv_id", F.expr(f"(depth - 1) div {band}").alias("band")).agg(
        F.collect_list(F.struct("depth", "w")).alias("ws"), F.sum("w").alias("_w"))
    leaves = weighed.filter("n_children = 0").select("conv_id", F.lit(1).cast("long").alias("leaf"))
    after = Window.partitionBy("conv_id").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    loads = (spans.select("conv_id", "band", "shard", "bit").join(carried, ["conv_id", "band"], "left")
             .withColumn("later", F.coalesce(F.sum("_w").over(after), F.lit(0)))
             .join(leaves, "conv_id", "left").fillna(0, ["leaf"]).drop("_w", "conv_id"))
    shared = parts.select(*NODE, "shard", "band", "bits").join(nodes.filter("n_convs > 1").select(*NODE), NODE, "left_semi")
    sums = (shared.groupBy("shard", "band").cogroup(loads.groupBy("shard", "band"))
            .applyInArrow(_carry(shard), "depth long, d1 long, d2 long, n_leaves long, saved_tokens long")
            .groupBy(*NODE).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")))
    top = weighed.agg(F.greatest(F.count_if(F.col("n_children") == 0), F.lit(1)).alias("n_leaves"),
                      F.coalesce(F.sum("w"), F.lit(0)).alias("saved_tokens"))
    sums = sums.unionByName(top.select(zero.alias("depth"), zero.alias("d1"), zero.alias("d2"), "n_leaves", "saved_tokens"))
    out = (nodes.join(linked, NODE, "left").join(sums, NODE, "left")
           .select(*NODE, "conv_id", "parent_conv_id", "n_convs", "n_children",
                   F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
                   F.coalesce("saved_tokens", F.lit(0)).cast("long").alias("saved_tokens")))
    ends = parts.filter(F.size("ends") > 0).select(*NODE, "shard", "ends")
    turnless = numbered.filter("length = 0").groupBy("shard").agg(F.sort_array(F.collect_list("conv_id")).alias("ends"))
    ends = ends.unionByName(turnless.select(zero.alias("depth"), zero.alias("d1"), zero.alias("d2"), "shard", "ends"))
    return out, ends
