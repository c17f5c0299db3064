"""Spelling variants by finite-state composition.

Two words are near if one inserted, deleted or replaced code point turns one
into the other.  All near pairs of a vocabulary are the accepted pairs of
A o E o A: the minimised acceptor A of the words, a transducer E of exactly
one edit, and A again.

The composition starts, in every partition, from the state that A reaches
after an initial part.  Let the shorter word have L code points and h = L div
2: with one edit the two words share their first h code points or their last
h.  So a partition is (direction, L, h shared code points); its words are
those of length L ("short") and L + 1 ("long"), read on from that state,
forwards or backwards.  Within it the rests are minimised into two acceptors
and composed: equal labels advance both, one replacement (short with short)
or insertion (short with long) leads to the states where only equal labels
go on.  The composition visits reachable states only and never lists pairs of
words that are not near.  A pair that shares both halves is taken forwards
only, so every pair comes once.

A partition of more than ``bound`` words is split by one more code point:
pairs that share it go to the longer initial part, pairs whose edit lies
right there have equal remainders and are joined on them (a group of at most
one word for each letter), so nothing is lost and no partition is large.

Defined results: null text has no words; a null doc_id is read as empty text
where ids are digested; repeated rows count again; an empty table gives no
words; columns other than those named are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.base import cut_lineage, text_or_empty
from orrery.session import small_side

#: letters of a word: ASCII and the range U+00C0 to U+00FF
LETTERS = "[A-Za-zÀ-ÿ]+"
#: distinct words a task counts before it hands its counts on
HELD = 200_000
#: words of a partition beyond which it is split
BOUND = 20_000
PART = ["dir", "len", "key"]


def _counted(min_length: int, damage: int | None):
    def run(batches):
        import re
        from collections import Counter
        from zlib import crc32

        import pyarrow as pa
        runs, counts = re.compile(LETTERS).findall, Counter()

        def out():
            kept = [(w, n) for w, n in counts.items() if len(w) >= min_length]
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()),
                                               pa.array([n for _, n in kept], pa.int64())], names=["word", "n"])
        for b in batches:
            for doc, text in zip(b.column("doc_id"), b.column("text")):
                # lower() of bytes changes A-Z only
                found = Counter(runs(text.as_py().encode().lower().decode()))
                if damage is None:
                    counts.update(found)
                else:
                    head = crc32(f"{doc.as_py()}:".encode())
                    for w, n in found.items():
                        h = crc32(w.encode(), head)
                        if h % damage == 0:
                            i = h % len(w)
                            w = w[:i] + w[i + 1:]
                        counts[w] += n
                if len(counts) > HELD:
                    yield out()
        yield out()
    return run


def vocabulary(docs: DataFrame, min_length: int = 7, min_count: int = 2, damage: int | None = None) -> DataFrame:
    """(word, n): the words of all texts (runs of LETTERS, A-Z lower-cased) of
    at least ``min_length`` code points and ``min_count`` occurrences.  With
    ``damage``, a document's word whose crc32 of ``<doc_id>:<word>`` it
    divides first loses the code point at that crc modulo its length (planted
    errors)."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), text_or_empty().alias("text"))
    return (rows.mapInArrow(_counted(min_length, damage), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count))


def _acceptor(words):
    """Minimised acyclic acceptor of sorted distinct strings: (states, start),
    a state being (accepting, {label: state number})."""
    states, known, path, prev = [], {}, [(False, {})], ""

    def close(depth):
        while len(path) - 1 > depth:
            accepting, arcs = path.pop()
            sig = (accepting, tuple(arcs.items()))
            n = known.get(sig)
            if n is None:
                n = known[sig] = len(states)
                states.append((accepting, arcs))
            path[-1][1][prev[len(path) - 1]] = n
    for w in words:
        shared, top = 0, min(len(prev), len(w))
        while shared < top and prev[shared] == w[shared]:
            shared += 1
        close(shared)
        path.extend((False, {}) for _ in range(len(w) - len(path) + 1))
        path[-1] = (True, path[-1][1])
        prev = w
    close(0)
    states.append(path[0])
    return states, len(states) - 1


def _compose(short, long):
    """Accepted pairs of strings: (u, v), u < v, one replacement, both of
    ``short``; (u, v), v of ``long`` with one label more than u of ``short``."""
    a, start = _acceptor(short)
    b, start_b = _acceptor(long) if long else ([(False, {})], 0)

    def spelled(trail):
        out = []
        while trail:
            trail, label = trail
            out.append(label)
        return "".join(reversed(out))

    def same(left, p, right, q, u, v):
        """Pairs that go on with equal labels to the end."""
        stack = [(p, q, u, v)]
        while stack:
            p, q, u, v = stack.pop()
            (end_p, arcs_p), (end_q, arcs_q) = left[p], right[q]
            if end_p and end_q:
                yield spelled(u), spelled(v)
            for c in (arcs_p if len(arcs_p) <= len(arcs_q) else arcs_q):
                if c in arcs_p and c in arcs_q:
                    stack.append((arcs_p[c], arcs_q[c], (u, c), (v, c)))

    todo = [(start, start_b, ())]
    while todo:  # states reached by equal labels; q is None off the long words
        p, q, trail = todo.pop()
        end, arcs = a[p]
        labels = list(arcs)
        for i, c in enumerate(labels):
            for d in labels[i + 1:]:
                yield from same(a, arcs[c], a, arcs[d], (trail, c), (trail, d))
        long_arcs = b[q][1] if q is not None else {}
        for d, r in long_arcs.items():  # d is inserted; the next label differs from it, or the shorter word is at its end
            if end and b[r][0]:
                yield spelled(trail), spelled((trail, d))
            for c, s in arcs.items():
                if c != d and c in b[r][1]:
                    yield from same(a, s, b, b[r][1][c], (trail, c), ((trail, d), c))
        for c, s in arcs.items():
            todo.append((s, long_arcs.get(c), (trail, c)))


_PAIRS = "word string, n long, near string, near_n long"


def _pairs(batches):
    """Rows sorted by partition and rest -> near pairs."""
    import pyarrow as pa
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())])

    def solve(part, short, long):
        if not short or len(short) + len(long) < 2:
            return
        backwards, _, key = part
        n = short | long
        half = len(key) if not backwards else part[1] // 2
        for u, v in _compose(list(short), list(long)):
            full_u, full_v = key + u, key + v
            if backwards:
                full_u, full_v = full_u[::-1], full_v[::-1]
                if full_u[:half] == full_v[:half]:
                    continue  # found forwards
            yield full_u, n[u], full_v, n[v]

    def batch(rows):
        return pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)
    now, short, long, out = None, {}, {}, []
    for b in batches:
        for d, size, key, rest, is_long, n in zip(*(c.to_pylist() for c in b.columns)):
            if (d, size, key) != now:
                if now is not None:
                    for row in solve(now, short, long):
                        out.append(row)
                        if len(out) >= 10_000:
                            yield batch(out)
                            out = []
                now, short, long = (d, size, key), {}, {}
            (long if is_long else short)[rest] = n
    if now is not None:
        out.extend(solve(now, short, long))
    yield batch(out)


def _edited_here(hot: DataFrame) -> DataFrame:
    """Near pairs of split partitions whose edit is the first code point of
    the rest: groups of equal remainders, one word for each code point."""
    first, after = F.substring("rest", 1, 1), F.expr("substring(rest, 2)")
    one = lambda role, c, tail: hot.filter("length(rest) > 0 or not is_long").select(
        *PART, tail.alias("tail"), F.struct(F.lit(role).alias("role"), "is_long", c.alias("c"), "rest", "n").alias("m"))
    replaced = one(0, first, after).filter("not m.is_long and m.c != ''")
    inserted = one(1, first, F.when(F.col("is_long"), after).otherwise(F.col("rest")))
    g = (replaced.unionByName(inserted).groupBy(*PART, "tail", F.col("m.role").alias("role"))
         .agg(F.collect_list("m").alias("ms")).filter(F.size("ms") > 1)
         .withColumn("u", F.explode("ms")).withColumn("v", F.explode("ms"))
         .filter("u.c != v.c and not u.is_long and ((role = 0 and u.c < v.c) or (role = 1 and v.is_long))"))
    spell = lambda m: F.when(F.col("dir") == 0, F.concat("key", f"{m}.rest")).otherwise(
        F.reverse(F.concat("key", f"{m}.rest")))
    half = F.expr("len div 2")
    return (g.select("dir", "len", spell("u").alias("word"), F.col("u.n").alias("n"), spell("v").alias("near"), F.col("v.n").alias("near_n"))
            .filter((F.col("dir") == 0) | (F.substring("word", F.lit(1), half.cast("int")) != F.substring("near", F.lit(1), half.cast("int"))))
            .select("word", "n", "near", "near_n"))


def near_pairs(vocab: DataFrame, bound: int = BOUND) -> DataFrame:
    """(word, n, near, near_n) of every near pair of ``vocab`` (word, n), each
    once: the shorter or smaller word first."""
    size = F.length("word")
    ways = F.array(*[F.struct(F.lit(d).alias("dir"), (size - back).alias("len"), F.lit(bool(back)).alias("is_long"))
                     for d in (0, 1) for back in (0, 1)])
    w = F.when(F.col("dir") == 0, F.col("word")).otherwise(F.reverse("word"))
    half = F.expr("len div 2").cast("int")
    rows = (vocab.select("word", "n", F.inline(ways)).filter("len > 0")
            .select("dir", "len", F.substring(w, F.lit(1), half).alias("key"),
                    F.substring(w, half + 1, size).alias("rest"), "is_long", "n"))
    rows, found = cut_lineage(rows), []
    while True:
        large = small_side(rows.groupBy(*PART).count().filter(F.col("count") > bound).select(*PART))
        if large.isEmpty():
            break
        hot = cut_lineage(rows.join(large, PART, "left_semi"))
        found.append(cut_lineage(_edited_here(hot)))
        deeper = hot.filter("length(rest) > 0").select(
            "dir", "len", F.concat("key", F.substring("rest", 1, 1)).alias("key"), F.expr("substring(rest, 2)").alias("rest"), "is_long", "n")
        rows = cut_lineage(rows.join(large, PART, "left_anti").unionByName(deeper))
    out = (rows.repartition(*PART).sortWithinPartitions(*PART, "rest")
           .select(*PART, "rest", "is_long", "n").mapInArrow(_pairs, _PAIRS))
    for f in found:
        out = out.unionByName(f)
    return out


def variants(vocab: DataFrame, ratio: int = 10, bound: int = BOUND) -> DataFrame:
    """(word, n, n_near, form, form_n, root): the number of near words, the
    near word of largest n (ties: the smallest in code-point order) if that n
    is at least ``ratio`` times the word's own, and the end of the chain of
    forms.  Along a chain n grows by ``ratio``, so chains are short and end;
    they are followed by doubling."""
    vocab = cut_lineage(vocab.select("word", "n"))
    pairs = cut_lineage(near_pairs(vocab, bound))
    both = pairs.unionByName(pairs.toDF("near", "near_n", "word", "n"))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("b"))
    near = (vocab.join(best, "word", "left")
            .withColumn("form", F.when(-F.col("b.m") >= ratio * F.col("n"), F.col("b.near")))
            .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form",
                    F.when(F.col("form").isNotNull(), -F.col("b.m")).alias("form_n")))
    near = cut_lineage(near)
    roots = cut_lineage(near.filter("form is not null").select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    while not roots.filter("moved").isEmpty():
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        roots = cut_lineage(roots.join(ahead, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")))
    return near.join(roots.select("word", "root"), "word", "left").withColumn("root", F.coalesce("root", "word"))
