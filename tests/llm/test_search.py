"""op4, op5, op6: SimHash classes, exact top-k and WARC against brute force."""

import base64
import gzip
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from orrery.llm import simhash, topk, warc

DOC = "doc_id long, text string"


def print_of(text):
    t = re.sub("[A-Z]", lambda m: m.group(0).lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return 0
    sh = [" ".join(w)] if len(w) < 4 else [" ".join(w[i:i + 4]) for i in range(len(w) - 3)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(prints, bits):
    par = list(range(len(prints)))

    def find(i):
        while par[i] != i:
            i = par[i]
        return i
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= bits:
                a, b = find(i), find(j)
                par[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_golay_code_is_perfect():
    remainder, leader = simhash.golay_tables()
    assert len(np.unique(leader)) == 2048 and max(bin(x).count("1") for x in leader.tolist()) == 3
    assert (remainder(leader) == np.arange(2048)).all()


@pytest.mark.parametrize("group", [20_000, 3])
def test_links_join_exactly_what_is_near(spark, group):
    rng = random.Random(4)
    prints = [rng.getrandbits(64) for _ in range(200)]
    for p in prints[:60]:  # chains and clusters at 1 to 6 bits
        for _ in range(rng.randint(1, 6)):
            q = p
            for b in rng.sample(range(64), rng.randint(1, 6)):
                q ^= 1 << b
            prints.append(q)
            p = rng.choice([p, q])
    prints = sorted(set(prints))
    df = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in prints], "f long").repartition(5)
    edges = {(r["src"] % 2**64, r["dst"] % 2**64) for r in simhash.links(df, 4, group).collect()}
    assert all(bin(a ^ b).count("1") <= 4 for a, b in edges)
    par = {p: p for p in prints}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x
    for a, b in edges:
        par[find(a)] = find(b)
    want = classes(prints, 4)
    pairs = lambda lab: {frozenset(i for i, x in enumerate(lab) if x == y) for y in set(lab)}
    assert pairs([find(p) for p in prints]) == pairs(want)


def texts(spark):
    rng = random.Random(1)
    base = [" ".join(rng.choice("abcdefghijklmnop") * rng.randint(1, 4) for _ in range(rng.randint(1, 400))) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i, t in enumerate(base):  # copies, near copies
        w = t.split()
        w[len(w) // 2] = "changed"
        rows += [(100 + i, t.upper()), (200 + i, " ".join(w))]
    rows += [(300, None), (301, ""), (302, " \n\t"), (303, "A b"), (304, "a  b"), (304, "a  b"), (None, base[0]), (None, "alone here it is"),
             (305, "z " * 200_000)]
    return rows


def test_near_duplicates_equal_brute_force(spark):
    rows = texts(spark)
    got = simhash.near_duplicates(spark.createDataFrame(rows, DOC).repartition(4))
    got = sorted(got.select("doc_id", simhash.hex_digits(F.col("f")).alias("h"), "component_id").collect(), key=str)
    prints = [print_of(t) for _, t in rows]
    root = classes(prints, 4)
    least = {}
    for r, (i, _) in zip(root, rows):
        least[r] = i if least.get(r) is None else least[r] if i is None else min(i, least[r])
    want = [(i, f"{p:016x}", least[r]) for (i, _), p, r in zip(rows, prints, root)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_one_of_each_class_stays(spark):
    rows = [(i, t, "x") for i, t in texts(spark)]
    df = spark.createDataFrame(rows, DOC + ", f string")
    kept = simhash.first_of_each(df)
    assert kept.columns == df.columns
    root = classes([print_of(t) for _, t, _ in rows], 4)
    assert kept.count() == len(set(root))
    assert {r["doc_id"] for r in kept.collect()} >= {300, 303, 304, 305} - {304}
    none = spark.createDataFrame([], DOC)
    assert simhash.first_of_each(none).count() == 0 and simhash.near_duplicates(none).count() == 0


# ---- top-k


def brute_topk(vectors, queries, k=5):
    out = []
    for i, v in queries:
        s = sorted((-sum(a * b for a, b in zip(v, w)), j is None, j) for j, w in vectors if j != i and len(w) == len(v))[:k]
        out += [(i, r + 1, j, -x) for r, (x, _, j) in enumerate(s)]
    return sorted(out, key=str)


@pytest.mark.parametrize("shard,block,fan", [(None, 8192, 64), (16, 5, 2)])
def test_topk_equals_brute_force(spark, shard, block, fan):
    rng = np.random.default_rng(0)
    v = [(i, [int(x) for x in rng.integers(-9, 9, 6)]) for i in range(230)]
    v += [(1000 + i, v[3][1]) for i in range(20)] + [(None, v[3][1]), (2000, [1, 2]), (2050, [3, 4]), (3000, []), (3050, [])]
    df = spark.createDataFrame(v, "id long, v array<long>")
    q = df.filter(F.col("id") % 50 == 0)
    got = topk.top_k(q, df, 5, shard, block, fan).collect()
    assert sorted(map(tuple, got), key=str) == brute_topk(v, [(i, w) for i, w in v if i is not None and i % 50 == 0])


def test_topk_large_numbers_and_nothing(spark):
    big = [(0, [2**40, 3]), (1, [2**40, 5]), (2, [-(2**40), 1]), (3, [2**62, 2**62])]
    df = spark.createDataFrame(big, "id long, v array<long>")
    got = {(r["query_id"], r["id"]): r["score"] for r in topk.top_k(df.filter("id = 0"), df).collect()}
    assert got == {(0, 1): 2**63 - 1, (0, 2): -(2**63), (0, 3): 2**63 - 1}
    assert topk.top_k(df.limit(0), df).count() == 0 and topk.top_k(df.limit(0), df.limit(0)).count() == 0


def test_quantised_skips_unusable_vectors(spark):
    rows = [(0, [0.5, -0.001]), (1, [None, 1.0]), (2, None), (3, [float("nan")]), (4, [float("inf")]), (5, [])]
    got = {r["i"]: r["q"] for r in spark.createDataFrame(rows, "i int, v array<float>").select("i", topk.quantised(F.col("v")).alias("q")).collect()}
    assert got == {0: [128, -1], 1: None, 2: None, 3: None, 4: None, 5: []}


# ---- WARC


def test_surt():
    assert warc.surt("http://A.b.com:80/x?y") == "com,b,a:80)/x?y"
    assert warc.surt("a.b") == "b,a)" and warc.surt("") == ")" and warc.surt("x://u@h.de#f") == "de,h)#f"


def round_trip(spark, rows, lines=3, ranges=4, min_bytes=0):
    df = spark.createDataFrame(rows, "page_id long, url string, html string, key string, refs int")
    root = warc.archive_folder(spark)
    captures = warc.write_archives(df.repartition(3), root, min_bytes)
    level = warc.write_index(captures, root, lines, ranges)
    return captures, level, warc.look_up(captures, level)


def test_warc_round_trip(spark):
    rows = [(i, f"http://h{i % 5}.example.com/p{i}?q=a b", f"<p>page {i % 11} é", "k", 1) for i in range(60)]
    rows += [(100, None, None, None, None), (101, "", "", "k", 1), (None, "http://x/", "<p>page 3 é", "k", 1), (7, "http://other/", "<p>page 7 é", "k", 1),
             (7, "http://other/", "<p>page 7 é", "k", 1), (200, "http://big/\r\nX: y", "<b>" + "long " * 300_000, "k", 1)]
    captures, level, found = round_trip(spark, rows)
    assert len(level) > 1
    got = sorted(map(tuple, found.drop("key").collect()), key=str)
    want, groups = [], {}
    for r in rows:
        groups.setdefault((r[2] or "").encode(), []).append(r[0])
    for payload, ids in groups.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        top = max(i for i in ids if i is not None)
        first = True
        for i in ids:
            if i == top and first:
                first = False
                want.append((i, len(payload), digest, "response", None))
            else:
                want.append((i, len(payload), digest, "revisit", top))
    assert got == sorted(want, key=str)
    # every archive is a row of gzip members, each one record
    files = {r["file"] for r in captures.select("file").collect()}
    n = 0
    for f in files:
        fs, path = warc.shared_file(f)
        data = gzip.decompress(fs.open_input_file(path).read())
        n += data.count(b"WARC/1.1\r\n")
    assert n == len(rows)


def test_warc_least_size_unknown_keys_and_nothing(spark):
    rows = [(i, "http://a/", "same", "k", 0) for i in range(3)] + [(9, "http://a/", "x", "k", 0), (8, "http://a/", "x", "k", 0)]
    _, level, found = round_trip(spark, rows, min_bytes=2)
    kinds = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in found.collect()}
    assert kinds == {0: ("revisit", 2), 1: ("revisit", 2), 2: ("response", None), 8: ("response", None), 9: ("response", None)}
    assert warc.look_up(spark.createDataFrame([("zz 1 1",), ("",)], "key string"), level).count() == 0
    _, level, found = round_trip(spark, [])
    assert level == [] and found.count() == 0


def test_warc_of_one_id_with_many_payloads(spark, tmp_path):
    """50,000 rows under one id, whose payloads another id also holds, and as
    many null ids."""
    one = spark.range(50_000).select(F.lit(7).cast("long").alias("page_id"), F.lit("http://h.x/").alias("url"),
                                     F.concat(F.lit("p"), F.col("id")).alias("html"))
    pages = (one.unionByName(one.withColumn("page_id", F.lit(9).cast("long")))
             .unionByName(one.withColumn("page_id", F.lit(None).cast("long"))).withColumn("of", F.lit("x")).withColumn("a.b", F.lit(1)))
    captures = warc.write_archives(pages, str(tmp_path / "w"))
    got = warc.look_up(captures, warc.write_index(captures, str(tmp_path / "w")))
    found = {(r["page_id"], r["record_type"], r["refers_to"]): r["count"]
             for r in got.groupBy("page_id", "record_type", "refers_to").count().collect()}
    assert found == {(9, "response", None): 50_000, (7, "revisit", 9): 50_000, (None, "revisit", 9): 50_000}
    assert got.filter("payload_bytes is null").count() == 0


@pytest.mark.parametrize("edge", [2**15, 2**31])
def test_topk_at_the_ends_of_narrow_components(spark, edge):
    v = [(i, [x, 1]) for i, x in enumerate([edge - 1, -edge, edge, -edge - 1, 0])]
    for rows in (v[:2] + v[4:], v):  # all that fit, and one step wider
        df = spark.createDataFrame(rows, "id long, v array<long>").withColumn("dim", F.lit("x")).withColumn("a.b", F.lit(0))
        got = topk.top_k(df, df, 5).collect()
        assert sorted(map(tuple, got), key=str) == brute_topk(rows, rows)
