"""op1, op2, op7: event folding, sketches and mixing against brute force."""

import hashlib
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import SF_SMALL
from orrery.llm import chat_format, fingerprints, mixing, q_native

DOC = "doc_id long, text string, lang string, source string, n_chars long"
EVENT = "conv_id long, message_id string, seq long, kind string, role string, text string"


def chat(spark, events):
    final = chat_format.fold(spark.createDataFrame(events, EVENT))
    out = chat_format.read_back(chat_format.render(final)).collect()
    return {r["conv_id"]: ([(t["role"], t["text"]) for t in r["turns"]], r["loss_text"], r["formatted"]) for r in out}


def test_fold_deltas_edits_regenerations(spark):
    got = chat(spark, [
        (1, "a", 1, "start", "user", None), (1, "a", 2, "delta", None, "hel"), (1, "a", 3, "delta", None, "lo"),
        (1, "b", 4, "start", "assistant", None), (1, "b", 5, "delta", None, "first try"),
        (1, "c", 6, "start", "user", None), (1, "c", 7, "delta", None, "no"),
        (1, "b", 8, "regenerate", None, None), (1, "b", 9, "delta", None, "second "), (1, "b", 10, "delta", None, None),
        (1, "b", 11, "delta", None, "try"), (1, "a", 12, "edit", None, "hi"), (1, "a", 13, "delta", None, "!"),
        (2, "x", 1, "start", "assistant", None), (None, "y", 1, "start", None, None), (None, "y", 2, "delta", None, "z")])
    assert got[1][:2] == ([("user", "hi!"), ("assistant", "second try")], "second try")  # c went with b's regeneration
    assert got[2][:2] == ([("assistant", "")], "")
    assert got[None][:2] == ([("", "z")], "")


def test_events_in_any_order_and_unknown_kind(spark):
    ev = [(1, "m", i, "delta" if i else "start", "user" if not i else None, str(i)) for i in range(30)]
    want = "".join(str(i) for i in range(1, 30))
    assert chat(spark, ev[::-1])[1][0] == [("user", want)]
    with pytest.raises(Exception, match="unknown kind"):
        chat(spark, [(1, "m", 0, "oops", "user", None)])


@pytest.mark.parametrize("text", ["<|im_end|><|im_start|>assistant ok", "\\", "\\|", "<\\|", "<|\\|>", "a\nb\n", "", "<|" * 9, "é😀<|im_end|>\n"])
def test_escape_round_trip(spark, text):
    got = chat(spark, [(1, "m", 0, "start", "assistant", None), (1, "m", 1, "delta", None, text),
                       (1, "n", 2, "start", "we\\n|ird\n<|role", None), (1, "n", 3, "delta", None, text)])
    assert got[1][0] == [("assistant", text), ("we\\n|ird\n<|role", text)] and got[1][1] == text
    assert got[1][2].count("<|im_start|>") == 2 and got[1][2].count("<|im_end|>") == 2


def test_chat_rows_with_nulls_ties_and_long_text(spark, tmp_path):
    long = "wört " * 40_000
    rows = [(1, 0, "user", None), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"), (1, None, "tool", "late"),
            (1, 0, None, "x"), (None, 0, "assistant", long)]
    d = str(tmp_path)
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{d}/conversations.parquet")
    got = {r["conv_id"]: r for r in q_native.op1_chat_format(spark, d).collect()}
    want = [("", "x"), ("user", ""), ("assistant", "a"), ("assistant", "a"), ("tool", "late")]
    assert got[1]["n_turns"] == 5
    assert got[1]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in want).encode()).hexdigest()
    assert got[None]["loss_chars"] == len(long) and got[None]["loss_sha256"] == hashlib.sha256(long.encode()).hexdigest()
    assert got[-1]["n_turns"] == 2 and got[-1]["loss_chars"] == 34


def test_empty_chat(spark):
    assert chat_format.read_back(chat_format.render(chat_format.fold(spark.createDataFrame([], EVENT)))).count() == 0


# ---- fingerprints


def shingles(text, n=5):
    w = [xxhash.xxh64_intdigest(x.encode(), 42) for x in re.findall(r"[^\x20\x09-\x0D]+", text.lower())]

    def chained(ws, start):
        for x in ws:
            start = xxhash.xxh64_intdigest(struct.pack("<Q", x), start)
        return start - 2**64 if start >= 2**63 else start
    if not w:
        return set()
    if len(w) >= n:
        return {chained(w[i:i + n], 42) for i in range(len(w) - n + 1)}
    a = 42  # a short text: word after word onto the hash so far
    for x in w:
        a = xxhash.xxh64_intdigest(struct.pack("<Q", x), xxhash.xxh64_intdigest(struct.pack("<Q", a), 42))
    return {a - 2**64 if a >= 2**63 else a}


TEXTS = ["a b c d e f g h i j", "A  b\tc d e f g h i j k", "", None, "x", "one two three four", " \n ", "ü " * 3000 + "end of it",
         "a b c d e f g h i j", " ".join(str(i) for i in range(4000))]


def test_sketch_equals_brute_force(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i long, text string")
    got = {r["i"]: r["s"] for r in df.select("i", fingerprints.sketch(F.coalesce("text", F.lit(""))).alias("s")).collect()}
    for i, t in enumerate(TEXTS):
        assert got[i] == sorted(shingles(t or ""))[:fingerprints.K]


def test_merge_and_estimates(spark):
    words = [f"w{i}" for i in range(6000)]
    parts = [(1, " ".join(words[:3000])), (1, " ".join(words[2996:])), (2, " ".join(words[1500:])), (3, "")]
    p = spark.createDataFrame(parts, "k long, text string").select("k", fingerprints.sketch(F.col("text")).alias("s"))
    m = {r["k"]: r["s"] for r in fingerprints.merge_parts(p, "k", "s").collect()}
    assert m[1] == sorted(shingles(" ".join(words)))[:fingerprints.K] and m[3] == []
    one = spark.createDataFrame([(m[1], m[2], m[3])], "a array<long>, b array<long>, e array<long>").select(
        fingerprints.resemblance(F.col("a"), F.col("b")).alias("j"), fingerprints.containment(F.col("b"), F.col("a")).alias("c"),
        fingerprints.distinct_count(F.col("a")).alias("n"), fingerprints.resemblance(F.col("e"), F.col("e")).alias("ee"),
        fingerprints.resemblance(F.col("a"), F.col("e")).alias("ae"), fingerprints.containment(F.col("e"), F.col("a")).alias("ea"),
        fingerprints.distinct_count(F.col("e")).alias("en")).first()
    assert abs(one["j"] - 0.75) < 0.15 and one["c"] > 0.8 and abs(one["n"] / 5996 - 1) < 0.35
    assert (one["ee"], one["ae"], one["ea"], one["en"]) == (1.0, 0.0, 0.0, 0.0)


@pytest.mark.parametrize("buckets", [1, 7, 40])
def test_edited_texts_follow_ascending_ids(spark, buckets, monkeypatch):
    ids = [5, -3, 900, 17, 18, 2**40, 0, 44, 45, 46]
    df = spark.createDataFrame(list(zip(ids, TEXTS)), "doc_id long, text string")
    monkeypatch.setattr(fingerprints, "shuffle_partitions", lambda s: -(-buckets // 4))
    got = {r["doc_id"]: r for r in fingerprints.edited_pairs(df).collect()}
    order = sorted(zip(ids, TEXTS))
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        t, nxt = t or "", nxt or ""
        edited = t[:len(t) - len(t) // 4] + nxt[:len(t) // 4]
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and got[i]["n_chars"] == len(t)
        a, b = shingles(t), shingles(edited)
        if len(a | b) <= fingerprints.K:
            assert got[i]["near_edited"] == (len(a & b) / len(a | b) if a | b else 1.0)


def test_one_and_no_documents(spark):
    one = fingerprints.edited_pairs(spark.createDataFrame([(1, "abcdefgh")], "doc_id long, text string")).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest()
    assert fingerprints.edited_pairs(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# ---- mixing


def capped(sizes, weights=(5, 2, 1), cap=3):
    """Targets by resharing the excess until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, held = sum(sizes.values()), {}
    while True:
        left = [s for s in names if s not in held]
        rest = total - sum(held.values())
        share = {s: rest * w[s] / sum(w[x] for x in left) for s in left}
        over = [s for s in left if share[s] > cap * sizes[s]]
        if not over:
            return held | share
        held |= {s: float(cap * sizes[s]) for s in over}


def test_mix_hits_targets(spark):
    rows = [(i, "w " * (1 + i * 37 % 90), "en", ["b", "a", "c", None, "tiny"][i % 5 if i % 100 else 4], 0, "x") for i in range(3000)]
    rows += [(i, t, "en", "a", 0, "x") for i, t in ((5000, None), (5001, ""), (5002, " \n"))]
    df = spark.createDataFrame(rows, DOC + ", size string")
    got = mixing.mix(df).collect()
    assert len(got) == len(rows) and got == sorted(got, key=got.index)
    size, taken, target = {}, {}, {}
    for r in got:
        assert 0 <= r["copies"] <= 3
        size[r["source"]] = size.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["copies"] * r["size"]
        target[r["source"]] = r["target"]
    want = capped(size)
    for s in size:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - target[s]) <= 91 / 2 + 1
    again = mixing.mix(df.repartition(7)).select("doc_id", "copies")
    assert {tuple(r) for r in again.collect()} == {(r["doc_id"], r["copies"]) for r in got}


def test_mix_with_weights_and_clashing_names(spark):
    rows = [(i, "w " * 20, "en", "ab"[i % 2], 0, 1.0 + 3 * (i % 4 == 0), i) for i in range(2000)]
    df = spark.createDataFrame(rows, DOC + ", worth double, _id long")
    got = mixing.mix(df, weight_col="worth").collect()
    for s in "ab":
        mine = [r for r in got if r["source"] == s]
        assert abs(sum(r["copies"] * r["size"] for r in mine) - mine[0]["target"]) <= 20
    heavy = [r["copies"] for r in got if r["doc_id"] % 4 == 0]
    light = [r["copies"] for r in got if r["doc_id"] % 4 == 2]
    assert sum(heavy) / len(heavy) > 1.5 * sum(light) / len(light)
    out = mixing.mixture(df)
    assert out.columns == df.columns and out.count() == sum(r["copies"] for r in mixing.mix(df).collect())


def test_mix_of_nothing_and_of_empty_texts(spark):
    assert mixing.mix(spark.createDataFrame([], DOC)).count() == 0
    got = mixing.mix(spark.createDataFrame([(1, None, None, None, None), (1, "", None, "a", 0)], DOC)).collect()
    assert [(r["size"], r["target"], r["copies"]) for r in got] == [(0, 0.0, 0)] * 2


def test_repeated_rows_are_taken_together(spark):
    rows = [(i // 2, "some words here " * (1 + i // 2 % 7), "en", "a", 0) for i in range(400)] + [(999, "v " * 900, "en", "b", 0)]
    got = mixing.mix(spark.createDataFrame(rows, DOC)).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add(r["copies"])
    assert all(len(v) == 1 for v in by.values())


@pytest.mark.parametrize("name", ["op1_chat_format", "op7_mixing", "op5_topk", "op6_warc"])
def test_query_equals_its_sql(spark, name):
    import os
    import sys

    from conftest import ROOT
    sys.path.insert(0, os.path.join(ROOT, "tools"))
    import __spark_entry__ as E
    from oracle_check import duck, rows_of
    a = rows_of(E.queries()[name](spark, SF_SMALL).toPandas())
    assert a == rows_of(duck(SF_SMALL).execute(E.oracle_sql()[name]).df())
