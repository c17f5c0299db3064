"""op11, op12, op13: trie, spelling variants and token counts against brute force."""

import hashlib
import random
import re
import string
from collections import Counter, defaultdict
from zlib import crc32

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from orrery.llm import prefix_trie, q_prefix, q_spelling, q_tokens, spelling, token_counts
from orrery.session import scratch_path

CONV = "conv_id long, turn long, role string, text string"
DOC = "doc_id long, text string"


# ---- op11 -------------------------------------------------------------------

def brute_rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        base, h = c - (abs(c) % 5) * (1 if c >= 0 else -1), crc32(str(c).encode()) % 9
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute_trie(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for p, ms in members.items():
        sub = [q for q in members if q[:len(p)] == p]
        kids = {q for q in sub if len(q) == len(p) + 1}
        leaf = lambda q: not any(len(r) == len(q) + 1 and r[:len(q)] == q for r in sub)
        ends = sorted(c for c in ms if len(convs[c]) == len(p))
        out.append((min(ms), len(p), min(members[p[:-1]]) if p else None, len(ms), len(kids), sum(map(leaf, sub)),
                    sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in sub if q),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def trie_rows(spark, rows, path, extra=False):
    df = spark.createDataFrame(rows, CONV)
    if extra:
        df = df.withColumn("depth", F.lit("x")).withColumn("a.b", F.lit(1)).withColumn("_p", F.lit(2))
    df.repartition(3).write.parquet(f"{path}/conversations.parquet")
    return sorted((tuple(r) for r in q_prefix.op11_prefix_trie(spark, str(path)).collect()), key=str)


def test_trie_with_nulls_ties_and_copies(spark, tmp_path):
    rng = random.Random(4)
    rows = []
    for c in range(-7, 70):
        for t in range(rng.choice([0, 1, 2, 5, 12])):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(["a", "é😀", "", None])))
    rows += rows[:40] + [(None, 0, "user", "nobody"), (90, 0, None, "long " * 30_000)]
    assert trie_rows(spark, rows, tmp_path, extra=True) == brute_trie(brute_rebuilt(rows))


def test_trie_bands_and_shards(spark):
    """Conversations of 1 to 200 turns that part at every place, in shards of
    4 conversations and bands of 8 positions."""
    rng, convs = random.Random(5), {}
    for c in range(24):
        at = rng.randrange(200)
        convs[c * 3] = [("user", "same")] * at + [("user", f"own {c % 4}")] * rng.randrange(8)
    turns = spark.createDataFrame([(c, i, r, t) for c, ts in convs.items() for i, (r, t) in enumerate(ts)], CONV)
    sizes = spark.createDataFrame([(c, len(ts)) for c, ts in convs.items()], "conv_id long, length long")
    nodes, ends = prefix_trie.prefix_trie(prefix_trie.ordered_turns(turns), sizes, shard=4, band=8)
    assert ends.agg(F.max(F.size("ends"))).first()[0] <= 4
    got = nodes.join(prefix_trie.ends_digest(ends), prefix_trie.NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_trie(convs)


def test_trie_of_empty_and_turnless(spark, tmp_path):
    assert trie_rows(spark, [], tmp_path / "none") == []
    c = next(c for c in range(1, 99) if c % 5 and crc32(str(c).encode()) % 9 > 1)  # the base is absent, all own turns are cut
    want = (c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())
    assert trie_rows(spark, [(c, 0, "user", "x")], tmp_path / "one") == [want]


def test_positions_when_a_conversation_spans_tasks(spark):
    rows = [(1, t, "user", "x") for t in range(3000)] + [(2, None, "user", "y")] * 50
    got = prefix_trie.ordered_turns(spark.createDataFrame(rows, CONV)).select("conv_id", "pos").collect()
    assert sorted(map(tuple, got)) == [(1, p) for p in range(1, 3001)] + [(2, p) for p in range(1, 51)]


# ---- op12 -------------------------------------------------------------------

def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(counts, ratio=10):
    out = {}
    for w, n in counts.items():
        ms = [v for v in counts if near(w, v)]
        best = min(ms, key=lambda v: (-counts[v], v), default=None)
        form = best if best and counts[best] >= ratio * n else None
        out[w] = (form, n, len(ms), counts[form] if form else None)
    root = {}
    for w in out:
        r = w
        while out[r][0]:
            r = out[r][0]
        root[w] = r
    return sorted((w, f, root[w], n, k, fn) for w, (f, n, k, fn) in out.items())


def brute_words(docs):
    counts = Counter()
    az = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    for d, text in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(az)
            h = crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def test_spelling_query_against_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    words = spelling.vocabulary(spark.createDataFrame(docs, DOC), 7, 2, 31)
    want = brute_words(docs)
    assert {r["word"]: r["n"] for r in words.collect()} == want
    got = spelling.variants(words).select("word", "form", "root", "n", "n_near", "form_n")
    assert sorted(map(tuple, got.collect())) == brute_variants(want)


@pytest.mark.parametrize("bound", [20_000, 3])
def test_near_pairs_whole_and_split(spark, bound):
    """A dense vocabulary; with a bound of 3 words nearly every partition is split."""
    rng = random.Random(6)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(1, 8))) for _ in range(400)} | {"é" * 300, "é" * 301, "é" * 299 + "a"}
    vocab = spark.createDataFrame([(w, rng.randrange(2, 50)) for w in words], "word string, n long")
    got = [(r["word"], r["near"]) for r in spelling.near_pairs(vocab, bound).collect()]
    assert len(got) == len(set(map(frozenset, got)))
    every = sorted(words)
    assert {frozenset(p) for p in got} == {frozenset((a, b)) for i, a in enumerate(every) for b in every[i + 1:] if near(a, b)}


def test_chains_of_forms_and_ties(spark):
    counts = {"aaaaaaa": 1, "aaaaaab": 10, "aaaaabb": 100, "aaaabbb": 1000, "baaaaaa": 10, "ccccccc": 5, "cccccccd": 50, "dccccccc": 50}
    got = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long"))
    got = got.select("word", "form", "root", "n", "n_near", "form_n")
    assert sorted(map(tuple, got.collect())) == brute_variants(counts)


def test_words_of_nulls_empty_long_and_repeated(spark):
    docs = [(1, None), (2, ""), (None, "Straßenbahn STRAßENBAHN"), (3, "x" * 400_000 + " Ünderwear underwear ünderwear Ünderwear"), (3, "1"), (4, "word words wörter")]
    df = spark.createDataFrame(docs * 2, DOC).withColumn("word", F.lit(1)).withColumn("n.n", F.lit(2))
    assert {r["word"]: r["n"] for r in spelling.vocabulary(df, 7, 2, 31).collect()} == brute_words(docs * 2)
    none = spelling.variants(spelling.vocabulary(df.limit(0)))
    assert none.count() == 0 and set(none.columns) == {"word", "n", "n_near", "form", "form_n", "root"}


# ---- op13 -------------------------------------------------------------------

TEXTS = ["", None, "a", "Hello <|endoftext|> world", "hello <|ENDOFTEXT|> world", "x  y\n\n z", "x y z", "é" * 5000, "ﬁ ＡＢ", "Ａ" * 50,
         "<|startoftext|>", "🙂 mixed ÅÉ text", "word " * 60_000, "a", "a"]


def reference_count(name):
    if name.endswith(".model"):
        import sentencepiece
        m = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        return lambda t: len(m.encode(t))
    from tokenizers import Tokenizer
    m = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda t: len(m.encode(t, add_special_tokens=False).ids)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts(spark, name):
    rows = [(i if i % 4 else None, t) for i, t in enumerate(TEXTS)] * 2
    docs = spark.createDataFrame(rows, DOC).withColumn("n_tokens", F.lit("own")).withColumn("a.b", F.lit(0)).withColumn("digest", F.lit(0))
    cache, count = scratch_path(spark, "test-counts"), reference_count(name)
    got = token_counts.count_tokens(docs, public_tokenizers.path(name), cache, limit=40)
    want = [(d, len((t or "").encode()), count(t or ""), count(t or "") > 40) for d, t in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_cache_counts_only_what_is_new(spark, monkeypatch):
    path, cache = public_tokenizers.path("word_bpe_49k.json"), scratch_path(spark, "test-counts")
    version = token_counts.version_digest(path)
    folder = lambda: spark.read.parquet(token_counts._folder(cache, version))
    frame = lambda texts: spark.createDataFrame([(i, t) for i, t in enumerate(texts)], DOC)
    assert token_counts.count_tokens(frame([]), path, cache).count() == 0
    assert token_counts.stored(spark, cache, version) is None
    assert token_counts.count_tokens(frame(["One two", "one  TWO", "three"]), path, cache).count() == 3
    assert folder().count() == 2  # equal once normalised
    # a planted count shows that a stored digest is not encoded again
    spark.createDataFrame([(hashlib.sha256(b"normal: four").digest(), -5)], "digest binary, n_tokens long").write.mode("append").parquet(
        token_counts._folder(cache, version))
    for few in (token_counts.FEW_MISSES, 0):  # misses found in place, or by a shuffle
        monkeypatch.setattr(token_counts, "FEW_MISSES", few)
        got = token_counts.count_tokens(frame(["Four", "three", f"five {few}"] * 700), path, cache)
        assert got.filter("n_tokens = -5").count() == 700 and got.count() == 2100
    assert folder().count() == 5 == folder().distinct().count()
    assert token_counts.version_digest(public_tokenizers.path("byte_bpe_50k.json")) != version


def test_queries_of_this_round_read_whole_tables(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    count = reference_count("byte_bpe_50k.json")
    want = sorted((d, len((t or "").encode()), count(t or ""), count(t or "") > 1024) for d, t in docs)
    assert sorted(map(tuple, q_tokens.op13_token_counts(spark, SF_SMALL).collect())) == want
    words = {r["word"]: r["n"] for r in q_spelling.op12_spelling_variants(spark, SF_SMALL).collect()}
    assert words == brute_words([tuple(d) for d in docs])
