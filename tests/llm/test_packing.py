"""op8: packing plans and pieces."""

import random
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from tokenizers import Tokenizer

from orrery.llm import packing
from orrery.llm.q_packing import tokenizer_file

DOC = "doc_id long, text string, start string, ids int"


def placed(histogram, capacity):
    """Pieces per sequence when every item follows the plan's slots."""
    slots, n = packing.plan(histogram, capacity)
    by = {}
    for s in slots:
        by.setdefault(s[0], []).append(s[1:])
    out = [[] for _ in range(n)]
    for length, count in histogram.items():
        for rank in range(count):
            left, r = length, rank
            while left:
                rank0, cnt, per, seq, offset, take, after = max(x for x in by[left] if x[0] <= r)
                i = r - rank0
                assert i < cnt
                out[seq + i // per].append((offset + i % per * take, take))
                left, r = left - take, after + i
    return out


@pytest.mark.parametrize("histogram", [
    {}, {1: 1}, {2047: 1}, {1500: 40}, {1024: 7}, {2000: 3, 48: 2, 47: 1}, {683: 10, 682: 9}, {7: 5000},
    {x: random.Random(x).randint(0, 9) for x in range(1, 2048)}, {x: 1 for x in range(1024, 2048)}])
def test_plan_places_everything_once_without_padding(histogram):
    out = placed(histogram, 2048)
    total = sum(k * n for k, n in histogram.items())
    lengths = []
    for pieces in out:
        at = 0
        for offset, take in sorted(pieces):
            assert offset == at
            at += take
        lengths.append(at)
    assert sum(lengths) == total
    assert all(x & (x - 1) == 0 for x in lengths) and lengths.count(2048) == total // 2048


def test_fill_is_the_best_subset_sum():
    rng = random.Random(2)
    for _ in range(150):
        counts = {rng.randint(1, 40): rng.randint(1, 3) for _ in range(rng.randint(1, 6))}
        room = rng.randint(1, 60)
        sums = {0}
        for x, n in counts.items():
            sums = {s + x * k for s in sums for k in range(n + 1) if s + x * k <= room}
        used = packing.fill(counts, room)
        assert sum(x * n for x, n in used.items()) == max(sums)
        assert all(0 < n <= counts[x] for x, n in used.items())


def test_whole_documents_fill_windows_without_cuts_when_they_can():
    slots, n = packing.plan({1500: 4, 548: 4}, 2048)
    assert n == 4 and all(s[6] == s[0] for s in slots)


TEXTS = ["", None, "a", "Hello <|endoftext|> world  \n\n x", "déjà vu 😀 　 it's 1234 we'll", "word " * 30_000, "\x1c odd\x85 space", "tie", "tie",
         "x" * 3000] + [f"some text number {i} " * (i * 7 % 90) for i in range(60)]


def test_pieces_cover_every_document(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(7, "tie", "y", 2), (None, "no id", "z", 3)]
    tokens = packing.tokenise(spark.createDataFrame(rows, DOC).repartition(4), tokenizer_file(), 256)
    with pytest.raises(ValueError):
        packing.pack(tokens, 128)
    got = packing.pack(tokens, 256).collect()
    tok = Tokenizer.from_file(tokenizer_file())
    want = Counter()
    for i, t, _, _ in rows:
        want[(i, tuple(tok.encode(t or "", add_special_tokens=False).ids + [1]))] += 1
    by_row, seq = {}, {}
    for r in got:
        by_row.setdefault((r["part"], r["row"], r["doc_id"]), []).append(r)
        seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    packed = {r["sequence_id"]: r["ids"] for r in packing.sequences(tokens, packing.pack(tokens, 256)).collect()}
    again = {r["sequence_id"]: r for r in got}
    assert set(packed) == set(again)
    seen = Counter()
    for (_, _, doc), rs in by_row.items():
        ids = []
        for r in sorted(rs, key=lambda r: r["start"]):
            assert r["start"] == len(ids) and r["length"] > 0
            part = packed[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]]
            assert crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
            ids += part
        assert rs[0]["doc_tokens"] == len(ids)
        seen[(doc, tuple(ids))] += 1
    assert seen == want
    for pieces in seq.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at <= 256 and at & (at - 1) == 0
    assert sorted(seq) == list(range(len(seq)))


def test_nothing_to_pack(spark):
    tokens = packing.tokenise(spark.createDataFrame([], DOC), tokenizer_file())
    assert packing.pack(tokens).count() == 0


def test_encoder_equals_the_tokenizer_file():
    encode, width = packing.load_encoder(tokenizer_file())
    tok = Tokenizer.from_file(tokenizer_file())
    rng = random.Random(5)
    for t in [*(t for t in TEXTS if t), *("".join(chr(rng.choice([32, 10, 39, 65, 0xE9, 0x2028, 0x1F600, 0x4E2D, 48, 9])) for _ in range(50))
                                          for _ in range(200))]:
        assert encode(t).tolist() == tok.encode(t, add_special_tokens=False).ids
    assert width == 2
    other, _ = packing.load_encoder(tokenizer_file("word_bpe_49k.json"))
    assert other("Hello there").tolist() == Tokenizer.from_file(tokenizer_file("word_bpe_49k.json")).encode("Hello there", add_special_tokens=False).ids
