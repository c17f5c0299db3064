"""Packing documents into fixed-length sequences by minimum bin slack.

Each document is tokenised once into ids and an end id.  Full windows of
``capacity`` ids are cut off as sequences of their own; what remains of a
document (less than a window) is packed whole wherever possible.

Only the remaining lengths matter for that, so the plan is made from their
histogram (at most ``capacity`` - 1 numbers, however many documents there
are): the largest length left opens a window, a subset-sum program over the
multiset of lengths, kept as a bit set of reachable sums, finds the filling
that comes closest to capacity, and is traced back to counts per length.
The same filling is used for as many windows as the counts allow, which
uses up a length each time, so the plan has few entries.  Where no filling
is exact, the gap is closed by cutting one more document, whose rest goes
back into the histogram.  The last ids, less than a window, are cut into
sequences whose lengths are powers of two, which need no padding.

Documents find their place without a shuffle of their ids: a task numbers
the documents of each length as it tokenises, per-task counts are summed
into offsets, and length and number lead to window and offset.

Defined results: null text is empty (one id: the end); every row is packed,
repeated rows and ids included; an empty table gives no pieces; rows keep
nothing of other columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.base import cut_lineage, text_or_empty
from orrery.session import bounded_broadcast

CAPACITY = 2048
END_ID = 1
#: pre-tokenisation of the byte-level vocabularies (fixed value)
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
         "part long, row long")


def load_encoder(path: str):
    """(text -> array of ids as the tokenizer file at ``path`` gives them
    without special tokens added, bytes that an id needs: 2 or 4).  Byte-level BPE files whose ids follow
    their merges are run by ``tiktoken``, which is several times faster with
    equal ids; all others by ``tokenizers`` itself."""
    import json
    import re

    import numpy as np
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre, added = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("added_tokens") or []
    merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model.get("merges", [])]
    vocab = model.get("vocab", {})
    plain = (model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
             and pre.get("use_regex", True) and spec.get("normalizer") is None and not model.get("ignore_merges")
             and not any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in added)
             and all(vocab[a + b] == 256 + i for i, (a, b) in enumerate(merges)))
    if plain:
        import tiktoken
        # the printable stand-ins of bytes in such files
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        stand = {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in kept)}
        special = {a["content"]: a["id"] for a in added}
        ranks = {bytes(stand[c] for c in t): i for t, i in vocab.items() if t not in special}
        enc = tiktoken.Encoding("file", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
        cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None

        def encode(text):
            if cut is None or not cut.search(text):
                return enc.encode_to_numpy(text, disallowed_special=())
            parts = [np.array([special[p]], np.uint32) if p in special else enc.encode_to_numpy(p, disallowed_special=())
                     for p in cut.split(text) if p]
            return np.concatenate(parts)
        return encode, 2 if max([*vocab.values(), *special.values()]) < 1 << 16 else 4
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    wide = 2 if tok.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
    return (lambda text: np.array(tok.encode(text, add_special_tokens=False).ids, np.uint32)), wide


TOKENS = ("doc_id long, part long, row long, doc_tokens long, fulls array<long>, fulls_before long, rest long, "
          "rest_crc long, rest_rank long, ids binary")


def _tokenise(path: str, capacity: int, end_id: int):
    def run(batches):
        from collections import Counter
        from zlib import crc32

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        (encode, wide), part = load_encoder(path), TaskContext.get().partitionId()
        row, fulls_before, ranks = 0, 0, Counter()
        end, kept = np.array([end_id], np.uint32), "<u2" if wide == 2 and end_id < 1 << 16 else "<u4"
        for b in batches:
            for a in range(0, b.num_rows, 512):
                piece, out = b.slice(a, 512), []
                for doc, text in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()):
                    ids = np.concatenate([encode(text), end]).astype("<u4")
                    n = len(ids) // capacity
                    crcs = [crc32(ids[i * capacity:(i + 1) * capacity].tobytes()) for i in range(n)]
                    rest = ids[n * capacity:]
                    out.append((doc, part, row, len(ids), crcs, fulls_before, len(rest), crc32(rest.tobytes()),
                                ranks[len(rest)], ids.astype(kept).tobytes()))
                    row, fulls_before = row + 1, fulls_before + n
                    ranks[len(rest)] += 1
                cols = list(zip(*out)) or [()] * 10
                kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] + [pa.int64()] * 4 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                                 names=[f.strip().split(" ")[0] for f in TOKENS.split(",")])
    return run


def tokenise(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The committed token table of (doc_id, text): ids (little-endian
    unsigned numbers of 2 or 4 bytes, as the vocabulary needs) with checksums of the full windows and of the rest, and
    the running numbers within the task that made the row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return cut_lineage(rows.mapInArrow(_tokenise(path, capacity, end_id), TOKENS))


def fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The sub-multiset of ``counts`` (length -> how many) whose sum comes
    closest to ``room`` from below."""
    mask, reach, stages = (1 << (room + 1)) - 1, 1, []
    for length in sorted((x for x in counts if x <= room and counts[x] > 0), reverse=True):
        most = min(counts[length], room // length)
        stages.append((length, most, reach))
        step, left = 1, most
        while left:  # 1, 2, 4, ... copies at a time
            step = min(step, left)
            reach |= (reach << (step * length)) & mask
            left -= step
            step *= 2
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for length, most, before in reversed(stages):
        n = next(j for j in range(most + 1) if total >= j * length and before >> (total - j * length) & 1)
        if n:
            used[length] = n
            total -= n * length
    return used


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple], int]:
    """(slots, number of sequences) for remaining lengths.

    A slot places ``count`` items of one length, numbered from ``rank``:
    (length, rank, count, per, sequence, offset, take, next_rank).  Item i
    goes to sequence + i // per at offset + (i % per) * take.  ``take`` is
    the length itself, or less for a cut item, whose other length - take ids
    are item next_rank + i of that length."""
    left = {x: n for x, n in histogram.items() if n > 0}
    made = dict(left)           # items numbered so far
    done = dict.fromkeys(left, 0)  # items placed so far
    slots, sequence = [], 0

    def place(length, count, per, offset, take=None):
        take = length if take is None else take
        after = -1
        if take < length:
            rest = length - take
            after = made.get(rest, 0)
            made[rest], left[rest] = after + count, left.get(rest, 0) + count
            done.setdefault(rest, 0)
        slots.append((length, done[length], count, per, sequence, offset, take, after))
        done[length] += count
        left[length] -= count
        if not left[length]:
            del left[length]

    total = sum(x * n for x, n in left.items())
    while total >= capacity:
        seed = max(left)
        pool = dict(left)
        pool[seed] -= 1
        used = fill(pool, capacity - seed)
        used[seed] = used.get(seed, 0) + 1
        gap = capacity - sum(x * n for x, n in used.items())
        cut = None
        if gap:  # whatever is left over is longer than the gap: cut the commonest
            over = {x: n - used.get(x, 0) for x, n in left.items() if n > used.get(x, 0)}
            cut = max(over, key=lambda x: (over[x], x))
        need = dict(used)
        if cut is not None:
            need[cut] = need.get(cut, 0) + 1
        times = min(left[x] // n for x, n in need.items())
        offset = 0
        for length in sorted(used, reverse=True):
            place(length, used[length] * times, used[length], offset)
            offset += length * used[length]
        if cut is not None:
            place(cut, times, 1, offset, gap)
        sequence += times
        total -= capacity * times
    # the last ids: one sequence for each power of two in their number
    for bit in range(capacity.bit_length() - 1, -1, -1):
        if not total >> bit & 1:
            continue
        room, offset = 1 << bit, 0
        while offset < room:
            length = max(left)
            take = min(length, room - offset)
            place(length, 1, 1, offset, take)
            offset += take
        sequence += 1
    return slots, sequence


def _place_kernel(slots: list[tuple], capacity: int, first: int):
    """Numbered rests -> pieces; checksums of cut pieces stay null."""
    import numpy as np
    by = {}
    for s in slots:
        by.setdefault(s[0], []).append(s[1:])
    tables = {k: np.array(sorted(v), np.int64) for k, v in by.items()}

    def run(batches):
        import pyarrow as pa
        names = [f.strip().split(" ")[0] for f in PIECE.split(",")]
        for b in batches:
            out = []
            for doc, part, row, n, fulls, seq, rest, crc, rank in zip(*(b.column(c).to_pylist() for c in (
                    "doc_id", "part", "row", "doc_tokens", "fulls", "full_id", "rest", "rest_crc", "rank"))):
                for i, c in enumerate(fulls):
                    out.append((doc, i * capacity, capacity, c, n, seq + i, 0, part, row))
                start, length = len(fulls) * capacity, rest
                while length:
                    t = tables[length]
                    r, _, per, window, offset, take, after = t[np.searchsorted(t[:, 0], rank, "right") - 1].tolist()
                    i = rank - r
                    out.append((doc, start, take, crc if take == rest else None, n, first + window + i // per,
                                offset + i % per * take, part, row))
                    start, length, rank = start + take, length - take, after + i
            cols = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)
    return run


def _cut_crc(batches):
    from zlib import crc32

    import numpy as np
    import pyarrow as pa
    names = [f.strip().split(" ")[0] for f in PIECE.split(",")]
    for b in batches:
        crc = []
        for ids, total, s, n in zip(*(b.column(c).to_pylist() for c in ("ids", "doc_tokens", "start", "length"))):
            kept = np.frombuffer(ids, "<u2" if len(ids) == 2 * total else "<u4")
            crc.append(crc32(kept[s:s + n].astype("<u4").tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(crc, pa.int64()) if x == "ids_crc32" else b.column(x) for x in names],
                                         names=names)


def pack(tokens: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of a token table: (doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset) and the token row (part, row)."""
    counts = cut_lineage(tokens.groupBy("part", "rest").agg(F.count("*").alias("n"),
                                                            F.sum(F.size("fulls")).alias("fulls")))
    histogram = {r["rest"]: r["n"] for r in counts.groupBy("rest").agg(F.sum("n").alias("n")).collect() if r["rest"]}
    fulls = counts.agg(F.coalesce(F.sum("fulls"), F.lit(0)).alias("n")).first()["n"]
    if max(histogram, default=0) >= capacity:
        raise ValueError("the tokens were cut for longer windows")
    slots, _ = plan(histogram, capacity)
    # running totals: of each length over the tasks, and of full windows over the tasks (a row per task)
    offsets = counts.select("part", "rest", F.coalesce(F.sum("n").over(
        Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    per_part = counts.groupBy("part").agg(F.sum("fulls").alias("f"))
    per_part = per_part.select("part", F.coalesce(F.sum("f").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("full_base"))
    offsets = offsets.join(per_part, "part")
    narrow = tokens.drop("ids").join(offsets, ["part", "rest"])
    numbered = narrow.select("doc_id", "part", "row", "doc_tokens", "fulls",
                             (F.col("full_base") + F.col("fulls_before")).alias("full_id"), "rest", "rest_crc",
                             (F.col("base") + F.col("rest_rank")).alias("rank"))
    pieces = cut_lineage(numbered.mapInArrow(_place_kernel(slots, capacity, fulls), PIECE))
    cut = pieces.filter("ids_crc32 is null")
    if not any(s[6] < s[0] for s in slots):
        return pieces
    ids = tokens.select(F.col("part").alias("_p"), F.col("row").alias("_r"), "ids")
    checked = (ids.join(bounded_broadcast(cut, 20_000), (F.col("part") == F.col("_p")) & (F.col("row") == F.col("_r")))
               .drop("_p", "_r").mapInArrow(_cut_crc, PIECE))
    return pieces.filter("ids_crc32 is not null").unionByName(checked)


def sequences(tokens: DataFrame, pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids array<long>): the packed sequences themselves,
    without padding.  A sequence holds at most ``capacity`` ids."""
    own = tokens.select(F.col("part").alias("_p"), F.col("row").alias("_r"), "ids")
    width = (F.octet_length("ids") / F.col("doc_tokens")).cast("int")
    cut = (pieces.join(own, (F.col("part") == F.col("_p")) & (F.col("row") == F.col("_r")))
           .withColumn("w", width)
           .withColumn("hex", F.hex(F.expr("substring(ids, cast(w * start + 1 as int), cast(w * length as int))"))))

    def number(h, w, i):  # little-endian: the last byte first
        return F.conv(F.concat(*[F.substring(h, (i + 1) * 2 * w - 1 - 2 * j, F.lit(2)) for j in range(w)]), 16, 10).cast("long")

    def numbers(p):
        every = F.sequence(F.lit(0), p["length"].cast("int") - 1)
        return F.when(p["w"] == 2, F.transform(every, lambda i: number(p["hex"], 2, i))).otherwise(
            F.transform(every, lambda i: number(p["hex"], 4, i)))

    ordered = F.sort_array(F.collect_list(F.struct("offset", "length", "w", "hex")))
    return cut.groupBy("sequence_id").agg(F.flatten(F.transform(ordered, numbers)).alias("ids"))
