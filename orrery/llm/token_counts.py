"""Token counts through a digest cache.

A text's count depends only on its content and on the tokenizer, so counts
are stored under (tokenizer version, digest of the normalised content) and a
text is encoded only if nobody counted the same content before:

1. every row gets its content digest and its size, the text itself stays
   behind;
2. the distinct digests are compared with the stored ones of this version;
3. of every distinct miss one text is encoded, in parallel, and its count is
   appended to the cache;
4. the rows join the stored counts.

The cache is a Parquet folder ``<cache>/version=<hex>``.  A stored row is
right on its own and never changes, so a run that dies half-way leaves
nothing wrong behind, runs may append side by side (a digest that two of them
stored counts once) and lost executors only repeat their own texts.

The version digests the tokenizer file, the library and its release.  The
normalised content is what the tokenizer's own normaliser makes of a text; a
text that holds (or, normalised, would hold) an added token is its own
content, since such tokens are found before normalising.

Scale: texts move at most once (one copy of a content for each task that
reads it), and not at all where a run brings few new contents.  Contents of
many rows join from a table that is broadcast behind a check of its size, so
a text with a third of all rows is no hot key.

Defined results: null text is empty, and an empty text has what the
tokenizer gives for it (normally 0 tokens); every row counts, repeated rows
and ids (null included) too; an empty table gives no rows and stores nothing;
the result has the columns named in ``count_tokens`` and no others.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm.base import cut_lineage, text_or_empty
from orrery.llm.packing import load_encoder
from orrery.session import small_side

#: so many distinct misses are looked for in place, by a broadcast of their digests
FEW_MISSES = 100_000
#: a content of more rows than this is joined from a broadcast table
MANY_ROWS = 500


def version_digest(path: str) -> str:
    """Hex digest of the tokenizer file, the library that runs it and its release."""
    import importlib.metadata as releases
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as f:
        body = hashlib.sha256(f.read()).hexdigest()
    return hashlib.sha256(f"{library} {releases.version(library)} {body}".encode()).hexdigest()


def load_normaliser(path: str):
    """text -> normalised content, or None where the tokenizer has no normaliser."""
    if path.endswith(".model"):
        import sentencepiece
        return sentencepiece.SentencePieceProcessor(model_file=path).normalize
    import json

    from tokenizers import Tokenizer
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if spec.get("normalizer") is None:
        return None
    normal = Tokenizer.from_file(path).normalizer.normalize_str
    added = [a["content"] for a in spec.get("added_tokens") or []]

    def content(text):
        out = normal(text)
        own = any(a in text or a in out for a in added)
        return f"as it is: {text}" if own else f"normal: {out}"
    return content


def load_counter(path: str):
    """text -> number of tokens, nothing added."""
    if path.endswith(".model"):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(model.encode(text))
    encode, _ = load_encoder(path)
    return lambda text: len(encode(text))


def content_digest(text: Column, path: str) -> Column:
    """SHA-256 of the normalised content (binary).  Without a normaliser the
    content is the text, and Spark digests it itself."""
    if load_normaliser(path) is None:
        return F.unhex(F.sha2(text, 256))

    @F.pandas_udf("binary")
    def digests(texts):
        content = load_normaliser(path)
        return texts.map(lambda t: hashlib.sha256(content(t).encode()).digest())
    return digests(text)


def _counts(path: str):
    def run(batches):
        import pyarrow as pa
        count = load_counter(path)
        for b in batches:
            n = [count(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("digest"), pa.array(n, pa.int64())], names=["digest", "n_tokens"])
    return run


def _folder(cache: str, version: str) -> str:
    return f"{cache.rstrip('/')}/version={version}"


def stored(spark: SparkSession, cache: str, version: str) -> DataFrame | None:
    """(digest, n_tokens) of a tokenizer version, one row a digest; None if there are none."""
    folder = _folder(cache, version)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return None
    rows = spark.read.schema("digest binary, n_tokens long").parquet(folder)
    return rows.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def count_misses(texts: DataFrame, distinct: DataFrame, path: str, cache: str) -> int:
    """Encodes one text of every digest of ``distinct`` that the cache lacks,
    appends the counts, and returns how many there were.  ``texts``:
    (digest, text)."""
    spark, version = texts.sparkSession, version_digest(path)
    known = stored(spark, cache, version)
    missing = cut_lineage(distinct.select("digest") if known is None else
                          distinct.select("digest").join(known, "digest", "left_anti"))
    n = missing.count()
    if n == 0:
        return 0
    texts = texts.select("digest", "text")
    if n <= FEW_MISSES:
        texts = texts.join(F.broadcast(missing), "digest", "left_semi")
    one = texts.groupBy("digest").agg(F.first("text").alias("text"))
    if n > FEW_MISSES and known is not None:
        one = one.join(missing, "digest", "left_semi")
    one.mapInArrow(_counts(path), "digest binary, n_tokens long").write.mode("append").parquet(_folder(cache, version))
    return n


def count_tokens(docs: DataFrame, path: str, cache: str, limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs``
    (doc_id, text): UTF-8 bytes, tokens, more tokens than ``limit``.
    ``cache``: a shared folder, kept from run to run."""
    spark = docs.sparkSession
    text = text_or_empty()
    texts = docs.select("doc_id", text.alias("text"), content_digest(text, path).alias("digest"))
    rows = cut_lineage(texts.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")))
    distinct = cut_lineage(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")))
    count_misses(texts, distinct, path, cache)
    counts = stored(spark, cache, version_digest(path))
    if counts is None:  # an empty table and nothing stored
        counts = spark.createDataFrame([], "digest binary, n_tokens long")
    often = small_side(distinct.filter(F.col("n") > MANY_ROWS).join(counts, "digest").select("digest", "n_tokens"))
    found = rows.join(often, "digest").unionByName(rows.join(often, "digest", "left_anti").join(counts, "digest"))
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
