"""Five-stage pipeline over ``documents``: quality, toxicity, near-duplicates,
mixing, packing.  Every stage is one operator of ``orrery.llm`` over all that
its predecessor kept; its result is written as Parquet and read again.

Each stage but the last returns the columns it was given.  Defined results
for nulls, empty and repeated rows are those of the stage's operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orrery.llm import mixing, packing, quality, simhash, toxicity
from orrery.llm.base import cut_lineage, table
from orrery.llm.q_packing import tokenizer_file


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose quality score is below 0.7."""
    model = quality.train(docs, quality.trusted(table(spark, sf_dir, "labels"), 4, 2))
    return quality.accepted(docs, model)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose toxicity score is 0.5 or more."""
    model = toxicity.train(docs, toxicity.marked(table(spark, sf_dir, "labels"), 5, 0))
    return toxicity.clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near-duplicates (4 words, 4 bits)."""
    return simhash.first_of_each(docs, n=4, max_bits=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the mix does."""
    return mixing.mixture(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences of at most 2048 tokens."""
    return packing.pack(packing.tokenise(docs, tokenizer_file())).drop("part", "row")


STAGES = [
    ("quality", keep_good),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: the stages' models and tokens are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
