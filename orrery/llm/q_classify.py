"""op3 and op10: quality and toxicity of whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.llm import quality, toxicity
from orrery.llm.base import query, table
from orrery.llm.sampling import fold


@query("op3_quality")
def op3_quality(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = quality.train(docs, quality.trusted(table(spark, sf, "labels"), 4, 2))
    return (quality.score(docs, model)
            .select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                    (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted")))


@query("op10_toxicity")
def op10_toxicity(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.train(docs, toxicity.marked(table(spark, sf, "labels"), 5, 0))
    return (toxicity.score(docs, model)
            .select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                    (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
                    F.size("offending").alias("offending_sentences")))
