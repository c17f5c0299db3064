"""op4: SimHash near-duplicates over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.llm import simhash
from orrery.llm.base import query, table


@query("op4_simhash")
def op4_simhash(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs, n=4, max_bits=4)
    return found.select("doc_id", simhash.hex_digits(F.col("f")).alias("fingerprint"), "component_id")
