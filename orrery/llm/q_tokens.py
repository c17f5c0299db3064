"""op13: token counts of whole documents through a digest cache."""

from __future__ import annotations

from orrery.llm import token_counts
from orrery.llm.base import query, scratch_path, table
from orrery.llm.q_packing import tokenizer_file

LIMIT = 1024


@query("op13_token_counts")
def op13_token_counts(spark, sf):
    # a cache of this run's own: every distinct content is encoded here, once
    cache = scratch_path(spark, "token-counts")
    return token_counts.count_tokens(table(spark, sf, "documents").select("doc_id", "text"), tokenizer_file(), cache, LIMIT)
