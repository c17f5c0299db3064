"""op8: packing of whole documents."""

from __future__ import annotations

from orrery.llm import packing
from orrery.llm.base import query, table


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op8_packing")
def op8_packing(spark, sf):
    tokens = packing.tokenise(table(spark, sf, "documents").select("doc_id", "text"), tokenizer_file())
    return packing.pack(tokens, packing.CAPACITY).drop("part", "row")
