"""All queries of this package: importing the modules registers them."""

from orrery.llm import (  # noqa: F401
    q_classify,
    q_dedup,
    q_html,
    q_native,
    q_packing,
    q_prefix,
    q_search,
    q_spelling,
    q_tokens,
)
from orrery.llm.base import ORACLES, QUERIES  # noqa: F401
