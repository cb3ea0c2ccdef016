"""All queries of the operators, each with the SQL that checks it where SQL can."""

from lakeops.llm.registry import ORACLES, QUERIES
from lakeops.llm import (  # noqa: F401  (each module registers its query)
    classifier,
    collocations,
    conversation_repair,
    embedding_dedup,
    html_text,
    minhash,
    mixing,
    packing,
    quality_rules,
    token_output,
    suffix_dedup,
    url_filter,
    warc,
)

__all__ = ["ORACLES", "QUERIES"]
