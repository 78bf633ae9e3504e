"""The registered queries of this subpackage and the SQL they must agree with, where SQL can say it."""

from landgate.llm import (
    byte_bpe,
    html_text,
    importance,
    jaccard,
    language,
    licenses,
    packing,
    quality,
    rank_array_bpe,
    ranked_search,
    sharding,
    topk,
    urls,
)

MODULES = (
    licenses,
    quality,
    html_text,
    topk,
    language,
    jaccard,
    urls,
    sharding,
    packing,
    byte_bpe,
    rank_array_bpe,
    ranked_search,
    importance,
)
REGISTRY = {name: entry for module in MODULES for name, entry in module.QUERIES.items()}
