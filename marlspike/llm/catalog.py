"""The queries of this subpackage: name to (function, SQL or None)."""

from marlspike.llm import (
    exact_dedup,
    hash_forest,
    language_id,
    lm_score,
    mixing,
    near_dedup,
    packing,
    pieces,
    repair,
    spelling,
    surrogates,
    toxicity,
    warc,
)

MODULES = [
    language_id,
    pieces,
    surrogates,
    lm_score,
    hash_forest,
    warc,
    mixing,
    near_dedup,
    toxicity,
    exact_dedup,
    spelling,
    repair,
    packing,
]

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
