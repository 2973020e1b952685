"""The subpackage's registered queries."""

from __future__ import annotations

from tillstream.llm import (
    bpe,
    dialogues,
    embedding_dedup,
    fingerprints,
    licenses,
    lm,
    minhash,
    mixing,
    neighbours,
    phrases,
    sharding,
    tokencounts,
    toxicity,
)

MODULES = (embedding_dedup, neighbours, licenses, lm, mixing, tokencounts, sharding, minhash, toxicity, bpe, fingerprints, phrases, dialogues)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
#: tests/llm compares those that can't be said in SQL with a brute-force version.
ORACLE: dict[str, str] = {**phrases.ORACLE}
