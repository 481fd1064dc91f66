"""The operators' queries, and their SQL where SQL can say the same."""

from __future__ import annotations

from forgemeter.llm import (
    collocations,
    htmltext,
    idfiles,
    jaccard,
    lattice,
    licenses,
    nbest,
    packing,
    quality,
    substrings,
    tokencount,
    toxicity,
    turntrie,
)

MODULES = (
    packing,
    lattice,
    substrings,
    idfiles,
    quality,
    jaccard,
    htmltext,
    tokencount,
    toxicity,
    nbest,
    collocations,
    turntrie,
    licenses,
)

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
