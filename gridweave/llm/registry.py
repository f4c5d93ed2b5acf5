"""Registered queries of the text operators and their SQL."""

from gridweave.llm import (
    alignment, chat, fingerprints, mixing, near_duplicates, neighbours, ordinal_quality, packing, quality_rules, repeats, spelling, tokenfile, warc,
)

MODULES = [warc, fingerprints, tokenfile, quality_rules, packing, repeats, ordinal_quality, chat, mixing, near_duplicates, neighbours, spelling, alignment]
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
