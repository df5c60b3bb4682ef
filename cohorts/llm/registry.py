"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from cohorts.llm import align, ann, audit, bpe, chunks, jaccard, lines, mixing, quality, secrets, urls, warc, winnow
from cohorts.llm.tables import Query

MODULES = [align, ann, audit, bpe, chunks, jaccard, lines, mixing, quality, secrets, urls, warc, winnow]


def queries() -> dict[str, Query]:
    return {name: run for module in MODULES for name, run in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for module in MODULES for name, text in module.SQL.items()}
