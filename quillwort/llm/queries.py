"""All queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from quillwort.llm import (
    bpe_queries,
    incremental_queries,
    leakage_queries,
    mixing_queries,
    overlap_queries,
    residue_queries,
    splits_queries,
)
from quillwort.llm.sql import SQL

QUERIES = {
    name: query
    for module in (splits_queries, mixing_queries, incremental_queries, overlap_queries, bpe_queries, leakage_queries, residue_queries)
    for name, query in module.QUERIES.items()
}

__all__ = ["QUERIES", "SQL"]
