"""The registered queries of this subpackage: op1_ ... op10_ and their SQL."""

from __future__ import annotations

# all at once: a module that can't be imported makes this one fail on import, where __spark_entry__.py guards it
from . import q_bpe, q_cdc, q_fingerprints, q_neardup, q_packing, q_pii, q_quality, q_secrets, q_tokens, q_topk

MODULES = (q_tokens, q_secrets, q_bpe, q_fingerprints, q_packing, q_topk, q_neardup, q_cdc, q_pii, q_quality)


def queries() -> dict:
    return {name: query for m in MODULES for name, query in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for m in MODULES for name, sql in getattr(m, "SQL", {}).items()}
