"""All queries of this subpackage; importing it registers them."""

from __future__ import annotations

from riskmart.llm import (  # noqa: F401
    bottom_k, fill_in_middle, jaccard, neighbours, packing, pii, quality, secrets, sentencepieces, sharding, spelling, substrings, token_counts,
)
from riskmart.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
