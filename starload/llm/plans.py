"""All queries of the subpackage; importing the plan modules registers them."""

from __future__ import annotations

from starload.llm import audit_plans, filter_plans, near_plans, page_plans, pipeline_plans, token_plans, trie_plans, version_plans  # noqa: F401
from starload.llm.registry import QUERIES

__all__ = ["QUERIES"]
