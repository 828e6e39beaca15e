"""Checked queries: every operator of the library over the given tables."""

from . import enrich_queries, relational_queries, skill_queries, source_queries, text_queries  # noqa: F401
from .base import QUERIES, SQL  # noqa: F401
