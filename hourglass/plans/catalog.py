"""All registered queries (imports every query module once)."""

from __future__ import annotations


def registry():
    from . import queries, queries_decision, queries_depth, queries_feeds, queries_models, queries_sources, queries_stream  # noqa: F401  (registration side effect)
    from .queries import QUERIES
    return QUERIES
