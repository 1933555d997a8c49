"""Registered queries: each operator run on the test tables, with equivalent SQL."""

from landflow.catalog.base import REGISTRY, Query

__all__ = ["REGISTRY", "Query", "load_all"]


def load_all() -> dict[str, Query]:
    """All registered queries, in order of definition."""
    from landflow.catalog import (  # noqa: F401
        admission_queries,
        audit_queries,
        cleaning_queries,
        duplicate_queries,
        file_queries,
        history_queries,
        load_queries,
        publish_queries,
        rule_queries,
        run_queries,
        stream_queries,
    )

    return REGISTRY
