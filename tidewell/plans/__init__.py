"""End-to-end jobs and the registered queries with their SQL checks."""

from importlib import import_module

QUERY_MODULES = ("queries_tables", "queries_clean", "queries_gold", "queries_models", "queries_versions")


def all_queries() -> None:
    """Import every module that registers queries."""
    for name in QUERY_MODULES:
        import_module(f"{__name__}.{name}")
