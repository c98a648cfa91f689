"""Plans over whole tables: bindings of the given tables and the registered queries."""

from __future__ import annotations

from importlib import import_module

MODULES = ("rows", "summaries", "learning", "loading")


def _registry():
    for name in MODULES:
        import_module(f"{__name__}.{name}")
    return import_module(f"{__name__}.registry")


def all_queries() -> dict:
    """Registered queries: name to ``(spark, sf_dir) -> DataFrame``."""
    return dict(_registry().QUERIES)


def comparison_sql() -> dict[str, str]:
    """SQL that must give the same rows, for the queries SQL can express."""
    return dict(_registry().COMPARISON_SQL)
