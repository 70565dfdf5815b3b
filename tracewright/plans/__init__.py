"""Registered queries: each adapts the given tables to an operator's inputs
and states the same result in SQL."""

from importlib import import_module
from types import ModuleType

_MODULES = (
    "workload_queries",
    "log_queries",
    "catalog_queries",
    "matrix_queries",
    "detector_queries",
    "stream_queries",
    "corpus_queries",
)


def all_queries() -> ModuleType:
    """The registry with every query module loaded."""
    for module in _MODULES:
        import_module(f"{__name__}.{module}")
    return import_module(f"{__name__}.registry")
