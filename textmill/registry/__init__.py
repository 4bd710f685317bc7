"""All registered queries and the SQL they are checked against."""

from importlib import import_module

SECTIONS = ["io_queries", "text_queries", "filter_queries", "pii_queries", "dedup_queries", "model_queries", "plan_queries"]


def _load() -> None:
    for section in SECTIONS:
        import_module(f"textmill.registry.{section}")


def all_queries() -> dict:
    from textmill.registry.base import QUERIES

    _load()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    from textmill.registry.base import ORACLES

    _load()
    return dict(ORACLES)
