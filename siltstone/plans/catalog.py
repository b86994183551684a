"""Query catalogue of the library's own operators, with equivalent SQL."""

from __future__ import annotations

from . import catalogue, chat, crawl, fields, models, retrieval, sinks, streams, texts, training  # noqa: F401  (they register their queries)
from .registry import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
