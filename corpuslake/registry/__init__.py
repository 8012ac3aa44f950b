"""Every operator as a query over the given tables, with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from .views import Views, with_views


@dataclass(frozen=True)
class Query:
    run: Callable[[Views], DataFrame]
    sql: str | None = None


def all_queries() -> dict[str, Query]:
    from . import articles, cdx, extraction, jobs, labelling, metrics, progress

    found: dict[str, Query] = {}
    for module in (articles, metrics, cdx, progress, extraction, labelling, jobs):
        overlap = found.keys() & module.QUERIES.keys()
        assert not overlap, overlap
        found.update(module.QUERIES)
    return found


__all__ = ["Query", "Views", "all_queries", "with_views"]
