"""Registered queries: a Spark callable and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from meterlake.queries import views


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None

    @property
    def oracle(self) -> str | None:
        return None if self.sql is None else views.with_views(self.sql)


def all_queries() -> dict[str, Query]:
    from meterlake.queries import attribution, cards, functions, insights, reports, sinks, sources, validation

    out: dict[str, Query] = {}
    for module in (cards, reports, attribution, validation, insights, sources, sinks, functions):
        twice = out.keys() & module.QUERIES.keys()
        assert not twice, twice
        out.update(module.QUERIES)
    return out
