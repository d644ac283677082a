"""Registered queries over the test tables, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from stratalake.plans.serving import as_json_rows

Runner = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Runner
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None) -> Callable[[Runner], Runner]:
    """Register a query; dates in its result are rendered as ISO text, as the read API does."""

    def register(build: Runner) -> Runner:
        REGISTRY[name] = Query(lambda spark, sf: as_json_rows(build(spark, sf)), sql)
        return build

    return register


def load_all() -> dict[str, Query]:
    from workload import (  # noqa: F401
        evolution,
        layers,
        metadata,
        quality,
        serving,
        sources,
        upkeep,
        writes,
    )

    return REGISTRY
