"""Choosing between and joining up sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def concat_series(*frames: DataFrame) -> DataFrame:
    """All series under one another, matched by column name."""
    return reduce(DataFrame.unionByName, frames)


def primary_or_fallback(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """The fallback's rows only if the primary has none, as one lazy plan.

    The test is an EXISTS subquery that stops at the first primary row; nothing is joined.
    """
    return primary.unionByName(fallback.filter(~primary.exists()))
