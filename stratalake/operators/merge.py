"""Upsert, insert-if-absent and partial update as DataFrame functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.operators.latest import latest_per_key


def upsert_latest(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], newest_by: Sequence[str]
) -> DataFrame:
    """Union, then the newest row per key: one shuffle, pruned to one row per key before it."""
    return latest_per_key(target.unionByName(updates), keys, newest_by)


def first_per_key(rows: DataFrame, keys: Sequence[str], oldest_by: Sequence[str]) -> DataFrame:
    """The row with the least ``oldest_by`` per key, reduced in every map task."""
    firsts = rows.groupBy(*keys).agg(
        F.min_by(F.struct(*rows.columns), F.struct(*oldest_by)).alias("_row")
    )
    return firsts.select("_row.*")


def insert_absent(
    target: DataFrame, rows: DataFrame, keys: Sequence[str], oldest_by: Sequence[str]
) -> DataFrame:
    """The rows to append: first of each new key, keys the target already has left out.

    Both sides are reduced to one row per key before they meet, so no hot key meets a single task.
    For a target much larger than ``rows`` use :class:`stratalake.sinks.upsert.KeyIndex`.
    """
    firsts = first_per_key(rows, keys, oldest_by)
    return firsts.join(target.select(*keys).distinct(), list(keys), "left_anti")


def coalesce_update(target: DataFrame, patch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Overwrite with the patch where it has a value. ``patch`` holds each key once."""
    values = [c for c in patch.columns if c not in keys]
    new = patch.withColumnsRenamed({c: f"_new_{c}" for c in values})
    joined = target.join(new, list(keys), "left")
    merged = [F.coalesce(f"_new_{c}", c).alias(c) if c in values else F.col(c) for c in target.columns]
    return joined.select(*merged)


def fold_patches(log: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """Current rows from an append-only change log.

    Per column the last value that is not NULL wins. It is one aggregation with map-side combine,
    the log-structured form of :func:`coalesce_update`.
    """
    values = [c for c in log.columns if c not in keys and c != sequence]
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(sequence))).alias(c) for c in values]
    return log.groupBy(*keys).agg(*last)
