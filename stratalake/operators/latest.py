"""Latest row per key, newest N, deduplication.

A small ``row_number() <= n`` is planned with a group limit on both sides of the shuffle: each map
task sends n rows per key, however many rows of a hot key it holds. The planner gives up on that
for a large n; rows are then ranked in parts of their key first, and only the first n of each part
meet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Spark's default limit for ranking before the shuffle, and the least parts of a key beyond it.
_GROUP_LIMIT = 1000
_LEAST_PARTS = 64


def newest_first(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key; ``order`` has to be total for a repeatable result."""
    if n > _GROUP_LIMIT:
        # As many parts as the cluster has shuffle partitions: a hot key is ranked by all of them.
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        part = F.pmod(F.xxhash64(*df.columns), F.lit(max(_LEAST_PARTS, partitions)))
        parts = Window.partitionBy(*keys, "_part").orderBy(*order)
        ranked = df.withColumn("_part", part).withColumn("_rank", F.row_number().over(parts))
        df = ranked.filter(F.col("_rank") <= n).drop("_part", "_rank")
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") <= n).drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``newest_by`` per key; remaining ties fall to the other columns."""
    ties = [c for c in df.columns if c not in keys and c not in newest_by]
    return top_per_key(df, keys, newest_first([*newest_by, *ties]), 1)


def dedup(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """Natural-key deduplication: the newest landing wins."""
    return latest_per_key(df, keys, newest_by)


def newest(df: DataFrame, order: Sequence[Column], limit: int, most: int | None = None) -> DataFrame:
    """Global top N: each task keeps N rows, the driver-side merge sees N per task."""
    if limit < 1 or (most is not None and limit > most):
        raise ValueError(f"limit must be between 1 and {most or 'any number'}, got {limit}")
    return df.orderBy(*order).limit(limit)
