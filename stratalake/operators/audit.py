"""Table constraints as audit queries: violations are rows, never exceptions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_violations(
    df: DataFrame, not_null: Sequence[str] = (), enums: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """NOT NULL and enumeration rules of one table in one pass: ``rule, violations``.

    As in SQL, a NULL satisfies an enumeration rule.
    """
    rules = {f"not_null:{c}": F.col(c).isNull() for c in not_null}
    for column, allowed in (enums or {}).items():
        rules[f"enum:{column}"] = ~F.col(column).isin(list(allowed))
    counted = df.agg(*[F.count_if(broken).alias(name) for name, broken in rules.items()])
    return counted.unpivot([], list(rules), "rule", "violations")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child keys without a parent, with their row count.

    Children are counted per key first, so a hot key crosses the shuffle as one row per task.
    """
    counts = child.filter(F.col(child_key).isNotNull()).groupBy(child_key).agg(
        F.count(F.lit(1)).alias("rows")
    )
    parents = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return counts.join(parents, child_key, "left_anti")


def key_rule(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rule, violations``: surplus rows under a uniqueness rule."""
    surplus = duplicate_keys(df, keys).agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("violations"))
    return surplus.select(F.lit(f"unique:{','.join(keys)}").alias("rule"), "violations")


def reference_rule(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """``rule, violations``: rows under a foreign-key rule."""
    lost = orphans(child, parent, child_key, parent_key).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("violations")
    )
    return lost.select(F.lit(f"foreign_key:{child_key}").alias("rule"), "violations")
