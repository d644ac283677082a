"""Comparison with the previous value of a series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.constants import CUT, HIKE, HOLD
from stratalake.operators.latest import latest_per_key
from stratalake.session import staged


def direction_of(value: Column, previous: Column) -> Column:
    """``hike``, ``cut`` or ``hold``; a first value is ``hold``."""
    return F.when(value > previous, HIKE).when(value < previous, CUT).otherwise(HOLD)


def previous_value(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str = "previous",
) -> DataFrame:
    """Plain lag: one sorted group per series.

    Right where the group is known to be small, e.g. after deduplication to one row per calendar
    day. For groups of unknown size use :func:`previous_value_split`.
    """
    window = Window.partitionBy(*series).orderBy(*order)
    return df.withColumn(out, F.lag(value).over(window))


def previous_value_split(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    value: str,
    buckets: Sequence[Column],
    out: str = "previous",
) -> DataFrame:
    """Lag for series of any size, including a single hot or global one.

    ``buckets`` cut a series into consecutive ranges of ``order``, from coarse to fine: a year, a
    day, a range of a unique key within the day. Rows are only ever sorted inside their finest
    bucket, and keep its partitioning to the end. The first row of a bucket takes the last value of
    the one before it; those values are carried level by level, each sorted inside the next coarser
    bucket, so no window holds more than one level's buckets of one bucket above. ``value`` must
    not be NULL.
    """
    # Keys without NULL, so that the join is an equality on what the windows are partitioned by.
    keys = [f"_key{i}" for i in range(len(series))]
    levels = [f"_level{i}" for i in range(len(buckets))]
    texts = [F.col(c).cast("string") for c in series]
    bucketed = df.withColumns(
        {k: F.coalesce(F.concat(F.lit("="), t), F.lit("-")) for k, t in zip(keys, texts)}
        | dict(zip(levels, buckets))
    )
    inside = Window.partitionBy(*keys, *levels).orderBy(*order)
    rows = bucketed.withColumns(
        {"_lag": F.lag(value).over(inside), "_next": F.lead(F.lit(1)).over(inside)}
    )
    lasts = rows.filter(F.col("_next").isNull()).select(*keys, *levels, F.col(value).alias("_edge"))
    lasts = staged(lasts, "lag-edges")  # every level needs them
    carried = _carried(lasts, keys, levels)
    joined = rows.join(carried, [*keys, *levels], "left")
    return joined.withColumn(out, F.coalesce("_lag", "_carried")).drop(
        "_lag", "_next", "_carried", *keys, *levels
    )


def _carried(lasts: DataFrame, keys: list[str], levels: list[str]) -> DataFrame:
    """``keys, levels, _carried``: the last value before each bucket, from one row per bucket."""
    above = [*keys, *levels[:-1]]
    beside = Window.partitionBy(*above).orderBy(levels[-1])
    here = lasts.withColumn("_carried", F.lag("_edge").over(beside)).drop("_edge")
    if len(levels) == 1:
        return here
    upper = lasts.groupBy(*above).agg(F.max_by("_edge", levels[-1]).alias("_edge"))
    upper = _carried(upper, keys, levels[:-1]).withColumnRenamed("_carried", "_above")
    joined = here.join(upper, above, "left")
    return joined.withColumn("_carried", F.coalesce("_carried", "_above")).drop("_above")


def classify_change(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    value: str,
    buckets: Sequence[Column] = (),
    out: str = "direction",
) -> DataFrame:
    """Add the direction of change against the previous value in ``order``."""
    if not buckets:
        lagged = previous_value(df, series, order, value, "_previous")
    else:
        lagged = previous_value_split(df, series, order, value, buckets, "_previous")
    return lagged.withColumn(out, direction_of(F.col(value), F.col("_previous"))).drop("_previous")


def year_edges(df: DataFrame, series: Sequence[str], day: str, value: str) -> DataFrame:
    """``series..., year, first, last, last_value``: one row per series and year."""
    return df.groupBy(*series, F.year(day).alias("year")).agg(
        F.min(day).alias("first"), F.max(day).alias("last"), F.max_by(value, day).alias("last_value")
    )


def late_years(edges: DataFrame, late: DataFrame, series: Sequence[str], day: str) -> DataFrame:
    """``year`` of every stored or late row whose label can change.

    A late row changes its own label and that of the row after it. That row lies in the same year
    or is the first one of the series' next year, among stored and late ones.
    """
    keys = [*series, "year"]
    known = edges.select(*keys, F.lit(0).alias("_given"))
    given = late.select(*series, F.year(day).alias("year"), F.lit(1).alias("_given"))
    years = known.unionByName(given).groupBy(*keys).agg(F.max("_given").alias("_given"))
    following = Window.partitionBy(*series).orderBy("year")
    after = years.withColumn("_after", F.lead("year").over(following)).filter("_given = 1")
    return after.select(F.explode(F.array("year", "_after")).alias("year")).filter("year IS NOT NULL").distinct()


def relabelled(
    stored: DataFrame,
    late: DataFrame,
    outside: DataFrame,
    series: Sequence[str],
    day: str,
    value: str,
    out: str = "direction",
) -> DataFrame:
    """Stored rows of some years together with late ones, labelled anew.

    A late row replaces the stored one of its series and day. ``outside`` holds the edges
    (:func:`year_edges`) of all other years: the row before a year's first one is the last of an
    earlier year, so those rows themselves are not needed.
    """
    columns = [c for c in late.columns if c != out]
    both = stored.select(*columns, F.lit(0).alias("_late")).unionByName(
        late.select(*columns, F.lit(1).alias("_late"))
    )
    newest = latest_per_key(both, [*series, day], ["_late"]).drop("_late")
    before = outside.select(*series, F.col("last").alias(day), F.col("last_value").alias(value))
    rows = newest.withColumn("_edge", F.lit(False)).unionByName(
        before.withColumn("_edge", F.lit(True)), allowMissingColumns=True
    )
    labelled = classify_change(rows, series, [day], value, [F.year(day)], out)
    return labelled.filter(~F.col("_edge")).drop("_edge")
