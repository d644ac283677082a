"""Seed CSV files, used when a publisher's table comes back empty."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.constants import BSP_FX, FX_SEED_SOURCE, PSA, PSA_SEED_SOURCE, USD_PHP


def _header_csv(spark: SparkSession, path: str | list[str]) -> list[DataFrame]:
    """Files in groups of equal headers, all columns as text under the names of that header.

    So columns are bound by name whatever their order and number. Numbers are cast afterwards: a
    bad cell costs its row or its value, never the job.
    """
    place = F.monotonically_increasing_id()
    lines = spark.read.text(path).filter("_metadata.file_block_start = 0")
    headers = (
        lines.select(F.col("_metadata.file_path").alias("file"), "value", place.alias("place"))
        .groupBy("file")
        .agg(F.min_by("value", "place").alias("header"))
        .groupBy("header")
        .agg(F.sort_array(F.collect_list("file")).alias("files"))
    )
    # One row per distinct header, with the names of files that the read lists anyway.
    groups = [[unquote(f) for f in row.files] for row in headers.orderBy("header").collect()]
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    return [reader.csv(files) for files in groups or [path]]


def _or_default(df: DataFrame, name: str, default: str) -> Column:
    """The column if the file has it, else a constant."""
    return (F.col(name) if name in df.columns else F.lit(default)).alias(name)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def read_cpi_seed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``series_code, period, value, unit, source``; an empty value is NULL."""
    return _union(
        [
            raw.select(
                "series_code",
                "period",
                F.col("value").try_cast("double").alias("value"),
                _or_default(raw, "unit", ""),
                _or_default(raw, "source", PSA_SEED_SOURCE),
            )
            for raw in _header_csv(spark, path)
        ]
    )


def read_fx_seed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``rate_date, currency_pair, rate, source``; rows with an unreadable rate are skipped."""
    text = F.nullif(F.trim("rate"), F.lit(""))
    rate = text.try_cast("double")
    return _union(
        [
            raw.filter(text.isNull() | rate.isNotNull()).select(
                "rate_date",
                _or_default(raw, "currency_pair", USD_PHP),
                rate.alias("rate"),
                _or_default(raw, "source", FX_SEED_SOURCE),
            )
            for raw in _header_csv(spark, path)
        ]
    )


READERS = {PSA: read_cpi_seed, BSP_FX: read_fx_seed}
