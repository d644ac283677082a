"""Projections."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def project(df: DataFrame, schema: StructType) -> DataFrame:
    """The schema's columns, each once, in schema order and type."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename; names the frame does not have are skipped."""
    return df.withColumnsRenamed(dict(names))


def keep(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Listed columns that exist, in list order."""
    return df.select(*[c for c in columns if c in df.columns])


def derive(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    return df.withColumns(dict(columns))


def computed_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """As :func:`derive`, for expensive expressions that later filters test.

    Catalyst pushes a filter through a projection by copying the expression into it, where common
    parts are then evaluated again and again. It does not push through a generator of the tested
    column, so the expressions pass one that yields exactly one row.
    """
    values = F.struct(*[value.alias(name) for name, value in columns.items()])
    packed = df.select("*", values.alias("_values"))
    single = packed.select(*df.columns, F.explode(F.array("_values")).alias("_value"))
    return single.select(*df.columns, "_value.*")


def drop(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def safe_cast(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast by column; text that does not fit becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def stamp(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Add constant columns."""
    return df.withColumns({c: F.lit(v) for c, v in values.items()})


def recode(df: DataFrame, column: str, codes: Mapping[str, str]) -> DataFrame:
    """Replace listed codes, pass others through. Any number of codes is one map literal."""
    if not codes:
        return df
    known = F.from_json(F.lit(json.dumps(dict(codes))), "map<string,string>")
    return df.withColumn(column, F.coalesce(F.try_element_at(known, F.col(column)), F.col(column)))


def recode_from(df: DataFrame, column: str, lookup: DataFrame, old: str, new: str) -> DataFrame:
    """As :func:`recode`, from a lookup table with unique ``old``; Spark sizes the join itself."""
    codes = lookup.select(F.col(old).alias("_old"), F.col(new).alias("_new"))
    joined = df.join(codes, F.col(column) == F.col("_old"), "left")
    return joined.withColumn(column, F.coalesce("_new", column)).drop("_old", "_new")


def missing_columns(required: Sequence[str], present: Sequence[str]) -> set[str]:
    return set(required) - set(present)
