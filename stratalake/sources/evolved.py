"""Reading Parquet folders whose files were written under different schemas.

Files are grouped by their own footers. Spark reads the footers of a list of paths in one distributed
job and merges them as long as no column changes its type; added and removed columns need no group of
their own. Where a type changes, the list is halved until every part merges, down to single files of a
folder, so a dataset without such changes costs one job and one with k changes about k log(paths). Parts
that fit together become one group again: there are as many scans as there are incompatible
schemas, each with its own column pruning and pushed filters.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stratalake.layout import data_files
from stratalake.operators.evolution import aligned, reconciled

#: Spark's error conditions for footers whose types differ.
_CONFLICTS = ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE")


def _merged_schema(spark: SparkSession, base: str, paths: Sequence[str]) -> T.StructType | None:
    """One schema for all files of ``paths``, None if a type differs."""
    reader = spark.read.option("basePath", base).option("mergeSchema", "true")
    try:
        return reader.parquet(*paths).schema
    except Py4JJavaError as error:
        if any(name in str(error.java_exception) for name in _CONFLICTS):
            return None
        raise
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return T.StructType([])  # folders without a file
        raise


def _parts(spark: SparkSession, base: str, paths: Sequence[str]) -> list[tuple[list[str], T.StructType]]:
    schema = _merged_schema(spark, base, paths)
    if schema is not None:
        return [(list(paths), schema)] if schema.fields else []
    if len(paths) == 1:
        paths = data_files(spark, paths[0])
        if len(paths) < 2:
            raise ValueError(f"the schema of {paths} contradicts itself")
    half = len(paths) // 2
    return _parts(spark, base, paths[:half]) + _parts(spark, base, paths[half:])


def _fits(a: T.StructType, b: T.StructType) -> bool:
    kinds = {f.name: f.dataType for f in a.fields}
    return all(kinds.get(f.name, f.dataType) == f.dataType for f in b.fields)


def schema_groups(
    spark: SparkSession, base: str, paths: Sequence[str]
) -> list[tuple[list[str], T.StructType]]:
    """``(paths, schema)`` per group of paths whose files agree in the type of every column."""
    groups: list[tuple[list[str], T.StructType]] = []
    for own, schema in _parts(spark, base, paths):
        for i, (known, wide) in enumerate(groups):
            if _fits(wide, schema):
                names = {f.name for f in wide.fields}
                added = [f for f in schema.fields if f.name not in names]
                groups[i] = (known + own, T.StructType([*wide.fields, *added]))
                break
        else:
            groups.append((own, schema))
    return groups


def read_evolved(
    spark: SparkSession, base: str, paths: Sequence[str], folders: T.StructType | None = None
) -> DataFrame | None:
    """All rows below ``paths`` under their reconciled schema, None if there is no file.

    ``base`` is the folder below which folder names are partition columns; ``folders`` gives their
    types, which are else taken from the names.
    """
    groups = schema_groups(spark, base, paths)
    if not groups:
        return None
    exact = spark.conf.get("spark.sql.caseSensitive", "false").lower() == "true"
    # Folder names are typed over all paths, so that no group reads them in its own way.
    if folders is None:
        folders = spark.read.option("basePath", base).schema(T.StructType([])).parquet(*paths).schema
    partitions = {f.name for f in folders.fields}

    def own(schema: T.StructType) -> T.StructType:
        data = [f for f in schema.fields if f.name not in partitions]
        return T.StructType(data + list(folders.fields))

    want = reconciled([own(schema) for _, schema in groups], exact_case=exact)
    data = [f for f in want.fields if f.name not in partitions]
    want = T.StructType(data + list(folders.fields))
    whole = None
    for members, schema in groups:
        rows = spark.read.option("basePath", base).schema(own(schema)).parquet(*members)
        rows = aligned(rows, want, exact)
        whole = rows if whole is None else whole.unionAll(rows)
    return whole
