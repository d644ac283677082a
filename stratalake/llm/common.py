"""What the training-data operators share: reading, text normalisation, bounded Arrow batches."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.session import staged

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Byte table that lower-cases A-Z and leaves every other byte alone.
ASCII_LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased, other letters untouched.

    A text without multi-byte characters takes the fast built-in path.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def fold_of(doc_id: Column, folds: int) -> Column:
    """``crc32`` of the id as text, modulo ``folds``. A NULL id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def words(text: bytes | None) -> list[bytes]:
    """Lower-cased words: runs of bytes other than space, tab, LF, VT, FF, CR."""
    return text.translate(ASCII_LOWER).split() if text else []


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs started inside the block; the old values come back after."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


#: Names of a row's place: its file and its position in it. A table may have columns called so.
FILE, ROW = "__file", "__row"


def row_keys(docs: DataFrame) -> tuple[DataFrame, tuple[str, ...]]:
    """``docs``, rows of Parquet files, with columns that tell its rows apart, and their names."""
    meta = docs.metadataColumn("_metadata")
    keyed = docs.select(
        *[docs[c] for c in docs.columns if c not in (FILE, ROW)],
        meta.getField("file_path").alias(FILE),
        meta.getField("row_index").alias(ROW),
    )
    return keyed, (FILE, ROW)


def without_rows(docs: DataFrame, gone: DataFrame, purpose: str) -> DataFrame:
    """The rows of ``docs`` whose keys are not in ``gone``, with all their columns."""
    meta = docs.metadataColumn("_metadata")
    with settings(docs.sparkSession, {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}):
        listed = staged(gone.select(FILE, ROW).distinct(), purpose)
    keyed = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        meta.getField("file_path").alias(FILE),
        meta.getField("row_index").alias(ROW),
    )
    return keyed.join(listed, [FILE, ROW], "left_anti").select("row.*")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the application's Python workers, once.

    The driver serves the file to executors, which need not have the package installed.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    target = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{package.name}.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent).as_posix())
    context.addPyFile(target)
    _SHIPPED.add(context.applicationId)


def on_workers(run: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``run(spark, ...)`` with this package known to the workers."""

    @wraps(run)
    def shipped(spark: SparkSession, *args) -> DataFrame:
        ship_package(spark)
        return run(spark, *args)

    return shipped
