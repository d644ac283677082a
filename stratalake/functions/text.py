"""Text, path and URI expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalake.constants import ELLIPSIS

_URI = r"^s3a?://([^/]+)/(.+)$"


def uri_bucket(uri: Column) -> Column:
    """Bucket of an ``s3://`` or ``s3a://`` URI, NULL for any other text."""
    return F.nullif(F.regexp_extract(uri, _URI, 1), F.lit(""))


def uri_key(uri: Column) -> Column:
    return F.nullif(F.regexp_extract(uri, _URI, 2), F.lit(""))


def to_s3a(path: Column, bucket: str) -> Column:
    """Bare keys and ``s3://`` URIs to ``s3a://`` URIs."""
    return (
        F.when(path.startswith("s3a://"), path)
        .when(path.startswith("s3://"), F.regexp_replace(path, "^s3://", "s3a://"))
        .otherwise(F.concat(F.lit(f"s3a://{bucket}/"), path))
    )


def plain_dsn(url: Column, driver: str) -> Column:
    """Drop a ``+driver`` suffix from a database URL's scheme."""
    return F.replace(url, F.lit(f"+{driver}://"), F.lit("://"))


def partition_key(day: Column) -> Column:
    """``year=2024/month=03``."""
    return F.date_format(day, "'year='yyyy'/month='MM")


def prefix8(text: Column) -> Column:
    return F.substring(text, 1, 8)


def left_ellipsis(text: Column, longest: int = 48, kept: int = 45) -> Column:
    """Keep the tail of long paths behind an ellipsis."""
    tail = F.concat(F.lit(ELLIPSIS), F.right(text, F.lit(kept)))
    return F.when(F.length(text) > longest, tail).otherwise(text)
