"""Content fingerprints."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LANES = 4
_LANE_DIGITS = 15  # 60 bits of the row digest per lane
_LIMB_BITS = 20  # a lane is added up in three parts, each of which fits a long for 2**43 rows


def sha256_hex(value: Column) -> Column:
    return F.sha2(value, 256)


def row_digest(columns: Sequence[str]) -> Column:
    """SHA-256 of the named columns, independent of the order they are listed in.

    Each value is written as ``length:text`` and NULL as ``-``, so neighbouring values cannot run
    into each other.
    """

    def framed(name: str) -> Column:
        text = F.col(name).cast("string")
        return F.coalesce(F.concat(F.length(text), F.lit(":"), text), F.lit("-"))

    return sha256_hex(F.concat(*[framed(c) for c in sorted(columns)]))


def _lanes() -> list[str]:
    return [f"lane{lane}" for lane in range(_LANES)]


def lane_sums(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``by..., row_count, lane0...``: what the fingerprint of a row set is made from, per group.

    Row digests are added up lane by lane, so every map task sends one short row per group and a
    group of any size needs neither a sort nor a collected list. Repeated rows count (a plain XOR
    cancel them). Parts of a lane are added as longs: decimals cost several times as much per row.
    """
    digest = F.col("_digest")
    lanes = [
        F.conv(F.substring(digest, 1 + lane * _LANE_DIGITS, _LANE_DIGITS), 16, 10).cast("bigint").alias(name)
        for lane, name in enumerate(_lanes())
    ]
    shifts = range(0, 4 * _LANE_DIGITS, _LIMB_BITS)
    mask = F.lit((1 << _LIMB_BITS) - 1).cast("bigint")
    sums = [
        F.sum(F.shiftright(name, shift).bitwiseAND(mask)).alias(f"_{name}_{shift}")
        for name in _lanes()
        for shift in shifts
    ]
    added = (
        df.select(*by, row_digest(columns).alias("_digest"))
        .select(*by, *lanes)
        .groupBy(*by)
        .agg(F.count(F.lit(1)).alias("row_count"), *sums)
    )

    def whole(name: str) -> Column:
        limbs = [
            F.coalesce(F.col(f"_{name}_{shift}"), F.lit(0)).cast("decimal(19,0)")
            * F.lit(1 << shift).cast("decimal(13,0)")
            for shift in shifts
        ]
        return reduce(lambda a, b: a + b, limbs).cast("decimal(38,0)").alias(name)

    return added.select(*by, "row_count", *[whole(name) for name in _lanes()])


def merged_lanes(sums: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Lane sums of larger groups from those of their parts, without reading a row again."""
    added = [
        F.coalesce(F.sum(lane), F.lit(0)).cast("decimal(38,0)").alias(lane) for lane in _lanes()
    ]
    return sums.groupBy(*by).agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"), *added)


def lanes_fingerprint(sums: DataFrame, by: Sequence[str] = (), out: str = "sha256_hash") -> DataFrame:
    """The fingerprint that lane sums stand for."""
    parts = [F.col(c).cast("string") for c in ("row_count", *_lanes())]
    return sums.select(*by, "row_count", sha256_hex(F.concat_ws(":", *parts)).alias(out))


def fingerprint(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), out: str = "sha256_hash"
) -> DataFrame:
    """Order-independent fingerprint of whole row sets, one per group."""
    return lanes_fingerprint(lane_sums(df, columns, by), by, out)


def all_true(flags: Sequence[Column]) -> Column:
    """AND of all flags; an empty list is true."""
    return reduce(lambda a, b: a & b, flags, F.lit(True))
