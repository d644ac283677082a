"""Derived tables kept up to date from what changed, without reading the rest again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.digest import lane_sums, lanes_fingerprint, merged_lanes
from stratalake.layout import delete_folder, file_system, folder_exists
from stratalake.operators.change import classify_change, late_years, relabelled, year_edges
from stratalake.operators.monthly import monthly_trend
from stratalake.session import staged
from stratalake.sinks import write_partitioned


class LabelledSeries:
    """Change labels (hike, cut, hold) of many series, rows in folders by year.

    Beside the rows lie the edges: first and last day of each series and year, and the last value. A
    late or corrected row reads the years whose labels it can change and the edges, nothing else.
    Days are unique per series and the value is not NULL.
    """

    def __init__(
        self, spark: SparkSession, path: str, series: Sequence[str], day: str, value: str
    ) -> None:
        self.spark, self.series, self.day, self.value = spark, list(series), day, value
        self.rows_path, self.edges_path = f"{path}/rows", f"{path}/edges"

    def rows(self, years: Sequence[int] | None = None) -> DataFrame:
        stored = self.spark.read.parquet(self.rows_path)
        return stored if years is None else stored.filter(F.col("year").isin(list(years)))

    def edges(self) -> DataFrame:
        return self.spark.read.parquet(self.edges_path)

    def _store(self, labelled: DataFrame) -> None:
        """Replace the years of ``labelled``. Edges come second and follow from the rows, so a job
        that is repeated after either write ends in the same state."""
        dated = labelled.withColumn("year", F.year(self.day))
        write_partitioned(dated, self.rows_path, ["year"], [*self.series, self.day])
        write_partitioned(year_edges(labelled, self.series, self.day, self.value), self.edges_path, ["year"])

    def build(self, rows: DataFrame) -> None:
        """Label everything."""
        labelled = classify_change(rows, self.series, [self.day], self.value, [F.year(self.day)])
        self._store(staged(labelled, "labelled"))

    def apply(self, late: DataFrame) -> list[int]:
        """Insert or correct rows, and return the years that were read and rewritten."""
        late = staged(late, "late-rows")
        touched = late_years(self.edges(), late, self.series, self.day)
        years = sorted(r.year for r in touched.collect())  # at most as many as there are years
        if years:
            outside = self.edges().filter(~F.col("year").isin(years))
            fresh = relabelled(self.rows(years), late, outside, self.series, self.day, self.value)
            self._store(staged(fresh, "relabelled"))
        return years


class StoredTrend:
    """The monthly chart, one stored row per month.

    Its sources lie in folders by ``month`` (``yyyy-MM``). After inserts, corrections or removals the
    months concerned are aggregated anew from their folders, all others are taken over. Each
    refresh is a version of its own, so a reader never sees half of one.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def _versions(self) -> list[int]:
        if not folder_exists(self.spark, self.path):
            return []
        files, target = file_system(self.spark, self.path)
        names = [s.getPath().getName() for s in files.listStatus(target)]
        complete = [n for n in names if folder_exists(self.spark, f"{self.path}/{n}/_SUCCESS")]
        return sorted(int(n.removeprefix("version=")) for n in complete if n.startswith("version="))

    def current(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/version={self._versions()[-1]}")

    def _write(self, trend: DataFrame) -> None:
        versions = self._versions()
        number = versions[-1] + 1 if versions else 0
        # One row per month.
        trend.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/version={number}")
        for old in versions[:-1]:  # the one before may still be read
            delete_folder(self.spark, f"{self.path}/version={old}")

    def build(self, macro: DataFrame, fx: DataFrame) -> None:
        self._write(monthly_trend(macro, fx))

    def refresh(self, macro: DataFrame, fx: DataFrame, months: Sequence[str]) -> None:
        """Take over all months but ``months``, which are read again; one without rows goes."""
        named = F.col("month").isin(list(months))
        again = monthly_trend(macro.filter(named), fx.filter(named))
        others = self.current().filter(~F.col("period").isin(list(months)))
        self._write(others.unionByName(again))


class StoredFingerprints:
    """Lane sums of a dataset's parts, from which the fingerprint of any union of parts follows.

    A changed part is read again and replaces its sums; a fingerprint of the whole dataset, of a
    month or a year, adds up a few numbers per part.
    """

    def __init__(self, spark: SparkSession, path: str, parts: Sequence[str], columns: Sequence[str]) -> None:
        self.spark, self.path = spark, path
        self.parts, self.columns = list(parts), list(columns)

    def update(self, rows: DataFrame) -> None:
        """Replace the sums of the parts that ``rows`` holds, whole."""
        named = rows.withColumns({p: F.col(p).cast("string") for p in self.parts})
        write_partitioned(lane_sums(named, self.columns, self.parts), self.path, self.parts)

    def sums(self) -> DataFrame:
        """One row per part; the names of parts are texts."""
        kinds = ["row_count bigint", *[f"lane{i} decimal(38,0)" for i in range(4)]]
        schema = ", ".join([*kinds, *[f"`{p}` string" for p in self.parts]])
        return self.spark.read.schema(schema).parquet(self.path)

    def fingerprint(self, by: Sequence[str] = ()) -> DataFrame:
        """``by..., row_count, sha256_hash``, equal to the fingerprint taken from the rows."""
        return lanes_fingerprint(merged_lanes(self.sums(), by), by)
