"""Where each layer lives below the lake's root."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession


def first_day(day: date) -> date:
    return day.replace(day=1)


def batch_folder(day: date) -> str:
    return f"year={day.year}/month={day.month:02d}"


@dataclass(frozen=True)
class Lake:
    """Path helper; ``root`` is any URI Spark can write to."""

    root: str

    def path(self, key: str) -> str:
        """Keys are relative to the root, full URIs and absolute paths stay as they are."""
        if key.startswith("s3://"):
            return "s3a://" + key.removeprefix("s3://")
        if "://" in key or key.startswith("/"):
            return key
        return f"{self.root.rstrip('/')}/{key}"

    def bronze(self, source: str) -> str:
        return self.path(f"bronze/{source}")

    def silver(self, source: str) -> str:
        return self.path(f"silver/{source}")

    def gold(self, dataset: str) -> str:
        return self.path(f"gold/{dataset}")

    def quarantine(self, dataset: str) -> str:
        return self.path(f"quarantine/{dataset}")

    def metadata(self, table: str) -> str:
        return self.path(f"metadata/{table}")

    def snapshot(self, layer_path: str, day: date) -> str:
        return f"{layer_path}/{batch_folder(day)}"


def readable(spark: SparkSession, path: str) -> bool:
    """Does a Parquet dataset exist at ``path``? Other failures are not hidden."""
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def file_system(spark: SparkSession, path: str):
    """Hadoop file system and path object of a URI."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def folder_exists(spark: SparkSession, path: str) -> bool:
    files, target = file_system(spark, path)
    return files.exists(target)


def folder_size(spark: SparkSession, path: str) -> int:
    """Bytes stored below a folder."""
    files, target = file_system(spark, path)
    return files.getContentSummary(target).getLength()


def data_files(spark: SparkSession, path: str) -> list[str]:
    """All data files below a folder, or the file itself, in order of their names."""
    files, target = file_system(spark, path)
    listed, found = files.listFiles(target, True), []
    while listed.hasNext():
        file = listed.next().getPath()
        if not file.getName().startswith(("_", ".")):
            found.append(file.toString())
    return sorted(found)


def delete_folder(spark: SparkSession, folder: str) -> None:
    files, target = file_system(spark, folder)
    files.delete(target, True)


def move_folder(spark: SparkSession, folder: str, to: str) -> None:
    """Rename a folder; what was at ``to`` is replaced."""
    files, source = file_system(spark, folder)
    _, target = file_system(spark, to)
    files.mkdirs(target.getParent())
    files.delete(target, True)
    if not files.rename(source, target):
        raise OSError(f"{folder} could not be moved to {to}")


def children(spark: SparkSession, folder: str) -> list[str]:
    """Paths directly below a folder, in order; none if it does not exist."""
    files, target = file_system(spark, folder)
    return sorted(s.getPath().toString() for s in files.listStatus(target)) if files.exists(target) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    files, target = file_system(spark, path)
    stream = files.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
