"""Paths of the session's file systems: whether they are there, making and removing them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


#: Lines of one compressed part file. A reader takes such a file in one task.
PART_LINES = 25_000


def write_lines(lines: DataFrame, path: str, *partitions: str) -> None:
    """Text lines as compressed part files, each short enough for a task; ``partitions`` that have rows are replaced."""
    writer = lines.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", PART_LINES)
    if partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partitions)
    writer.text(path)


def or_none(load: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``load`` reads, or None if its path does not exist yet."""
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _located(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _located(spark, path)
    return system.exists(place)


def make_folder(spark: SparkSession, path: str) -> None:
    system, place = _located(spark, path)
    system.mkdirs(place)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder and all below it; nothing if it isn't there."""
    system, place = _located(spark, path)
    system.delete(place, True)
