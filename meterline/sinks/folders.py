"""Folders of stored tables, on whatever file system their path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def names_below(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders right below a folder; none where it doesn't exist."""
    system, place = _place(spark, path)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place))


def numbers_below(spark: SparkSession, path: str, column: str) -> list[int]:
    """Numbers of the folders ``column=number`` right below a folder."""
    start = f"{column}="
    return sorted(int(n[len(start) :]) for n in names_below(spark, path) if n.startswith(start))


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder with all below it; False where there is none."""
    system, place = _place(spark, path)
    return system.delete(place, True)
