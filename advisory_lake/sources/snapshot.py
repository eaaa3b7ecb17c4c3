"""The packed form of a file tree: one Parquet row per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from advisory_lake import schemas

ROWS_PER_FILE = 5000


def write_snapshot(files: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Every file is sorted by path, so that looking for a few names skips most of the content."""
    (
        files.select("relative_path", "file_content")
        .sortWithinPartitions("relative_path")
        .write.mode("overwrite")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", rows_per_file)
        .parquet(path)
    )


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.SNAPSHOT).parquet(path).select("relative_path", "file_content")


PUBLISHED = "published"
SEVERAL_YEARS = 0


def write_dated_snapshot(files: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """A snapshot in one folder for each year of publication; ``files`` have the column
    ``PUBLISHED``, ``SEVERAL_YEARS`` where documents of a file differ. Contents move once, so that
    a year has few files, and a year with much content has several tasks."""
    (
        files.select("relative_path", "file_content", PUBLISHED)
        .hint("rebalance", PUBLISHED)
        .sortWithinPartitions(PUBLISHED, "relative_path")
        .write.mode("overwrite")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(PUBLISHED)
        .parquet(path)
    )


def read_snapshot_of(spark: SparkSession, path: str, year: int) -> DataFrame:
    """The packed files that may hold a document of this year. Of a dated snapshot no other
    year's folder is read, of another one every file may."""
    if PUBLISHED not in spark.read.schema(schemas.SNAPSHOT).parquet(path).columns:
        return read_snapshot(spark, path)
    files = spark.read.schema(f"{schemas.SNAPSHOT}, {PUBLISHED} INT").parquet(path)
    return files.where(F.col(PUBLISHED).isin(year, SEVERAL_YEARS)).select("relative_path", "file_content")
