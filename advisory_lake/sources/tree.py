"""File trees: the listing of every file, and the files' bytes.

A tree is walked once by tasks (``stores.walk``); names that start with ``_`` or ``.`` and
empty files count as files. The driver holds no listing.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from advisory_lake import schemas
from advisory_lake.functions.paths import join_path
from advisory_lake.session import few_tasks, modest_listing
from advisory_lake.sources.stores import exists, read_contents, walk

FILES_PER_TASK = 5000


def list_files(spark: SparkSession, root: str, dot_names: bool = True) -> DataFrame:
    """One row per file below ``root``, as the tree is when this is called."""
    return walk(spark, root, dot_names).select(
        "relative_path", join_path(root, F.col("relative_path")).alias("path"), "length", "modificationTime"
    )


def list_files_if_present(spark: SparkSession, root: str, dot_names: bool = True) -> DataFrame:
    """The listing, or no rows while the folder does not exist yet."""
    return list_files(spark, root, dot_names) if exists(root) else spark.createDataFrame([], schemas.LISTING)


def read_files(
    spark: SparkSession,
    root: str,
    files_per_task: int = FILES_PER_TASK,
    listing: DataFrame | None = None,
) -> DataFrame:
    """Snapshot rows of a tree: relative path and bytes of each file, of those in ``listing``
    when one is given. A file that vanishes or may not be read is left out; other errors fail."""
    listing = walk(spark, root) if listing is None else listing
    tasks = max(few_tasks(spark), -(-listing.count() // files_per_task))
    return read_contents(listing.repartition(tasks, "relative_path"), root)


def data_files(spark: SparkSession, location: str) -> DataFrame:
    """Path, length and time of a table's files, none of which is empty."""
    with modest_listing(spark):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(location)
    return files.select("path", "length", "modificationTime")


def file_sizes(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row: files and bytes of these data files; their contents are not read."""
    total = (F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
    if not paths:
        return spark.createDataFrame([], schemas.LISTING).agg(*total)
    with modest_listing(spark):
        # a path is a pattern to Spark, so what patterns are made of is escaped
        return spark.read.format("binaryFile").load([re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(p)) for p in paths]).agg(*total)
