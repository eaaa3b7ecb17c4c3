"""Fixed parallelism, bounded output files, and a look at the partitions in use."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OUTPUT_FILES = 16
ROWS_PER_FILE = 5000
ROWS_PER_TASK = 50_000
BYTES_PER_FILE = 512 << 20


def file_budget(input_bytes: int, at_least: int = OUTPUT_FILES, per_file: int = BYTES_PER_FILE) -> int:
    """How many files an output may have: the given number, more once they would get too large."""
    return max(at_least, math.ceil(input_bytes / per_file))


def merge_partitions(df: DataFrame, files: int = OUTPUT_FILES) -> DataFrame:
    """At most ``files`` partitions without a shuffle. The stage that feeds them runs in
    no more tasks than that, so use it where the input is small."""
    return df.coalesce(files)


def spread_partitions(df: DataFrame, files: int = OUTPUT_FILES) -> DataFrame:
    """Exactly ``files`` partitions after a shuffle; everything before it keeps its own width."""
    return df.repartition(files)


def even_partitions(df: DataFrame, key: Column) -> DataFrame:
    """Partitions of the session's advisory size, sized while the job runs: small ones
    are merged and large ones split. Placing rows by a key spares the sort that a
    round-robin shuffle needs to be repeatable."""
    return df.hint("rebalance", key)


def bounded_partitions(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Partitions of at most about ``rows_per_task`` rows, however large the splits of the input
    are. For rows that grow in the tasks that follow: what a task sorts there stays as it is when
    the input grows. Whole rows are dealt in turn, so that equal ones are spread as well."""
    rows = df.count()
    tasks = min(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / ROWS_PER_FILE))
    return df.repartition(max(1, tasks, math.ceil(rows / rows_per_task)))


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per partition; empty partitions do not show."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count(F.lit(1)).alias("rows"))


def partition_plan(df: DataFrame, tasks: int) -> DataFrame:
    """Non-empty partitions and rows after a repartition to ``tasks``. Only the fact that
    a row exists is shuffled, not its columns."""
    spread = df.select(F.lit(1).alias("row")).repartition(tasks)
    return partition_sizes(spread).agg(
        F.count(F.lit(1)).alias("partitions"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")
    )
