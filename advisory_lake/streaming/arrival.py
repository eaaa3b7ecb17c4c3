"""Running count of files arriving in a tree.

The tree is polled into a ledger (``streaming.ledger``), and the stream reads the ledger's table
of arrivals. So it counts what a listing counts, empty files and names with ``_`` or ``.`` among
them, and its source keeps a few names for each poll, not the path of every file it has seen.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from advisory_lake.operators.inventory import EXPECTED_FILES, progress
from advisory_lake.session import remove_run_folder, run_folder
from advisory_lake.streaming.ledger import ARRIVALS, Ledger


def ledger_of(spark: SparkSession, root: str, checkpoint: str) -> Ledger:
    """The ledger that belongs to a checkpoint, beside it."""
    return Ledger(spark, root, f"{checkpoint.rstrip('/')}.ledger")


def arriving_files(spark: SparkSession, ledger: Ledger, files_per_trigger: int | None = None) -> DataFrame:
    """The files that polls have found, as a stream: folder, relative_path, length and
    modificationTime. ``files_per_trigger`` counts files of the ledger's table."""
    reader = spark.readStream.schema(ARRIVALS)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(ledger.arrivals).select("folder", "relative_path", "length", "modificationTime")


def keep_polling(spark: SparkSession, ledger: Ledger, every: str, checkpoint: str) -> StreamingQuery:
    """Poll the tree into the ledger at every tick, such as ``"30 seconds"``, until stopped."""
    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1).load()
    poll = ticks.writeStream.foreachBatch(lambda _, __: ledger.poll())
    return poll.option("checkpointLocation", checkpoint).trigger(processingTime=every).start()


def count_arrivals(
    spark: SparkSession,
    ledger: Ledger,
    name: str,
    checkpoint: str,
    expected: int = EXPECTED_FILES,
    files_per_trigger: int | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Keep the table ``name`` at one row: found, expected, percent, complete, checked_at.

    ``found`` is the number of files that polls have found so far. ``every`` such as
    ``"30 seconds"`` watches until stopped; without it the query takes what the polls have found
    and ends. The state is a single counter.
    """
    counted = arriving_files(spark, ledger, files_per_trigger).agg(F.count(F.lit(1)).alias("found"))
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        progress(counted, expected)
        .writeStream.format("memory")
        .queryName(name)
        .outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def count_until_now(
    spark: SparkSession,
    root: str,
    name: str,
    checkpoint: str,
    expected: int = EXPECTED_FILES,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Poll the tree, add what has arrived since the checkpoint's last run, and end."""
    ledger = ledger_of(spark, root, checkpoint)
    ledger.poll()
    count_arrivals(spark, ledger, name, checkpoint, expected, files_per_trigger).awaitTermination()
    return spark.table(name)


def watch_arrivals(
    spark: SparkSession, root: str, expected: int = EXPECTED_FILES, every: float = 30.0, most: int | None = None
) -> Iterator[Row]:
    """Reports (found, expected, percent, complete, checked_at) until the tree is complete, or
    after ``most`` of them. Counts the files that are there at each report, as the listing does; a
    folder that does not exist yet counts as empty. Only folders that have changed since the last
    report are opened, and nothing is left behind."""
    folder = run_folder(spark, "watch")
    ledger = Ledger(spark, root, folder)
    rounds = 0
    try:
        while True:
            found = spark.createDataFrame([(ledger.poll().found,)], "found LONG")
            report = progress(found, expected).first()
            rounds += 1
            yield report
            if report.complete or rounds == most:
                return
            time.sleep(every)
    finally:
        remove_run_folder(spark, folder)
