"""A kept record of a growing tree: polls open only folders that have changed, and what arrives is
a table that a stream can read.

For every folder the ledger keeps its time of change and its number of files, as a table in the
shared store; the names themselves are in the table of arrivals. A poll asks each known folder for
its time, in tasks, and lists those that have another one. New folders are listed down to their
leaves. A folder that changed shortly before it was listed may change again without a new time,
and stores without times for folders give none: such folders are listed again at the next poll.
A poll that fails half way is repeated as a whole by the next one.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from advisory_lake.session import delete_folder, few_tasks
from advisory_lake.sources.stores import arrow_uri, exists, folder_lister, qualified

SETTLE_SECONDS = 2.0  # stores may round times of change

_FOLDERS = "folder STRING, changed TIMESTAMP, settled BOOLEAN, files LONG"
_ENTRIES = "relative_path STRING, length LONG, modificationTime TIMESTAMP"
ARRIVALS = "folder STRING, relative_path STRING, length LONG, modificationTime TIMESTAMP"


@dataclass(frozen=True)
class Poll:
    """What a poll saw: files in the tree now, files new since the last one, folders it listed."""

    found: int
    new: int
    opened: int


@dataclass(frozen=True)
class Ledger:
    """The record of the tree ``root``, kept below ``folder``. One poll at a time may run."""

    spark: SparkSession
    root: str
    folder: str

    @property
    def arrivals(self) -> str:
        """The folder of the table of files, each with the poll that found it."""
        return f"{self.folder}/arrivals"

    def poll(self) -> Poll:
        if not exists(self.root):
            return Poll(self._found(None), 0, 0)
        last = self._last()
        number = 0 if last is None else last + 1
        place = f"{self.folder}/polls/{number}"
        delete_folder(self.spark, place)  # of a poll that failed
        started = F.lit(time.time() - SETTLE_SECONDS).cast("timestamp")

        known = self._read(f"{self.folder}/polls/{last}/folders", _FOLDERS) if number else self._empty(_FOLDERS)
        seen = self._stored(known.mapInArrow(_times_of(arrow_uri(self.root)), f"{_FOLDERS}, now TIMESTAMP, there BOOLEAN"), f"{place}/seen")
        same = F.coalesce(F.col("settled") & (F.col("now") == F.col("changed")), F.lit(False))
        asked = seen.where(F.col("there") & ~same).select("folder", F.col("now").alias("changed"))
        if not number:
            asked = self.spark.createDataFrame([("", None)], "folder STRING, changed TIMESTAMP")
        listed = self._listed(asked, seen, place)

        every_asked = self._read(f"{place}/asked", "folder STRING, changed TIMESTAMP, level INT").drop("level")
        files = listed.where("length is not null")
        counts = files.groupBy("folder").agg(F.count(F.lit(1)).alias("files"))
        opened = every_asked.join(counts, "folder", "left").select(
            "folder", "changed", F.coalesce(F.col("changed") < started, F.lit(False)).alias("settled"), F.coalesce("files", F.lit(0).cast("long")).alias("files")
        )
        earlier = self._read(self.arrivals, f"{ARRIVALS}, poll INT") if number else self._empty(f"{ARRIVALS}, poll INT")
        # names of the asked folders alone: when these are few, none of the others is shuffled
        known_names = earlier.where(F.col("poll") < number).join(every_asked.select("folder"), "folder", "left_semi")
        new = files.join(known_names.select("relative_path"), "relative_path", "left_anti")
        new.select("folder", "relative_path", "length", "modificationTime").write.mode("overwrite").parquet(f"{self.arrivals}/poll={number}")
        kept = seen.where(F.col("there") & same).select("folder", "changed", "settled", "files")
        kept.unionByName(opened).write.parquet(f"{place}/folders")
        self._forget(number)
        arrived = self._read(f"{self.arrivals}/poll={number}", ARRIVALS).count()
        return Poll(self._found(number), arrived, every_asked.count())

    def close(self) -> None:
        """Delete the record."""
        delete_folder(self.spark, self.folder)

    def _listed(self, asked: DataFrame, seen: DataFrame, place: str) -> DataFrame:
        """Entries of the asked folders, and of all folders below them that were not known."""
        level = 0
        while True:
            asked = self._stored(asked, f"{place}/asked/level={level}")
            tasks = asked.repartition(few_tasks(self.spark), "folder").select("folder")
            lister = folder_lister(arrow_uri(self.root))
            entries = tasks.mapInArrow(lister, _ENTRIES).withColumn("folder", F.regexp_extract("relative_path", "^(.*)/[^/]*$", 1))
            found = self._stored(entries.select("folder", "relative_path", "length", "modificationTime"), f"{place}/listed/level={level}")
            below = found.where("length is null").select(F.col("relative_path").alias("folder"), F.col("modificationTime").alias("changed"))
            asked = below.join(seen.select("folder"), "folder", "left_anti")
            if asked.isEmpty():
                return self._read(f"{place}/listed", f"{ARRIVALS}, level INT").drop("level")
            level += 1

    def _stored(self, df: DataFrame, path: str) -> DataFrame:
        df.write.parquet(path)
        return self._read(path, df.schema)

    def _read(self, path: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(path)

    def _empty(self, schema: str) -> DataFrame:
        return self.spark.createDataFrame([], schema)

    def _found(self, number: int | None) -> int:
        if number is None:
            return 0
        return self._read(f"{self.folder}/polls/{number}/folders", _FOLDERS).agg(F.sum("files")).first()[0] or 0

    def _polls(self) -> list[int]:
        """Numbers of the polls that are stored, finished or not; there are never more than a few."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(qualified(self.spark, f"{self.folder}/polls"))
        store = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not store.exists(path):
            return []
        return sorted(int(status.getPath().getName()) for status in store.listStatus(path))

    def _last(self) -> int | None:
        """The last poll that finished."""
        for number in reversed(self._polls()):
            done = self.spark._jvm.org.apache.hadoop.fs.Path(qualified(self.spark, f"{self.folder}/polls/{number}/folders/_SUCCESS"))
            if done.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(done):
                return number
        return None

    def _forget(self, number: int) -> None:
        """Keep the folders of this poll alone."""
        for other in self._polls():
            if other < number:
                delete_folder(self.spark, f"{self.folder}/polls/{other}")
        for part in ("seen", "listed"):
            delete_folder(self.spark, f"{self.folder}/polls/{number}/{part}")


def _times_of(uri: str):
    # A closure with its own imports: workers need no copy of this package.
    def times(batches):
        import pyarrow as pa
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(uri)
        for batch in batches:
            paths = [f"{base}/{folder}" if folder else base for folder in batch.column(0).to_pylist()]
            infos = store.get_file_info(paths) if paths else []
            now = pa.array([info.mtime for info in infos], pa.timestamp("us", "UTC"))
            there = pa.array([info.type == fs.FileType.Directory for info in infos], pa.bool_())
            yield pa.RecordBatch.from_arrays([*batch.columns, now, there], names=[*batch.schema.names, "now", "there"])

    return times
