"""What the registered queries read, built once per session and table folder.

Everything is written below the shared folder, so it survives lost executors and is
the same data for every query.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from advisory_lake.operators import bronze, partitioning
from advisory_lake.operators.packing import unpack_snapshot, written_totals
from advisory_lake.plans.medallion import Lake
from advisory_lake.session import run_folder, utc
from advisory_lake.sources import standin
from advisory_lake.sources.snapshot import read_snapshot, write_dated_snapshot, write_snapshot

_feeds: dict[tuple[str, str, str], Feeds] = {}


class Feeds:
    def __init__(self, spark: SparkSession, tables_dir: str):
        self.spark = spark
        self.tables_dir = tables_dir
        self.folder = run_folder(spark, "feed")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.tables_dir}/{name}.parquet")

    def new_folder(self, label: str) -> str:
        return run_folder(self.spark, label)

    def orders(self) -> DataFrame:
        """Dealt to tasks of bounded size: a record is many times as long as its row."""
        return partitioning.bounded_partitions(self.table("orders"))

    @cached_property
    def document_snapshot(self) -> str:
        return self._stored("documents-packed", standin.document_snapshot(self.table("documents")))

    @cached_property
    def document_tree(self) -> str:
        return self._unpacked(self.document_snapshot, "documents-tree")

    @cached_property
    def record_snapshot(self) -> str:
        return self._stored("records-packed", standin.record_snapshot(self.orders()))

    @cached_property
    def record_tree(self) -> str:
        return self._unpacked(self.record_snapshot, "records-tree")

    @cached_property
    def record_lines(self) -> str:
        path = f"{self.folder}/records-lines"
        with utc(self.spark):
            documents = standin.record_documents(self.table("orders"))
        documents.write.mode("overwrite").json(path)
        return path

    @cached_property
    def mixed_lines(self) -> str:
        """Large files of many documents, with bad lines and cut-off ones among them."""
        path = f"{self.folder}/mixed-lines"
        with utc(self.spark):
            standin.mixed_texts(self.table("orders")).select("text").write.mode("overwrite").text(path)
        return path

    @cached_property
    def mixed_snapshot(self) -> str:
        """The same, one small file for each order."""
        with utc(self.spark):
            texts = standin.mixed_texts(self.orders())
            name = F.concat(F.expr("o_orderkey div 1000"), F.lit("xxx/"), "o_orderkey", F.lit(".json"))
            files = texts.select(name.alias("relative_path"), F.encode("text", "UTF-8").alias("file_content"))
            return self._stored("mixed-packed", files)

    @cached_property
    def dated_snapshot(self) -> str:
        """The mixed files by year of publication."""
        path = f"{self.folder}/mixed-dated"
        with utc(self.spark):
            write_dated_snapshot(bronze.dated(read_snapshot(self.spark, self.mixed_snapshot)), path)
        return path

    @cached_property
    def odd_snapshot(self) -> str:
        with utc(self.spark):
            return self._stored("odd-packed", standin.odd_record_snapshot(self.orders()))

    @cached_property
    def lake(self) -> Lake:
        suffix = self.folder.rpartition("-")[2]
        lake = Lake(self.spark, f"{self.folder}/lake", f"cve_bronze_{suffix}", f"cve_silver_{suffix}")
        lake.ingest_snapshot(self.record_snapshot, standin.PUBLICATION_YEAR)
        lake.build_silver()
        return lake

    def kept_records(self) -> DataFrame:
        snapshot = read_snapshot(self.spark, self.record_snapshot)
        return bronze.published_records(snapshot, standin.PUBLICATION_YEAR)

    def _stored(self, label: str, snapshot: DataFrame) -> str:
        path = f"{self.folder}/{label}"
        write_snapshot(snapshot, path)
        return path

    def _unpacked(self, snapshot_path: str, label: str) -> str:
        root = f"{self.folder}/{label}"
        tasks = self.spark.sparkContext.defaultParallelism
        written_totals(unpack_snapshot(self.spark, snapshot_path, root, tasks)).collect()
        return root


def feeds(spark: SparkSession, tables_dir: str) -> Feeds:
    """The feeds of this session for these tables, new ones when a table file changed."""
    application = spark.conf.get("spark.app.id")
    for other in [key for key in _feeds if key[0] != application]:
        del _feeds[other]
    key = (application, tables_dir, _fingerprint(spark, tables_dir))
    if key not in _feeds:
        _feeds[key] = Feeds(spark, tables_dir)
    return _feeds[key]


def _fingerprint(spark: SparkSession, tables_dir: str) -> str:
    """A digest of the file listing, so that replaced tables are not mistaken for the old ones."""
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(tables_dir)
    ).agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("x"))
    row = listing.first()
    return f"{row.n}:{row.x}"
