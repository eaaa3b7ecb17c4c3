"""The table pipeline: records into bronze, bronze into two silver tables, checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from advisory_lake.operators import bronze, quality, silver
from advisory_lake.operators.partitioning import even_partitions
from advisory_lake.session import utc
from advisory_lake.sources import tables
from advisory_lake.sources.snapshot import read_snapshot_of
from advisory_lake.sources.records import read_counts, taken, tree_documents
from advisory_lake.sources.stores import walk


@dataclass(frozen=True)
class Lake:
    """Where the tables live: a folder all executors reach, and the catalog schemas."""

    spark: SparkSession
    folder: str
    bronze_schema: str = "cve_bronze"
    silver_schema: str = "cve_silver"
    table_format: str = "parquet"

    @property
    def records(self) -> str:
        return f"{self.bronze_schema}.records"

    @property
    def ingest_counts(self) -> str:
        """One row on the last ingest of a tree: what was listed, read, lost, cut and rejected."""
        return f"{self.bronze_schema}.ingest_counts"

    @property
    def cves(self) -> str:
        return f"{self.silver_schema}.cves"

    @property
    def affected(self) -> str:
        return f"{self.silver_schema}.affected_products"

    def write(self, df: DataFrame, table: str) -> DataFrame:
        schema = table.split(".")[0]
        tables.ensure_schema(self.spark, schema, f"{self.folder}/{schema}")
        tables.replace_table(df, table, f"{self.folder}/{table.replace('.', '/')}", self.table_format)
        return tables.read_table(self.spark, table)

    def ingest_snapshot(
        self, path: str, year: int = bronze.PUBLICATION_YEAR, folder: str = "", suffix: str = ""
    ) -> DataFrame:
        """Bronze straight from a packed snapshot, the way to take for large trees; from all
        its files, or from those in a folder or with a suffix. Of a snapshot dated by
        ``bronze.dated`` only the wanted year is read."""
        files = read_snapshot_of(self.spark, path, year)
        return self._write_bronze(bronze.published_records(files, year, folder, suffix))

    def ingest_tree(
        self, root: str, year: int = bronze.PUBLICATION_YEAR, folder: str = "", suffix: str = ""
    ) -> DataFrame:
        """Bronze from a tree of files, by the same rules. Files that vanish or may not be read are
        left out and counted; the counts are taken while the records are written, and stored as
        the table ``ingest_counts``."""
        files = taken(walk(self.spark, root), folder, suffix)
        seen = Observation("ingest")
        documents = tree_documents(self.spark, root, listing=files).observe(seen, *read_counts())
        records = self._write_bronze(bronze.kept_documents(documents, year))
        counts = seen.get
        counted = files.agg(F.count(F.lit(1)).alias("files_listed"))
        self.write(counted.select("*", *(F.lit(n).cast("long").alias(name) for name, n in counts.items())), self.ingest_counts)
        return records

    def _write_bronze(self, kept: DataFrame) -> DataFrame:
        # Few rows are left of what was read: spread them evenly over right-sized files
        # while the read keeps its own parallelism.
        return self.write(even_partitions(kept, F.col("cveMetadata.cveId")), self.records)

    def build_silver(self) -> tuple[DataFrame, DataFrame]:
        """Write both silver tables; neither needs a shuffle."""
        with utc(self.spark):
            source = tables.read_table(self.spark, self.records)
            cves = self.write(silver.advisories(source), self.cves)
            return cves, self.write(silver.affected_products(source), self.affected)

    def check(self, min_rows: int = quality.MIN_ROWS) -> DataFrame:
        return quality.quality_report(
            tables.read_table(self.spark, self.records), tables.read_table(self.spark, self.cves), min_rows
        )


def run(
    lake: Lake,
    snapshot_path: str | None = None,
    year: int = bronze.PUBLICATION_YEAR,
    min_rows: int = quality.MIN_ROWS,
    tree: str | None = None,
    folder: str = "",
    suffix: str = "",
) -> DataFrame:
    """Snapshot or tree to silver; gives back the report, or fails when a check does."""
    if (snapshot_path is None) == (tree is None):
        raise ValueError("name a snapshot or a tree")
    if tree is None:
        lake.ingest_snapshot(snapshot_path, year, folder, suffix)
    else:
        lake.ingest_tree(tree, year, folder, suffix)
    lake.build_silver()
    report = lake.check(min_rows)
    quality.enforce(report)
    return report
