"""Every registered query: a function of the session and the folder of test tables."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from advisory_lake import schemas
from advisory_lake.functions.scalars import without_zone
from advisory_lake.operators import bronze, gold, inventory, packing, partitioning, quality
from advisory_lake.plans import gold_sql
from advisory_lake.plans.feeds import Feeds, feeds
from advisory_lake.plans.medallion import Lake
from advisory_lake.session import utc
from advisory_lake.sources import records, snapshot, standin, tables, tree
from advisory_lake.streaming import arrival
from advisory_lake.streaming.ledger import Ledger

Query = Callable[[SparkSession, str], DataFrame]

YEAR = standin.PUBLICATION_YEAR
MIN_ROWS = 100

_queries: dict[str, Query] = {}
_lock = threading.RLock()  # feeds are built and settings changed by one caller at a time


def query(body: Callable[[Feeds], DataFrame]) -> Callable[[Feeds], DataFrame]:
    """Register under the function's name; planned in UTC."""

    def run(spark: SparkSession, tables_dir: str) -> DataFrame:
        with _lock, utc(spark):
            return body(feeds(spark, tables_dir))

    _queries[body.__name__] = run
    return body


def all_queries() -> dict[str, Query]:
    return dict(_queries)


# Packed snapshots


def _sizes(packed: DataFrame) -> DataFrame:
    return packed.select("relative_path", F.octet_length("file_content").cast("long").alias("size_bytes"))


@query
def snapshot_pack(feed: Feeds) -> DataFrame:
    return _sizes(packing.pack_tree(feed.spark, feed.document_tree, feed.new_folder("packed")))


@query
def snapshot_preview(feed: Feeds) -> DataFrame:
    packed = snapshot.read_snapshot(feed.spark, feed.document_snapshot)
    first = [row.relative_path for row in gold.preview(packed.select("relative_path"), "relative_path", 5).collect()]
    return gold.preview(_sizes(packed.where(F.col("relative_path").isin(first))), "relative_path", 5)


@query
def snapshot_path_normalize(feed: Feeds) -> DataFrame:
    packed = snapshot.read_snapshot(feed.spark, feed.document_snapshot)
    return packing.target_paths(packed, "/restored")


@query
def snapshot_unpack(feed: Feeds) -> DataFrame:
    written = packing.unpack_snapshot(feed.spark, feed.document_snapshot, feed.new_folder("unpacked"))
    return packing.written_totals(written)


@query
def snapshot_restore(feed: Feeds) -> DataFrame:
    """Restored as a whole, and again over the tree that is then there; what the files hold."""
    root = feed.new_folder("restored")
    for _ in range(2):
        packing.restore_snapshot(feed.spark, feed.document_snapshot, root, feed.spark.sparkContext.defaultParallelism)
    return tree.read_files(feed.spark, root).select(
        "relative_path", F.octet_length("file_content").cast("long").alias("size_bytes"), F.sha2("file_content", 256).alias("sha256")
    )


@query
def snapshot_row_parity(feed: Feeds) -> DataFrame:
    packed = snapshot.read_snapshot(feed.spark, feed.document_snapshot)
    return packing.row_parity(packed, tree.list_files(feed.spark, feed.document_tree))


@query
def snapshot_content_verify(feed: Feeds) -> DataFrame:
    packed = snapshot.read_snapshot(feed.spark, feed.document_snapshot)
    files = tree.read_files(feed.spark, feed.document_tree)
    return packing.content_totals(packing.compare_content(packed, files))


@query
def snapshot_damage_verify(feed: Feeds) -> DataFrame:
    """Against files of which some changed, some are missing and some are extra."""
    packed = snapshot.read_snapshot(feed.spark, feed.document_snapshot)
    of = lambda source: F.col("relative_path").contains(source)
    kept = packed.where(~of("src2/") & ~of("src2\\"))
    changed = kept.withColumn("file_content", F.when(of("src1/"), F.lit(b"other")).otherwise(F.col("file_content")))
    extra = packed.where(of("src4/")).withColumn("relative_path", F.concat("relative_path", F.lit(".extra")))
    return packing.content_totals(packing.compare_content(packed, changed.unionByName(extra)))


@query
def snapshot_sample_verify(feed: Feeds) -> DataFrame:
    packed = snapshot.read_snapshot(feed.spark, feed.document_snapshot)
    return packing.verify_sample(packed, feed.document_tree)


@query
def partition_plan(feed: Feeds) -> DataFrame:
    return partitioning.partition_plan(feed.table("lineitem"), packing.PARALLEL_TASKS)


# Inventory


@query
def file_inventory(feed: Feeds) -> DataFrame:
    listing = tree.list_files(feed.spark, feed.document_tree)
    return inventory.json_files(listing).select("relative_path", "length")


@query
def files_per_year(feed: Feeds) -> DataFrame:
    return inventory.files_per_year(tree.list_files(feed.spark, feed.document_tree))


@query
def files_total(feed: Feeds) -> DataFrame:
    per_year = inventory.files_per_year(tree.list_files(feed.spark, feed.document_tree))
    return inventory.files_total(per_year)


@query
def arrival_progress(feed: Feeds) -> DataFrame:
    expected = feed.table("documents").count()

    def report(folder: str) -> DataFrame:
        seen = inventory.arrival_progress(feed.spark, f"{feed.document_tree}/{folder}", expected)
        return seen.select(F.lit(folder).alias("folder"), "found", "expected", "percent", "complete")

    return report("cves").unionByName(report("cves/en")).unionByName(report("not-yet-created"))


@query
def arrival_progress_stream(feed: Feeds) -> DataFrame:
    """The stream's own progress against the expected total, files of every name among them."""
    expected = feed.table("documents").count()
    checkpoint = feed.new_folder("arrivals")
    name = "arrivals_" + checkpoint.rpartition("-")[2]
    counted = arrival.count_until_now(feed.spark, feed.document_tree, name, checkpoint, expected)
    return counted.select("found", "expected", "percent", "complete")


@query
def arrival_second_poll(feed: Feeds) -> DataFrame:
    """Two polls of the same tree: the second lists only folders that may have changed since."""
    ledger = Ledger(feed.spark, feed.document_tree, feed.new_folder("ledger"))
    first, second = ledger.poll(), ledger.poll()
    rows = [("first", first.found, first.new, True), ("second", second.found, second.new, second.opened <= first.opened)]
    return feed.spark.createDataFrame(rows, "poll STRING, found LONG, new LONG, opens_no_more BOOLEAN")


# Bronze


def _entries(kept: DataFrame) -> DataFrame:
    cna = "containers.cna"
    return kept.select(
        F.col("cveMetadata.cveId").alias("cve_id"),
        F.coalesce(F.size(f"{cna}.affected"), F.lit(-1)).alias("n_affected"),
        F.coalesce(F.size(f"{cna}.metrics"), F.lit(-1)).alias("n_metrics"),
    )


@query
def bronze_ingest_files(feed: Feeds) -> DataFrame:
    """From the tree, by the same rules as from a snapshot; one file for each order, in waves."""

    def kept(root: str) -> DataFrame:
        return _entries(bronze.kept_documents(records.tree_documents(feed.spark, root), YEAR))

    return packing.through_tree(feed.spark, feed.record_snapshot, feed.new_folder("records-waves"), kept)


@query
def bronze_ingest_mixed(feed: Feeds) -> DataFrame:
    """From large files in which documents stand beside bad lines; several tasks cut each file."""
    documents = records.tree_documents(feed.spark, feed.mixed_lines, suffix=".txt", range_bytes=1 << 20)
    return _entries(bronze.kept_documents(documents, YEAR))


@query
def bronze_ingest_dated(feed: Feeds) -> DataFrame:
    """The same documents from a snapshot dated by their years, of which one is read."""
    packed = snapshot.read_snapshot_of(feed.spark, feed.dated_snapshot, YEAR)
    return _entries(bronze.published_records(packed, YEAR))


@query
def bronze_rejects(feed: Feeds) -> DataFrame:
    """Every rejected piece of the same documents, packed in small files, with file and place."""
    packed = snapshot.read_snapshot(feed.spark, feed.mixed_snapshot)
    return records.rejected(records.packed_documents(packed)).select("relative_path", "reason", "text")


@query
def bronze_ingest_counts(feed: Feeds) -> DataFrame:
    """What an ingest of the tree has listed, read, lost, cut and rejected on the way."""
    folder = feed.new_folder("counted")
    lake = Lake(feed.spark, folder, bronze_schema="counted_" + folder.rpartition("-")[2])
    lake.ingest_tree(feed.mixed_lines, YEAR, suffix=".txt")
    counts = tables.read_table(feed.spark, lake.ingest_counts)
    listed_and_read = (F.col("files_listed") == F.col("files_read")).alias("all_read")
    return counts.select(listed_and_read, "files_lost", "documents", "rejected")


@query
def bronze_ingest_lines(feed: Feeds) -> DataFrame:
    return _entries(bronze.keep_published(records.read_record_lines(feed.spark, feed.record_lines), YEAR))


@query
def bronze_ingest_encodings(feed: Feeds) -> DataFrame:
    """Documents with a byte-order mark, in UTF-16, and two to a file."""
    packed = snapshot.read_snapshot(feed.spark, feed.odd_snapshot)
    return _entries(bronze.published_records(packed, YEAR))


@query
def bronze_files_summary(feed: Feeds) -> DataFrame:
    """What ingest takes and leaves out of the same files, when asked for JSON names only."""
    return bronze.files_summary(snapshot.read_snapshot(feed.spark, feed.odd_snapshot), suffix=".json")


@query
def bronze_records(feed: Feeds) -> DataFrame:
    return feed.kept_records().select(
        F.col("cveMetadata.cveId").alias("cve_id"),
        F.col("cveMetadata.datePublished").alias("date_published_raw"),
        F.col("containers.cna.title").alias("title"),
    )


@query
def bronze_reject_summary(feed: Feeds) -> DataFrame:
    packed = snapshot.read_snapshot(feed.spark, feed.record_snapshot)
    return bronze.reject_summary(records.parse_packed(packed, schemas.RECORD_HEADER), YEAR)


def _titles(table: DataFrame) -> DataFrame:
    return table.select(F.col("cveMetadata.cveId").alias("cve_id"), F.col("containers.cna.title").alias("title"))


@query
def bronze_preview(feed: Feeds) -> DataFrame:
    return gold.preview(_titles(tables.read_table(feed.spark, feed.lake.records)), "cve_id", 10)


@query
def bronze_table_roundtrip(feed: Feeds) -> DataFrame:
    """Replace a table by one with other columns, then read it from the catalog."""
    folder = feed.new_folder("roundtrip")
    lake = Lake(feed.spark, folder, bronze_schema="roundtrip_" + folder.rpartition("-")[2])
    kept = feed.kept_records()
    lake.write(kept.select("dataType"), lake.records)
    return _titles(lake.write(kept, lake.records))


@query
def bronze_output_files(feed: Feeds) -> DataFrame:
    """Both ways of bounding the number of output files, checked on what was written."""
    packed = tree.data_files(feed.spark, feed.record_snapshot).agg(F.sum("length").alias("bytes")).first().bytes
    budget = partitioning.file_budget(packed)
    kept = feed.kept_records()

    def written(layout: str, df: DataFrame) -> DataFrame:
        path = feed.new_folder(layout)
        df.write.parquet(path)
        files = tree.data_files(feed.spark, path).agg(F.count(F.lit(1)).alias("files"))
        return files.select(F.lit(layout).alias("layout"), F.col("files").between(1, budget).alias("within_limit"))

    merged = written("merged", partitioning.merge_partitions(kept, budget))
    return merged.unionByName(written("spread", partitioning.spread_partitions(kept, budget)))


@query
def table_detail(feed: Feeds) -> DataFrame:
    def detail(name: str) -> DataFrame:
        return tables.table_detail(feed.spark, name).select(
            "name", "format", "column_count", "row_count", (F.col("num_files") > 0).alias("has_files")
        )

    lake = feed.lake
    return detail(lake.records).unionByName(detail(lake.cves)).unionByName(detail(lake.affected))


# Silver


def _cves(feed: Feeds) -> DataFrame:
    return tables.read_table(feed.spark, feed.lake.cves)


def _affected(feed: Feeds) -> DataFrame:
    return tables.read_table(feed.spark, feed.lake.affected)


@query
def silver_cves(feed: Feeds) -> DataFrame:
    return _cves(feed).withColumn("date_published", without_zone(F.col("date_published")))


@query
def silver_affected(feed: Feeds) -> DataFrame:
    return _affected(feed)


# Quality


@query
def dq_null_ids(feed: Feeds) -> DataFrame:
    return _cves(feed).agg(F.count_if(F.col("cve_id").isNull()).alias("null_ids"))


@query
def dq_unique_ids(feed: Feeds) -> DataFrame:
    counted = _cves(feed).agg(
        F.count(F.lit(1)).alias("total_rows"), quality.distinct_values("cve_id").alias("distinct_ids")
    )
    return counted.withColumn("passed", F.col("total_rows") == F.col("distinct_ids"))


@query
def dq_report(feed: Feeds) -> DataFrame:
    return feed.lake.check(MIN_ROWS)


@query
def dq_report_damaged(feed: Feeds) -> DataFrame:
    """The checks on a table with repeated ids, null ids and too few rows for its threshold."""
    cves = _cves(feed)
    repeated = cves.where("cvss_severity = 'CRITICAL'")
    nameless = cves.where("cvss_severity = 'LOW'").withColumn("cve_id", F.lit(None).cast("string"))
    return quality.quality_report(_cves(feed), cves.unionByName(repeated).unionByName(nameless), 10_000_000)


# Gold


@query
def gold_table_counts(feed: Feeds) -> DataFrame:
    return gold.table_counts(_cves(feed), _affected(feed))


@query
def gold_table_counts_sql(feed: Feeds) -> DataFrame:
    return gold_sql.table_counts(feed.spark, feed.lake.cves, feed.lake.affected)


@query
def gold_top_vendors(feed: Feeds) -> DataFrame:
    return gold.top_vendors(_affected(feed))


@query
def gold_top_vendors_sql(feed: Feeds) -> DataFrame:
    return gold_sql.top_vendors(feed.spark, feed.lake.affected)


@query
def gold_severity(feed: Feeds) -> DataFrame:
    return gold.severity_distribution(_cves(feed))


@query
def gold_severity_sql(feed: Feeds) -> DataFrame:
    return gold_sql.severity_distribution(feed.spark, feed.lake.cves)


@query
def gold_monthly(feed: Feeds) -> DataFrame:
    return gold.monthly_trend(_cves(feed))


@query
def gold_monthly_sql(feed: Feeds) -> DataFrame:
    monthly = gold_sql.monthly_trend(feed.spark, feed.lake.cves)
    return monthly.withColumn("publication_month", without_zone(F.col("publication_month")))


@query
def gold_top_products(feed: Feeds) -> DataFrame:
    return gold.top_products(_affected(feed))


@query
def gold_top_products_sql(feed: Feeds) -> DataFrame:
    return gold_sql.top_products(feed.spark, feed.lake.affected)
