import pytest

from advisory_lake import session
from advisory_lake.operators import packing, quality
from advisory_lake.plans import medallion
from advisory_lake.plans.feeds import feeds
from advisory_lake.sources import tables

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def lake(spark, folder):
    tag = folder.rstrip("/").rpartition("/")[2].replace("-", "_")
    return medallion.Lake(spark, folder, f"b_{tag}", f"s_{tag}")


def test_run_builds_all_tables_and_passes(spark, lake):
    report = medallion.run(lake, feeds(spark, SMALL).record_snapshot, year=1998, min_rows=200)
    assert all(r.passed for r in report.collect())
    assert spark.table(lake.cves).count() == spark.table(lake.records).count() == 241
    assert spark.table(lake.affected).count() > 241


def test_run_fails_below_the_threshold(spark, lake):
    with pytest.raises(quality.QualityError, match="bronze_row_count: observed 241, threshold 30000"):
        medallion.run(lake, feeds(spark, SMALL).record_snapshot, year=1998)


def test_tree_and_snapshot_give_the_same_table(spark, lake):
    feed = feeds(spark, SMALL)
    from_tree = lake.ingest_tree(f"{feed.record_tree}/cves", 1998).select("cveMetadata.cveId").collect()
    from_snapshot = lake.ingest_snapshot(feed.record_snapshot, 1998).select("cveMetadata.cveId").collect()
    assert sorted(from_tree) == sorted(from_snapshot)


def test_replacing_a_table_replaces_its_schema(spark, lake):
    lake.write(spark.range(3), lake.cves)
    again = lake.write(spark.createDataFrame([("x", 1.5)], "a STRING, b DOUBLE"), lake.cves)
    assert again.columns == ["a", "b"] and again.count() == 1


def test_tables_of_an_earlier_session_are_overwritten(spark, lake):
    lake.write(spark.range(3), lake.cves)
    spark.sql(f"DROP TABLE {lake.cves}")  # a new session's catalog is empty, the files are there
    assert lake.write(spark.range(5), lake.cves).count() == 5


def test_bronze_is_spread_by_id(spark, lake):
    from harness import plan_of
    from pyspark.sql import functions as F

    from advisory_lake.operators.partitioning import even_partitions

    table = lake.ingest_snapshot(feeds(spark, SMALL).record_snapshot, 1998)
    text = plan_of(even_partitions(table, F.col("cveMetadata.cveId")))
    assert "REBALANCE_PARTITIONS_BY_COL" in text and "RoundRobin" not in text


def test_table_detail(spark, lake):
    lake.write(spark.range(10).repartition(2), lake.cves)
    row = tables.table_detail(spark, lake.cves).first()
    assert (row.name, row.format, row.column_count, row.num_files, row.row_count) == ("cves", "parquet", 1, 2, 10)
    assert row.size_in_bytes > 0 and "/cves/version-" in row.location


def test_feeds_are_shared_until_a_table_changes(spark, tmp_path):
    import shutil

    for name in ("orders", "documents"):
        shutil.copyfile(f"{SMALL}/{name}.parquet", tmp_path / f"{name}.parquet")
    first = feeds(spark, str(tmp_path))
    assert feeds(spark, str(tmp_path)) is first
    shutil.copyfile("/root/testdata/sf0.01/orders.parquet", tmp_path / "orders.parquet")
    assert feeds(spark, str(tmp_path)) is not first


def test_work_goes_to_the_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_folder(spark) == named
    assert feeds(spark, SMALL).folder.startswith(named)


class Settings:
    def __init__(self, **values):
        self.conf = self
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Settings(**{"spark.master": "yarn"}))


def test_a_local_session_gets_its_own_folder():
    first = session.shared_folder(Settings(**{"spark.master": "local[2]"}))
    assert first == session.shared_folder(Settings(**{"spark.master": "local[2]"}))


@pytest.mark.parametrize(
    "text, size", [("128MB", 128 << 20), ("4194304b", 4 << 20), ("4194304", 4 << 20), ("2g", 2 << 30)]
)
def test_size_settings(text, size):
    assert session.conf_bytes(Settings(key=text), "key") == size


def test_packing_a_tree_keeps_settings(spark, folder):
    before = spark.conf.get(session.OPEN_COST_KEY)
    packing.pack_tree(spark, feeds(spark, SMALL).document_tree, f"{folder}/p")
    assert spark.conf.get(session.OPEN_COST_KEY) == before


def test_a_replace_that_fails_leaves_the_table_as_it_was(spark, lake):
    from pyspark.sql import functions as F

    lake.write(spark.range(5), lake.cves)
    broken = spark.range(100).select(F.when(F.col("id") > 97, F.raise_error(F.lit("broken"))).otherwise("x").alias("other"))
    with pytest.raises(Exception, match="broken"):
        lake.write(broken, lake.cves)
    assert spark.table(lake.cves).columns == ["id"] and spark.table(lake.cves).count() == 5
    # from its own rows, and with nothing left of earlier versions
    own = lake.write(spark.table(lake.cves).where("id > 1"), lake.cves)
    assert sorted(r.id for r in own.collect()) == [2, 3, 4]
    folder = f"{lake.folder}/{lake.cves.replace('.', '/')}"
    assert len(tables._entries(spark, folder)) == 1


def test_table_detail_counts_the_files_of_the_table(spark, lake):
    from pathlib import Path

    lake.write(spark.range(10).repartition(2), lake.cves)
    folder = Path(lake.folder, lake.cves.replace(".", "/"))
    (folder / "version-old").mkdir()
    (folder / "version-old" / "part-0.parquet").write_bytes(b"left by a format that keeps old files")
    row = tables.table_detail(spark, lake.cves).first()
    current = list(Path(row.location.removeprefix("file:")).glob("*.parquet"))
    assert (row.num_files, row.size_in_bytes) == (2, sum(p.stat().st_size for p in current))
    lake.write(spark.range(0), lake.cves)
    again = tables.table_detail(spark, lake.cves).first()
    assert again.row_count == 0 and again.column_count == 1
