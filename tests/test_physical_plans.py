"""The plans have the shape that holds at scale."""

import pytest
from harness import plan_of

from advisory_lake.operators import bronze, gold, partitioning, silver
from advisory_lake.plans import registry
from advisory_lake.plans.feeds import feeds
from advisory_lake.sources.snapshot import read_snapshot
from advisory_lake.sources.tree import list_files

SMALL = "/root/testdata/sf0.001"
QUERIES = registry.all_queries()
# reading, writing and checking single files
WITH_PYTHON = {
    "snapshot_unpack", "snapshot_restore", "snapshot_content_verify", "snapshot_sample_verify", "bronze_ingest_files",
    "bronze_ingest_mixed",
}
# texts of packed files that are not one record each are cut by Arrow batches, the others stay
CUT_TEXTS = {
    "bronze_records", "bronze_reject_summary", "bronze_ingest_encodings", "bronze_files_summary", "bronze_rejects",
    "bronze_ingest_dated",
}


def plan(spark, key):
    return plan_of(QUERIES[key](spark, SMALL))


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_python_only_touches_files_and_nothing_is_crossed(spark, key):
    text = plan(spark, key)
    assert ("MapInArrow" in text) == (key in WITH_PYTHON)
    assert ("ArrowEvalPython" in text) == (key in CUT_TEXTS)
    for word in ("BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


@pytest.mark.parametrize("key", [k for k in sorted(QUERIES) if k.startswith("gold_top")])
def test_top_k_is_fused_and_filters_reach_the_scan(spark, key):
    text = plan(spark, key)
    assert "TakeOrderedAndProject" in text
    assert "PushedFilters: [IsNotNull(" in text and "Not(In(vendor" in text
    assert text.count("Exchange hashpartitioning") == 0 or "cve_id" in text


def test_the_distinct_count_spreads_a_hot_key(spark):
    text = plan(spark, "gold_top_vendors")
    first = text.split("hashpartitioning(vendor", 1)[1].split("\n")[0]
    assert ", cve_id" in first


def test_listings_never_read_content(spark):
    text = plan_of(gold.preview(list_files(spark, feeds(spark, SMALL).document_tree), "relative_path", 5))
    assert "content" not in text.split("ReadSchema")[1].split("\n")[0] and "InMemoryFileIndex" in text


def test_only_digests_are_shuffled(spark):
    for line in plan(spark, "snapshot_content_verify").split("\n"):
        if "hashpartitioning" in line:
            assert "content" not in line


def test_silver_reads_only_its_fields(spark):
    table = spark.table(feeds(spark, SMALL).lake.records)
    cves, affected = plan_of(silver.advisories(table)), plan_of(silver.affected_products(table))
    assert "affected" not in cves.split("ReadSchema")[1].split("\n")[0]
    assert "metrics" not in affected.split("ReadSchema")[1].split("\n")[0]
    assert "Exchange" not in cves + affected


def test_bronze_needs_no_shuffle_and_parses_shallowly_first(spark):
    snapshot = read_snapshot(spark, feeds(spark, SMALL).record_snapshot)
    text = plan_of(bronze.published_records(snapshot, 1998))
    assert "Exchange" not in text
    # the full parse stands above the filter on id and date, which knows the header only
    filters = [line for line in text.split("\n") if line.startswith("Condition") and "cveMetadata" in line]
    assert filters and not any("containers" in line for line in filters)


def test_only_the_wanted_year_of_a_dated_snapshot_is_read(spark, tmp_path):
    from pathlib import Path

    from pyspark.sql import functions as F

    from advisory_lake.sources.snapshot import read_snapshot_of, write_dated_snapshot

    packed = read_snapshot(spark, feeds(spark, SMALL).mixed_snapshot)
    write_dated_snapshot(bronze.dated(packed), str(tmp_path))
    assert read_snapshot(spark, str(tmp_path)).count() == packed.count()
    assert sorted(read_snapshot(spark, str(tmp_path)).collect()) == sorted(packed.collect())
    of_year = read_snapshot_of(spark, str(tmp_path), 1998)
    assert "PartitionFilters: [published" in plan_of(of_year) and "IN (1998,0)" in plan_of(of_year)
    folders = {r[0] for r in of_year.select(F.regexp_extract("_metadata.file_path", "published=([^/]*)", 1)).distinct().collect()}
    assert folders <= {"1998", "0"} and "1998" in folders

    want = sorted(map(str, bronze.published_records(packed, 1998).collect()))
    for folder in Path(tmp_path).glob("published=*"):
        if folder.name not in ("published=1998", "published=0"):
            for file in folder.glob("*.parquet"):
                file.write_bytes(b"no other year is opened")
    assert sorted(map(str, bronze.published_records(read_snapshot_of(spark, str(tmp_path), 1998), 1998).collect())) == want != []


def test_files_of_several_years_are_found_in_each(spark, tmp_path):
    import json

    from advisory_lake.sources.snapshot import read_snapshot_of, write_dated_snapshot

    def text(*dates):
        records = [{"cveMetadata": {"cveId": d, "datePublished": d}} for d in dates]
        return "\n".join(map(json.dumps, records)).encode()

    rows = [("a", text("2023-01-01", "2024-01-01")), ("b", text("2024-01-01")), ("c", text("2023-05-05")), ("d", b""), ("e", b"junk"),
            ("f", text("2023-02-02", "2023-03-03")), ("g", text("soon"))]
    files = spark.createDataFrame(rows, "relative_path STRING, file_content BINARY")
    found = {r.relative_path: r.published for r in bronze.dated(files).collect()}
    assert found == {"a": 0, "b": 2024, "c": 2023, "d": None, "e": None, "f": 2023, "g": None}
    write_dated_snapshot(bronze.dated(files), str(tmp_path))
    for year, want in ((2023, ["2023-01-01", "2023-02-02", "2023-03-03", "2023-05-05"]), (2024, ["2024-01-01"] * 2), (1999, [])):
        kept = bronze.published_records(read_snapshot_of(spark, str(tmp_path), year), year)
        assert sorted(r[0] for r in kept.select("cveMetadata.cveId").collect()) == want


def test_merging_has_no_exchange(spark):
    df = spark.range(100)
    assert "Exchange" not in plan_of(partitioning.merge_partitions(df, 4))
    assert "RoundRobinPartitioning(4)" in plan_of(partitioning.spread_partitions(df, 4))


def test_partition_plan_shuffles_no_columns(spark):
    assert "ReadSchema: struct<>" in plan(spark, "partition_plan")
