"""Feeds are built in tasks of bounded size, however the tables are stored."""

import os

import pytest
from harness import plan_of
from pyspark.sql import functions as F

from advisory_lake.operators import bronze, partitioning
from advisory_lake.plans.feeds import Feeds
from advisory_lake.sources import standin


def test_partitions_are_bounded_for_equal_rows_too(spark):
    equal = spark.range(100).select(F.lit(7).alias("key")).coalesce(1)
    sizes = partitioning.partition_sizes(partitioning.bounded_partitions(equal, 10)).collect()
    assert sum(row.rows for row in sizes) == 100
    assert len(sizes) == 10 and max(row.rows for row in sizes) <= 20
    assert partitioning.bounded_partitions(equal.limit(0)).count() == 0


@pytest.mark.parametrize("feed", ["mixed_snapshot", "odd_snapshot", "record_snapshot"])
def test_one_split_of_orders_is_written_by_several_tasks(spark, folder, feed):
    orders = spark.range(12_000).selectExpr(
        "id AS o_orderkey", "id AS o_custkey", "'F' AS o_orderstatus", "7000.0D AS o_totalprice",
        "DATE'1998-01-01' AS o_orderdate", "'1-URGENT' AS o_orderpriority",
    )
    orders.coalesce(1).write.parquet(f"{folder}/orders.parquet")
    written = getattr(Feeds(spark, folder), feed)
    assert spark.read.parquet(written).count() == 12_000
    assert len({name.split("-")[1] for name in os.listdir(written) if name.startswith("part-")}) == 3


def test_a_mixed_document_is_written_and_parsed_once(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    assert plan_of(standin.mixed_texts(orders)).count("StructsToJsonEvaluator") == 2  # compact and pretty
    files = spark.createDataFrame([("a", b'{"cveMetadata": {}}')], "relative_path STRING, file_content BINARY")
    assert plan_of(bronze.dated(files)).count("transform(") == 1
