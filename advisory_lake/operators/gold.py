"""Gold: the reporting questions as DataFrames. Ties are broken by the keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from advisory_lake.functions.scalars import named, utc_wall_time

# Placeholder texts each ranking leaves out. "Unknown" counts as a vendor.
VENDOR_PLACEHOLDERS = ["n/a", "N/A"]
PRODUCT_PLACEHOLDERS = ["n/a", "N/A", "Unknown"]

# How the table counts name the two tables.
CVES_LABEL = "CVEs Table"
AFFECTED_LABEL = "Affected Products Table"

TOP_VENDORS = 25
TOP_PRODUCTS = 10


def _rank(affected: DataFrame, keys: list[str], placeholders: list[str], k: int) -> DataFrame:
    """Groups with the most distinct ids. The distinct count is exact and groups on
    (keys, id) before it groups on the keys, so one dominant key is spread over tasks."""
    wanted = reduce(lambda a, b: a & b, (named(F.col(key), placeholders) for key in keys))
    return (
        affected.filter(wanted)
        .groupBy(*keys)
        .agg(F.count_distinct("cve_id").alias("vulnerability_count"))
        .orderBy(F.desc("vulnerability_count"), *keys)
        .limit(k)
    )


def top_vendors(affected: DataFrame, k: int = TOP_VENDORS) -> DataFrame:
    return _rank(affected, ["vendor"], VENDOR_PLACEHOLDERS, k)


def top_products(affected: DataFrame, k: int = TOP_PRODUCTS) -> DataFrame:
    return _rank(affected, ["vendor", "product"], PRODUCT_PLACEHOLDERS, k)


def severity_distribution(cves: DataFrame) -> DataFrame:
    known = cves.filter(F.col("cvss_severity").isNotNull())
    return known.groupBy("cvss_severity").count().orderBy(F.desc("count"), "cvss_severity")


def monthly_trend(cves: DataFrame) -> DataFrame:
    """Publications per month of UTC, the month as a date."""
    months = cves.withColumn("publication_month", F.trunc(utc_wall_time(F.col("date_published")), "MM"))
    return months.groupBy("publication_month").count().orderBy("publication_month")


def table_counts(cves: DataFrame, affected: DataFrame) -> DataFrame:
    def labelled(df: DataFrame, label: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("record_count")).select(
            F.lit(label).alias("table_name"), "record_count"
        )

    return labelled(cves, CVES_LABEL).unionByName(labelled(affected, AFFECTED_LABEL))


def preview(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The first rows by key."""
    return df.orderBy(key).limit(rows)
