"""Silver: one flat row per record, and one per affected product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from advisory_lake.functions.scalars import first_entry, instant

SCORE_VERSIONS = ("cvssV4_0", "cvssV3_1")  # fixed values, in order of preference


def _preferred(field: str) -> Column:
    """The field from the first metrics entry, each field choosing its version on its own."""
    metric = first_entry(F.col("containers.cna.metrics"))
    return F.coalesce(*(metric[version][field] for version in SCORE_VERSIONS))


def advisories(bronze: DataFrame) -> DataFrame:
    """One row per bronze row; duplicates stay and are left to the quality checks."""
    return bronze.select(
        F.col("cveMetadata.cveId").alias("cve_id"),
        instant(F.col("cveMetadata.datePublished")).alias("date_published"),
        F.col("containers.cna.title").alias("title"),
        first_entry(F.col("containers.cna.descriptions"))["value"].alias("description"),
        _preferred("baseScore").alias("cvss_score"),
        _preferred("baseSeverity").alias("cvss_severity"),
    )


def affected_products(bronze: DataFrame) -> DataFrame:
    """One row per affected entry, one row of nulls for a record that lists none."""
    entries = bronze.select(
        F.col("cveMetadata.cveId").alias("cve_id"), F.explode_outer("containers.cna.affected").alias("entry")
    )
    return entries.select("cve_id", "entry.vendor", "entry.product")
