"""The reporting questions as SQL over catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from advisory_lake.operators.gold import (
    AFFECTED_LABEL,
    CVES_LABEL,
    PRODUCT_PLACEHOLDERS,
    TOP_PRODUCTS,
    TOP_VENDORS,
    VENDOR_PLACEHOLDERS,
)

CVES = "cve_silver.cves"
AFFECTED = "cve_silver.affected_products"

TABLE_COUNTS = """
SELECT :cves_label AS table_name, count(*) AS record_count FROM IDENTIFIER(:cves)
UNION ALL
SELECT :affected_label, count(*) FROM IDENTIFIER(:affected)
"""

RANKING = """
SELECT {keys}, count(DISTINCT cve_id) AS vulnerability_count
FROM IDENTIFIER(:affected)
WHERE {conditions}
GROUP BY {keys}
ORDER BY vulnerability_count DESC, {keys}
LIMIT :k
"""

SEVERITY_SQL = """
SELECT cvss_severity, count(*) AS `count` FROM IDENTIFIER(:cves)
WHERE cvss_severity IS NOT NULL
GROUP BY cvss_severity ORDER BY `count` DESC, cvss_severity
"""

MONTHLY_SQL = """
SELECT date_trunc('MONTH', TIMESTAMP_NTZ '1970-01-01 00:00:00' + make_dt_interval(
    0, 0, 0, CAST(unix_micros(date_published) / 1000000 AS DECIMAL(18, 6)))) AS publication_month,
  count(*) AS `count`
FROM IDENTIFIER(:cves)
GROUP BY publication_month ORDER BY publication_month
"""


def table_counts(spark: SparkSession, cves: str = CVES, affected: str = AFFECTED) -> DataFrame:
    labels = {"cves_label": CVES_LABEL, "affected_label": AFFECTED_LABEL}
    return spark.sql(TABLE_COUNTS, {"cves": cves, "affected": affected, **labels})


def _ranking(spark: SparkSession, affected: str, keys: list[str], placeholders: list[str], k: int) -> DataFrame:
    """The same question for any keys: groups with the most ids, placeholder names left out."""
    names = {f"name{n}": name for n, name in enumerate(placeholders)}
    listed = ", ".join(f":{name}" for name in names)
    conditions = " AND ".join(f"{key} IS NOT NULL AND {key} NOT IN ({listed})" for key in keys)
    text = RANKING.format(keys=", ".join(keys), conditions=conditions)
    return spark.sql(text, {"affected": affected, "k": k, **names})


def top_vendors(spark: SparkSession, affected: str = AFFECTED, k: int = TOP_VENDORS) -> DataFrame:
    return _ranking(spark, affected, ["vendor"], VENDOR_PLACEHOLDERS, k)


def top_products(spark: SparkSession, affected: str = AFFECTED, k: int = TOP_PRODUCTS) -> DataFrame:
    return _ranking(spark, affected, ["vendor", "product"], PRODUCT_PLACEHOLDERS, k)


def severity_distribution(spark: SparkSession, cves: str = CVES) -> DataFrame:
    return spark.sql(SEVERITY_SQL, {"cves": cves})


def monthly_trend(spark: SparkSession, cves: str = CVES) -> DataFrame:
    """The month of UTC as a timestamp, where the DataFrame form gives a date."""
    return spark.sql(MONTHLY_SQL, {"cves": cves})
