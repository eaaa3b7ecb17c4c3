"""Data-quality checks that give rows and can fail the job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_ROWS = 30_000


class QualityError(Exception):
    """At least one check did not pass."""


@dataclass(frozen=True)
class Check:
    """An aggregate over a table and what it is held against."""

    name: str
    observed: Column
    threshold: Column
    exact: bool = True

    def row(self) -> Column:
        observed, threshold = self.observed.cast("long"), self.threshold.cast("long")
        passed = observed == threshold if self.exact else observed >= threshold
        return F.struct(
            F.lit(self.name).alias("check_name"),
            observed.alias("observed"),
            threshold.alias("threshold"),
            passed.alias("passed"),
        )


def distinct_values(column: str) -> Column:
    """Distinct values, all nulls together counting as one."""
    return F.count_distinct(column) + F.coalesce(F.max(F.col(column).isNull().cast("int")), F.lit(0))


def enough_rows(name: str, min_rows: int = MIN_ROWS) -> Check:
    return Check(name, F.count(F.lit(1)), F.lit(min_rows), exact=False)


def no_nulls(name: str, column: str) -> Check:
    return Check(name, F.count_if(F.col(column).isNull()), F.lit(0))


def unique(name: str, column: str) -> Check:
    return Check(name, distinct_values(column), F.count(F.lit(1)))


def run_checks(table: DataFrame, *checks: Check) -> DataFrame:
    """All checks of a table from one aggregation: check_name, observed, threshold, passed."""
    rows = table.agg(F.array(*(check.row() for check in checks)).alias("rows"))
    return rows.select(F.inline("rows"))


def quality_report(bronze: DataFrame, cves: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    return run_checks(bronze, enough_rows("bronze_row_count", min_rows)).unionByName(
        run_checks(
            cves,
            enough_rows("silver_row_count", min_rows),
            no_nulls("silver_null_ids", "cve_id"),
            unique("silver_unique_ids", "cve_id"),
        )
    )


def enforce(report: DataFrame) -> None:
    """Raise with every failed check. A report has one row per check."""
    failed = report.filter(~F.col("passed")).collect()
    if failed:
        told = "; ".join(f"{r.check_name}: observed {r.observed}, threshold {r.threshold}" for r in failed)
        raise QualityError(told)
