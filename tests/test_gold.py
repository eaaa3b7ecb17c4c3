"""Gold and quality on hand-made and skewed tables, against plain Python."""

from collections import defaultdict
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from advisory_lake.operators import gold, quality
from advisory_lake.plans import gold_sql
from advisory_lake.session import utc

AFFECTED = "cve_id STRING, vendor STRING, product STRING"
CVES = """cve_id STRING, date_published TIMESTAMP, title STRING, description STRING,
          cvss_score DOUBLE, cvss_severity STRING"""


def brute(rows, columns, excluded, k):
    seen = defaultdict(set)
    for row in rows:
        key = tuple(row[c] for c in columns)
        if all(part is not None and part not in excluded for part in key):
            seen[key] |= {row[0]} - {None}
    ranked = sorted(seen.items(), key=lambda item: (-len(item[1]), item[0]))
    return [(*key, len(ids)) for key, ids in ranked[:k]]


name = st.sampled_from(["a", "b", "c", "n/a", "N/A", "N/a", " n/a", "Unknown", None])
row = st.tuples(st.sampled_from(["1", "2", "3", "4", None]), name, name)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, max_size=30), k=st.integers(1, 6))
def test_rankings_equal_brute_force_on_both_surfaces(spark, rows, k):
    affected = spark.createDataFrame(rows, AFFECTED)
    affected.createOrReplaceTempView("affected_view")
    vendors = brute(rows, [1], {"n/a", "N/A"}, k)
    products = brute(rows, [1, 2], {"n/a", "N/A", "Unknown"}, k)
    assert [tuple(r) for r in gold.top_vendors(affected, k).collect()] == vendors
    assert [tuple(r) for r in gold_sql.top_vendors(spark, "affected_view", k).collect()] == vendors
    assert [tuple(r) for r in gold.top_products(affected, k).collect()] == products
    assert [tuple(r) for r in gold_sql.top_products(spark, "affected_view", k).collect()] == products


def test_a_vendor_with_a_third_of_all_rows(spark):
    rows = [(str(i), "hot" if i % 3 == 0 else f"v{i % 40}", "p") for i in range(9000)]
    rows += [(str(i), "hot", "p") for i in range(0, 9000, 3)]  # every hot pair twice
    affected = spark.createDataFrame(rows, AFFECTED)
    assert [tuple(r) for r in gold.top_vendors(affected).collect()] == brute(rows, [1], {"n/a", "N/A"}, 25)


@pytest.fixture(scope="module")
def cves(spark):
    rows = [
        ("1", datetime(2024, 1, 31, 23, 59, 59), None, None, 1.0, "LOW"),
        ("2", datetime(2024, 2, 1), None, None, None, "LOW"),
        ("3", datetime(2024, 2, 29), None, None, 9.0, "HIGH"),
        ("4", None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, CVES)
    df.createOrReplaceTempView("cves_view")
    return df


def test_severity_on_both_surfaces(spark, cves):
    expected = [("LOW", 2), ("HIGH", 1)]
    assert [tuple(r) for r in gold.severity_distribution(cves).collect()] == expected
    assert [tuple(r) for r in gold_sql.severity_distribution(spark, "cves_view").collect()] == expected


def test_months_on_both_surfaces(spark, cves):
    by_frame, by_sql = gold.monthly_trend(cves), gold_sql.monthly_trend(spark, "cves_view")
    assert dict(by_frame.dtypes)["publication_month"] == "date"
    assert dict(by_sql.dtypes)["publication_month"] == "timestamp"
    as_text = [(m and m.isoformat()[:10], n) for m, n in by_frame.collect()]
    assert as_text == [(None, 1), ("2024-01-01", 1), ("2024-02-01", 2)]
    assert [(m and m.isoformat()[:10], n) for m, n in by_sql.collect()] == as_text


def test_table_counts_on_both_surfaces(spark, cves):
    spark.createDataFrame([], AFFECTED).createOrReplaceTempView("none_view")
    expected = [("Affected Products Table", 0), ("CVEs Table", 4)]
    assert sorted(tuple(r) for r in gold.table_counts(cves, spark.table("none_view")).collect()) == expected
    assert sorted(tuple(r) for r in gold_sql.table_counts(spark, "cves_view", "none_view").collect()) == expected


def report(spark, ids, min_rows=1):
    cves = spark.createDataFrame([(i, None, None, None, None, None) for i in ids], CVES)
    return quality.quality_report(cves, cves, min_rows)


@pytest.mark.parametrize(
    "ids, min_rows, failed",
    [
        (["1", "2"], 1, []),
        (["1", "2"], 3, ["bronze_row_count", "silver_row_count"]),
        (["1", "1"], 1, ["silver_unique_ids"]),
        (["1", None], 1, ["silver_null_ids"]),
        (["1", None, None], 1, ["silver_null_ids", "silver_unique_ids"]),
        ([], 1, ["bronze_row_count", "silver_row_count"]),
    ],
)
def test_checks(spark, ids, min_rows, failed):
    rows = report(spark, ids, min_rows)
    assert sorted(r.check_name for r in rows.collect() if not r.passed) == failed
    if failed:
        with pytest.raises(quality.QualityError, match=failed[0]):
            quality.enforce(rows)
    else:
        quality.enforce(rows)


def test_reference_threshold_is_the_default(spark):
    empty = spark.createDataFrame([], CVES)
    observed = {r.check_name: r.threshold for r in quality.quality_report(empty, empty).collect()}
    assert observed["bronze_row_count"] == observed["silver_row_count"] == 30_000


def test_utc_guard_restores_the_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    with pytest.raises(ValueError), utc(spark):
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
        raise ValueError
    assert spark.conf.get("spark.sql.session.timeZone") == before
