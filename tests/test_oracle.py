"""Every registered query against its SQL in DuckDB, over the whole test tables."""

import pytest
from harness import duck, duck_rows, spark_rows

from advisory_lake.plans import oracle, registry

QUERIES = registry.all_queries()
SQL = oracle.all_sql()


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_sql(spark, key, scale):
    tables_dir = f"/root/testdata/sf{scale}"
    assert spark_rows(QUERIES[key](spark, tables_dir)) == duck_rows(duck(tables_dir), SQL[key])


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    import __spark_entry__

    result = __spark_entry__.entry(spark)
    assert result.columns == ["vendor", "vulnerability_count"]
    assert result.count() == 25


@pytest.mark.parametrize("key", ["gold_monthly", "gold_monthly_sql", "bronze_records", "silver_cves"])
def test_results_do_not_follow_the_session_zone(spark, key):
    tables_dir = "/root/testdata/sf0.001"
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        result = spark_rows(QUERIES[key](spark, tables_dir))
        assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert result == duck_rows(duck(tables_dir), SQL[key])
