"""Run a registered query in Spark and its SQL in DuckDB, and compare the rows."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(tables_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tables_dir}/{name}.parquet'")
    return connection


def duck_rows(connection, sql: str):
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    return _normal(names, result.fetchall())


def spark_rows(df):
    return _normal(df.columns, [tuple(r) for r in df.collect()])


def _normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    shaped = [tuple(row[i] for i in order) for row in rows]
    return sorted(names), sorted(shaped, key=lambda row: tuple((v is None, str(v)) for v in row))


def plan_of(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
