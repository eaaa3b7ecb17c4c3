"""Catalog tables: schema creation, full replacement, reads and metadata."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from advisory_lake.session import delete_folder
from advisory_lake.sources.tree import file_sizes

_TRANSACTIONAL = ("delta", "iceberg", "hudi")


def ensure_schema(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} LOCATION {_quoted(location)}")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def replace_table(df: DataFrame, name: str, path: str, table_format: str = "parquet") -> None:
    """Replace a table's rows and schema.

    The rows are written beside the old ones first, into a version folder of their own below
    ``path``, and the catalog is pointed there when all of them are: in one step, or, when the
    columns change, by dropping and creating the entry. A job that fails leaves the table as it
    was; the rows may come from the table itself. Old versions go afterwards, also those that an
    earlier session has left at the path. Formats that replace their tables in one step of their
    own, and keep old files, do it that way.
    """
    spark = df.sparkSession
    if table_format in _TRANSACTIONAL:
        df.write.format(table_format).mode("overwrite").option("overwriteSchema", True).option("path", path).saveAsTable(name)
        return
    version = f"{path}/version-{uuid.uuid4().hex[:12]}"
    df.write.format(table_format).save(version)
    schema = spark.read.format(table_format).load(version).schema
    if spark.catalog.tableExists(name) and spark.table(name).schema == schema:
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(version)}")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # an external one, whose files stay
        spark.catalog.createTable(name, version, table_format, schema)
    spark.catalog.refreshTable(name)
    for other in _entries(spark, path):
        if other != version.rpartition("/")[2]:
            delete_folder(spark, f"{path}/{other}")


def _entries(spark: SparkSession, folder: str) -> list[str]:
    """Names of a table folder's entries: versions, of which there are one or two."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return [status.getPath().getName() for status in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)]


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def table_detail(spark: SparkSession, name: str) -> DataFrame:
    """One row: name, format, location, column_count, num_files, size_in_bytes, row_count."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name} AS JSON")
    columns = F.from_json(F.get_json_object("json_metadata", "$.columns"), "ARRAY<STRING>")
    meta = described.select(
        F.get_json_object("json_metadata", "$.table_name").alias("name"),
        F.get_json_object("json_metadata", "$.provider").alias("format"),
        F.get_json_object("json_metadata", "$.location").alias("location"),
        F.size(columns).alias("column_count"),
    ).first()
    # the files that a read of the table opens now, not all that lie in its folder
    table = read_table(spark, name)
    stored = file_sizes(spark, table.inputFiles()).first()
    return table.agg(
        F.lit(meta["name"]).alias("name"),
        F.lit(meta["format"]).alias("format"),
        F.lit(meta["location"]).alias("location"),
        F.lit(meta["column_count"]).alias("column_count"),
        F.lit(stored["files"]).alias("num_files"),
        F.lit(stored["bytes"]).alias("size_in_bytes"),
        F.count(F.lit(1)).alias("row_count"),
    )
