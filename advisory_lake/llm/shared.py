"""Reading tables, written intermediate tables and Arrow batches of texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from advisory_lake.session import run_folder, ship_package


_worker_cache: tuple[str, dict] = ("", {})


def worker_cache(owner: str) -> dict:
    """What a worker process remembers for one operator from task to task. Workers outlive a
    stage: what another operator has left is dropped."""
    global _worker_cache
    if _worker_cache[0] != owner:
        _worker_cache = (owner, {})
    return _worker_cache[1]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: evaluated once, and safe from lost executors."""
    path = run_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_and_text(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, so that other columns of any name do not matter."""
    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def text_key() -> Column:
    """Tells rows that repeat a doc_id with another text apart; null text has a key too."""
    text = F.col("text").cast("string")
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def slices(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a slice holds at most so many bytes of text, or one row."""
    texts = batch.column(batch.schema.get_field_index(column))
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if len(sizes) > start:
        yield batch.slice(start)


def per_row(function: Callable[[int | None, str | None], tuple], schema: pa.Schema) -> Callable:
    """For mapInArrow over (doc_id, text): one row out for each row in."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                rows = [function(i, t) for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist())]
                columns = list(zip(*rows)) if rows else [()] * len(schema)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, field.type) for values, field in zip(columns, schema)], schema=schema
                )

    return run
