"""Nested JSON records from the bytes of files, in a tree or a packed snapshot alike.

Files are cut into documents first (``sources.documents``), so that a bad one beside them costs
no good one. Every document and every rejected piece is a row with its file and place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from advisory_lake import schemas
from advisory_lake.functions.paths import clean_path
from advisory_lake.session import modest_listing, settings
from advisory_lake.sources.documents import INCOMPLETE, OPENED, RANGE_BYTES, UNREADABLE, cut_texts, cut_tree, documents_of
from advisory_lake.sources.stores import walk

RECORD_FOLDER = "cves"


def read_record_lines(spark: SparkSession, root: str) -> DataFrame:
    """Records of files with one document per line, which split. Text that is no record gives
    a row of nulls."""
    reader = spark.read.schema(schemas.RECORD).option("recursiveFileLookup", True)
    with modest_listing(spark):
        return reader.json(root)


def read_record_files(spark: SparkSession, root: str, folder: str = "", suffix: str = "") -> DataFrame:
    """Records of all files below ``root``, or of those in a folder or with a suffix; a row of
    nulls for a piece that is no record and for a file without any."""
    return records_of(tree_documents(spark, root, folder, suffix))


def taken(snapshot: DataFrame, folder: str = "", suffix: str = "") -> DataFrame:
    """The files that ingest looks at: all, or those in a folder or with a suffix."""
    return snapshot.filter(is_taken(folder, suffix))


def is_taken(folder: str = "", suffix: str = "") -> Column:
    """Whether a packed file is one that ingest looks at."""
    path = clean_path(F.col("relative_path"))
    inside = path.startswith(f"{folder.strip('/')}/") if folder.strip("/") else F.lit(True)
    return F.coalesce(inside & path.endswith(suffix), F.lit(False))


def text_of(content: Column) -> Column:
    """A file's text: UTF-16 by its mark, else UTF-8 whose stray bytes become replacement
    characters; the mark itself is no text."""
    head = F.hex(F.substring(content, 1, 3))
    body = F.substring(content, 3, 2_147_483_647)
    return (
        F.when(head.startswith("FFFE"), F.decode(body, "UTF-16LE"))
        .when(head.startswith("FEFF"), F.decode(body, "UTF-16BE"))
        .otherwise(F.make_valid_utf8(F.when(head == "EFBBBF", F.substring(content, 4, 2_147_483_647)).otherwise(content).cast("string")))
    )


def cut_files(snapshot: DataFrame, folder: str = "", suffix: str = "") -> DataFrame:
    """The texts of packed files, cut where they are not one record each."""
    with lenient_text(snapshot.sparkSession):
        return cut_texts(taken(snapshot, folder, suffix), text_of(F.col("file_content")), schemas.RECORD_HEADER)


def packed_documents(snapshot: DataFrame, folder: str = "", suffix: str = "") -> DataFrame:
    """relative_path, place, text, fault and header of every piece of packed files; a row of nulls
    for a file without any. Places count bytes of the decoded text."""
    return documents_of(cut_files(snapshot, folder, suffix), schemas.RECORD_HEADER)


def tree_documents(
    spark: SparkSession,
    root: str,
    folder: str = "",
    suffix: str = "",
    listing: DataFrame | None = None,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """The same of the files of a tree, whatever their size, and a row besides for each file that
    was opened or could not be read."""
    files = taken(walk(spark, root) if listing is None else listing, folder, suffix)
    header = F.from_json("text", f"STRUCT<{schemas.RECORD_HEADER}>")
    return cut_tree(spark, root, files, range_bytes).withColumn("header", F.when(F.col("fault").isNull(), header))


def records_of(documents: DataFrame, schema: str = schemas.RECORD) -> DataFrame:
    """The record of every piece, a row of nulls for one that is none and for a file without
    pieces. ``schema`` may be any part of the record's."""
    pieces = documents.filter(~F.coalesce(F.col("fault").isin(OPENED, UNREADABLE), F.lit(False)))
    text = F.when(F.col("fault").isNull(), F.col("text"))
    return pieces.select(F.from_json(text, f"STRUCT<{schema}>").alias("record")).select("record.*")


def parse_packed(files: DataFrame, schema: str = schemas.RECORD) -> DataFrame:
    """The records of packed files without recreating any."""
    return records_of(packed_documents(files), schema)


def rejected(documents: DataFrame) -> DataFrame:
    """relative_path, place, reason and text of the pieces that are no JSON object, and of the
    files that could not be read (no place, no text)."""
    broken = F.when(F.col("text").isNotNull() & F.try_parse_json("text").isNull(), F.lit(INCOMPLETE))
    reason = F.coalesce("fault", broken)
    found = documents.withColumn("reason", reason).filter(F.col("reason") != OPENED)
    return found.select("relative_path", "place", "reason", "text")


def read_counts() -> list[Column]:
    """What to count over the documents of a tree."""
    fault = F.coalesce("fault", F.lit(""))
    return [
        F.count_if(fault == OPENED).alias("files_read"),
        F.count_if(fault == UNREADABLE).alias("files_lost"),
        F.count_if((fault == "") & F.col("text").isNotNull()).alias("documents"),
        F.count_if(fault == INCOMPLETE).alias("rejected"),
    ]


def lenient_text(spark: SparkSession):
    """Plans made inside decode malformed text with replacement characters instead of failing."""
    return settings(spark, {"spark.sql.legacy.codingErrorAction": "true"})
