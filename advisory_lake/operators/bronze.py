"""Bronze: records as read, kept when they have an id and the wanted publication year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from advisory_lake import schemas
from advisory_lake.functions.scalars import instant, utc_wall_time
from advisory_lake.sources.records import cut_files, is_taken, packed_documents, records_of
from advisory_lake.sources.snapshot import PUBLISHED, SEVERAL_YEARS

PUBLICATION_YEAR = 2024


def _published_year(metadata: Column) -> Column:
    return F.year(utc_wall_time(instant(metadata["datePublished"])))


def keep_published(records: DataFrame, year: int = PUBLICATION_YEAR) -> DataFrame:
    """The year is that of the publication instant in UTC, never that of the folder or id."""
    metadata = F.col("cveMetadata")
    return records.filter(metadata["cveId"].isNotNull()).filter(_published_year(metadata) == year)


def kept_documents(documents: DataFrame, year: int = PUBLICATION_YEAR) -> DataFrame:
    """The kept records among cut documents. Id and date, which cutting has looked at, decide, so
    that the full parse is spent on the wanted records only."""
    header = F.col("header.cveMetadata")
    wanted = documents.filter("fault is null").filter(header["cveId"].isNotNull() & (_published_year(header) == year))
    return records_of(wanted)


def published_records(
    snapshot: DataFrame, year: int = PUBLICATION_YEAR, folder: str = "", suffix: str = ""
) -> DataFrame:
    """The kept records of packed files: of all, or of those in a folder or with a suffix."""
    return kept_documents(packed_documents(snapshot, folder, suffix), year)


def dated(snapshot: DataFrame) -> DataFrame:
    """Packed files with the year their documents are published in: one number when they agree,
    ``SEVERAL_YEARS`` when they do not, null for a file without a dated document."""
    cut = cut_files(snapshot)
    in_pieces = F.transform(
        F.filter("pieces", lambda piece: piece["whole"]),
        lambda piece: _published_year(F.from_json(piece["text"], f"STRUCT<{schemas.RECORD_HEADER}>")["cveMetadata"]),
    )
    single = F.array(_published_year(F.get("headers", 0)["cveMetadata"]))
    years = F.array_distinct(F.array_compact(F.when(F.col("pieces").isNull(), single).otherwise(in_pieces)))
    # a column of its own, so that the pieces are parsed once and not for each use
    known = cut.select("relative_path", "file_content", years.alias("years"))
    published = F.when(F.size("years") > 1, F.lit(SEVERAL_YEARS)).otherwise(F.get("years", 0))
    return known.select("relative_path", "file_content", published.alias(PUBLISHED))


def files_summary(snapshot: DataFrame, folder: str = "", suffix: str = "") -> DataFrame:
    """How many files ingest takes, leaves out, and finds no document or several in."""
    documents = F.when(F.col("pieces").isNull(), 1).otherwise(F.size(F.filter("pieces", lambda piece: piece["whole"])))
    counted = cut_files(snapshot).select(is_taken(folder, suffix).alias("taken"), documents.alias("n"))
    return counted.agg(
        F.count_if("taken").alias("files_taken"),
        F.count_if(~F.col("taken")).alias("files_left_out"),
        F.count_if(F.col("taken") & (F.col("n") == 0)).alias("files_without_record"),
        F.count_if(F.col("taken") & (F.col("n") > 1)).alias("files_with_several"),
    )


def reject_summary(records: DataFrame, year: int = PUBLICATION_YEAR) -> DataFrame:
    """What the two filters drop, by reason, in one pass."""
    metadata = F.col("cveMetadata")
    has_id, published = metadata["cveId"].isNotNull(), _published_year(metadata)
    return records.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(~has_id).alias("without_id"),
        F.count_if(has_id & published.isNull()).alias("without_date"),
        F.count_if(has_id & (published != year)).alias("other_year"),
        F.count_if(has_id & (published == year)).alias("kept"),
    )
