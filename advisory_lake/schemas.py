"""Declared schemas of the pipeline's inputs, as DDL text."""

# The field names and types of the published record format. Fields
# that are not declared are dropped when a record is read, absent ones are null.
RECORD = """
    dataType STRING,
    dataVersion STRING,
    cveMetadata STRUCT<cveId: STRING, datePublished: STRING, dateUpdated: STRING>,
    containers STRUCT<cna: STRUCT<
        title: STRING,
        descriptions: ARRAY<STRUCT<value: STRING>>,
        affected: ARRAY<STRUCT<vendor: STRING, product: STRING>>,
        metrics: ARRAY<STRUCT<
            cvssV3_1: STRUCT<baseScore: DOUBLE, baseSeverity: STRING>,
            cvssV4_0: STRUCT<baseScore: DOUBLE, baseSeverity: STRING>>>>>
"""

# The part of a record that decides whether bronze keeps it.
RECORD_HEADER = "cveMetadata STRUCT<cveId: STRING, datePublished: STRING>"

SNAPSHOT = "relative_path STRING, file_content BINARY"

# The columns of Spark's binary file source.
BINARY_FILE = "path STRING, modificationTime TIMESTAMP, length LONG, content BINARY"

LISTING = "relative_path STRING, path STRING, length LONG, modificationTime TIMESTAMP"
