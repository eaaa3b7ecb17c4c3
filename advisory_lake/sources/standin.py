"""Advisory records and file trees made from the test tables.

Both feeds are narrow: every output row comes from one input row, so no key can grow
into an oversized group and nothing is shuffled. Which case a record shows (null id,
unreadable date, empty array, ...) follows from the order's own columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PUBLICATION_YEAR = 1998

# Reserved a year before publication for status P; keys of any length stay whole.
RECORD_ID = """
concat_ws('-', 'CVE', year(o_orderdate) - CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END,
  lpad(o_orderkey, greatest(7, length(string(o_orderkey))), '0'))
"""

# The same instant written with Z, with an offset, or without a zone; some unreadable.
PUBLISHED = """
CASE
  WHEN o_totalprice > 495000 THEN 'not-a-date'
  WHEN o_orderstatus = 'F' THEN date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
  WHEN o_orderstatus = 'P' THEN date_format(o_orderdate - INTERVAL 5 HOURS, "yyyy-MM-dd'T'HH:mm:ss.SSS'-05:00'")
  ELSE date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss")
END
"""

# A third of all records share one vendor.
VENDOR = "CASE WHEN o_orderstatus = 'F' THEN 'vendor-main' ELSE concat('vendor-', o_custkey) END"
PRODUCT = "concat('product-', o_orderstatus)"

# Repeated vendors, repeated pairs, placeholders, nulls, an empty and an absent list.
AFFECTED = f"""
transform(
  CASE o_orderpriority
    WHEN '1-URGENT' THEN array(array({VENDOR}, {PRODUCT}))
    WHEN '2-HIGH' THEN array(array({VENDOR}, {PRODUCT}), array({VENDOR}, 'N/A'))
    WHEN '3-MEDIUM' THEN array(array({VENDOR}, {PRODUCT}), array({VENDOR}, {PRODUCT}), array('Unknown', {PRODUCT}))
    WHEN '5-LOW' THEN array(array({VENDOR}, {PRODUCT}), array({VENDOR}, 'Unknown'), array('n/a', 'n/a'),
                            array('N/A', {PRODUCT}), array(NULL, {PRODUCT}))
    ELSE CASE WHEN o_orderstatus <> 'O' THEN array() END
  END,
  pair -> named_struct('vendor', pair[0], 'product', pair[1]))
"""

DESCRIPTIONS = """
CASE
  WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'O' THEN NULL
  WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN array()
  ELSE array(named_struct('value', concat('customer ', o_custkey, ' placed order ', o_orderkey)),
             named_struct('value', 'second'))
END
"""

# The score blocks choose their version apart from each other; the second entry is a decoy.
METRIC = """
named_struct(
  'cvssV3_1', CASE WHEN o_orderpriority <> '2-HIGH' OR o_orderstatus <> 'F' THEN named_struct(
    'baseScore', floor(o_totalprice / 5000) / 10.0D,
    'baseSeverity', CASE o_orderpriority WHEN '1-URGENT' THEN 'CRITICAL' WHEN '2-HIGH' THEN 'HIGH'
                                         WHEN '3-MEDIUM' THEN 'MEDIUM' WHEN '5-LOW' THEN 'LOW' END) END,
  'cvssV4_0', CASE WHEN o_orderstatus = 'P' THEN named_struct(
    'baseScore', CASE WHEN o_totalprice >= 250000 THEN 9.9D END, 'baseSeverity', 'CRITICAL') END,
  'cvssV2_0', named_struct('baseScore', 1.0D))
"""
DECOY = """
named_struct(
  'cvssV3_1', named_struct('baseScore', 0.1D, 'baseSeverity', 'LOW'),
  'cvssV4_0', CAST(NULL AS STRUCT<baseScore: DOUBLE, baseSeverity: STRING>),
  'cvssV2_0', named_struct('baseScore', 1.0D))
"""
METRICS = f"""
CASE
  WHEN o_orderpriority = '4-NOT SPECIFIED' THEN array()
  WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'O' THEN NULL
  WHEN o_orderstatus = 'F' THEN array({METRIC}, {DECOY})
  ELSE array({METRIC})
END
"""

# Fields beyond the declared schema are there to be dropped on reading.
DOCUMENT = f"""
named_struct(
  'dataType', 'CVE_RECORD',
  'dataVersion', '5.1',
  'cveMetadata', named_struct(
    'cveId', CASE WHEN o_totalprice >= 5000 THEN {RECORD_ID} END,
    'datePublished', {PUBLISHED},
    'dateUpdated', {PUBLISHED},
    'state', 'PUBLISHED'),
  'containers', named_struct('cna', named_struct(
    'title', CASE WHEN o_orderpriority <> '2-HIGH' THEN concat('order ', o_orderkey, ' status ', o_orderstatus) END,
    'descriptions', {DESCRIPTIONS},
    'affected', {AFFECTED},
    'metrics', {METRICS})))
"""

SEPARATOR = "CASE WHEN {column} = '{value}' THEN char(92) ELSE '/' END"


def record_documents(orders: DataFrame) -> DataFrame:
    """One document per order, as columns."""
    return orders.select(F.expr(DOCUMENT).alias("document")).select("document.*")


def record_snapshot(orders: DataFrame) -> DataFrame:
    """The same documents as packed files, pretty-printed for status F, with backslash
    paths for status O. A folder holds at most a thousand files."""
    separator = SEPARATOR.format(column="o_orderstatus", value="O")
    folder = "concat(o_orderkey div 1000, 'xxx')"
    path = f"concat_ws({separator}, 'cves', year(o_orderdate), {folder}, concat({RECORD_ID}, '.json'))"
    text = f"""
        CASE WHEN o_orderstatus = 'F' THEN to_json({DOCUMENT}, map('pretty', 'true')) ELSE to_json({DOCUMENT}) END
    """
    return orders.selectExpr(f"{path} AS relative_path", f"encode({text}, 'UTF-8') AS file_content")


def odd_record_snapshot(orders: DataFrame) -> DataFrame:
    """The same documents as files of other kinds: with a byte-order mark for status F, in UTF-16
    and under a name that starts with ``_`` for P, twice in a file named ``.jsonl`` for O."""
    folder = "concat(o_orderkey div 1000, 'xxx')"
    name = f"""
        CASE o_orderstatus WHEN 'P' THEN concat('_', {RECORD_ID}, '.json')
          WHEN 'O' THEN concat({RECORD_ID}, '.jsonl') ELSE concat({RECORD_ID}, '.json') END
    """
    text = f"to_json({DOCUMENT})"
    content = f"""
        CASE o_orderstatus WHEN 'F' THEN concat(X'EFBBBF', encode({text}, 'UTF-8'))
          WHEN 'P' THEN concat(X'FFFE', encode({text}, 'UTF-16LE'))
          ELSE encode(concat({text}, char(10), {text}), 'UTF-8') END
    """
    return orders.selectExpr(f"concat_ws('/', {folder}, {name}) AS relative_path", f"{content} AS file_content")


def mixed_texts(orders: DataFrame) -> DataFrame:
    """The same documents with bad company, as texts of some lines each: a bad line between two
    of them, two on one line, one cut off before another, an array with other values, or two
    pretty-printed ones. Each names its order."""
    plain = "o_orderstatus IN ('F', 'P') OR o_orderpriority IN ('1-URGENT', '3-MEDIUM')"
    blank, pretty = "o_orderpriority = '2-HIGH'", "map('pretty', 'true')"
    document = f"CASE WHEN {plain} THEN to_json({DOCUMENT}) WHEN {blank} THEN NULL ELSE to_json({DOCUMENT}, {pretty}) END"
    content = f"""
        CASE
          WHEN o_orderstatus = 'F' THEN concat(document, '\\n', 'no record of ', o_orderkey, '\\n', document)
          WHEN o_orderstatus = 'P' THEN concat(document, document)
          WHEN o_orderpriority = '1-URGENT' THEN concat('{{"cut off": "', o_orderkey, '", "at": [\\n', document)
          WHEN {blank} THEN '  '
          WHEN o_orderpriority = '3-MEDIUM' THEN concat('[', document, ', ', o_orderkey, ', ', document, ']')
          ELSE concat(document, '\\n', document) END
    """
    # written once for each order: a column of its own, which the optimizer does not copy into its uses
    written = orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", F.expr(document).alias("document"))
    return written.selectExpr("o_orderkey", f"{content} AS text")


def document_snapshot(documents: DataFrame) -> DataFrame:
    """Whole texts as packed files: language as the year folder, at most a thousand files
    in a folder, some names that are not JSON, some paths with backslashes."""
    separator = SEPARATOR.format(column="source", value="src0")
    folder = "concat(doc_id div 1000, 'xxx')"
    name = "concat(doc_id, CASE WHEN source = 'src3' THEN '.md' ELSE '.json' END)"
    path = f"concat_ws({separator}, 'cves', lang, source, {folder}, {name})"
    return documents.selectExpr(f"{path} AS relative_path", "encode(text, 'UTF-8') AS file_content")
