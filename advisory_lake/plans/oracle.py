"""The registered queries as SQL over the test tables.

The SQL never sees a JSON document or a file: it derives each result from the rows the
stand-in records were made of.
"""

from __future__ import annotations

# Orders that bronze keeps, with the parts of their record.
KEPT = """
kept AS (
  SELECT o.*,
    'CVE-' || (year(o_orderdate) - CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) || '-'
      || lpad(o_orderkey::VARCHAR, greatest(7, length(o_orderkey::VARCHAR))::INT, '0') AS cve_id,
    CASE o_orderstatus
      WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%gZ')
      WHEN 'P' THEN strftime(o_orderdate - INTERVAL 5 HOUR, '%Y-%m-%dT%H:%M:%S.%g-05:00')
      ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS date_published_raw,
    CASE WHEN o_orderpriority <> '2-HIGH' THEN 'order ' || o_orderkey || ' status ' || o_orderstatus END AS title
  FROM orders o
  WHERE o_totalprice BETWEEN 5000 AND 495000 AND year(o_orderdate) = 1998)
"""

CVES = """
cves AS (
  SELECT cve_id, o_orderdate::TIMESTAMP AS date_published, title,
    CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus IN ('O', 'F') THEN NULL
         ELSE 'customer ' || o_custkey || ' placed order ' || o_orderkey END AS description,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
         WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'O' THEN NULL
         WHEN o_orderstatus = 'P' AND o_totalprice >= 250000 THEN 9.9::DOUBLE
         WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'F' THEN NULL
         ELSE floor(o_totalprice / 5000) / 10.0::DOUBLE END AS cvss_score,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
         WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'O' THEN NULL
         WHEN o_orderstatus = 'P' THEN 'CRITICAL'
         WHEN o_orderpriority = '1-URGENT' THEN 'CRITICAL'
         WHEN o_orderpriority = '2-HIGH' THEN CASE WHEN o_orderstatus <> 'F' THEN 'HIGH' END
         WHEN o_orderpriority = '3-MEDIUM' THEN 'MEDIUM'
         ELSE 'LOW' END AS cvss_severity
  FROM kept)
"""

AFFECTED = """
named AS (
  SELECT cve_id, o_orderpriority AS priority, 'product-' || o_orderstatus AS p,
    CASE WHEN o_orderstatus = 'F' THEN 'vendor-main' ELSE 'vendor-' || o_custkey END AS v
  FROM kept),
affected AS (
  SELECT cve_id, v AS vendor, p AS product FROM named WHERE priority <> '4-NOT SPECIFIED'
  UNION ALL SELECT cve_id, v, 'N/A' FROM named WHERE priority = '2-HIGH'
  UNION ALL SELECT cve_id, v, p FROM named WHERE priority = '3-MEDIUM'
  UNION ALL SELECT cve_id, 'Unknown', p FROM named WHERE priority = '3-MEDIUM'
  UNION ALL SELECT cve_id, v, 'Unknown' FROM named WHERE priority = '5-LOW'
  UNION ALL SELECT cve_id, 'n/a', 'n/a' FROM named WHERE priority = '5-LOW'
  UNION ALL SELECT cve_id, 'N/A', p FROM named WHERE priority = '5-LOW'
  UNION ALL SELECT cve_id, NULL, p FROM named WHERE priority = '5-LOW'
  UNION ALL SELECT cve_id, NULL, NULL FROM named WHERE priority = '4-NOT SPECIFIED')
"""

# Packed documents: the path as packed, the path as a file, and the size.
FILES = """
files AS (
  SELECT replace(packed_path, '\\', '/') AS clean_path, packed_path, size_bytes, lang, text
  FROM (
    SELECT size_bytes, lang, text,
      'cves' || sep || lang || sep || source || sep || (doc_id // 1000) || 'xxx' || sep || doc_id || ext AS packed_path
    FROM (
      SELECT doc_id, lang, source, text, octet_length(encode(text)) AS size_bytes,
        CASE WHEN source = 'src0' THEN '\\' ELSE '/' END AS sep,
        CASE WHEN source = 'src3' THEN '.md' ELSE '.json' END AS ext
      FROM documents)))
"""

ENTRIES = """
SELECT cve_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 WHEN '5-LOW' THEN 5
    ELSE CASE WHEN o_orderstatus = 'O' THEN -1 ELSE 0 END END AS n_affected,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 0
    WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'O' THEN -1
    WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS n_metrics
FROM kept
"""

TITLES = "SELECT cve_id, title FROM kept"

COUNTS = """
SELECT 'CVEs Table' AS table_name, count(*) AS record_count FROM cves
UNION ALL SELECT 'Affected Products Table', count(*) FROM affected
"""

VENDORS = """
SELECT vendor, count(DISTINCT cve_id) AS vulnerability_count FROM affected
WHERE vendor IS NOT NULL AND vendor NOT IN ('n/a', 'N/A')
GROUP BY vendor ORDER BY vulnerability_count DESC, vendor LIMIT 25
"""

PRODUCTS = """
SELECT vendor, product, count(DISTINCT cve_id) AS vulnerability_count FROM affected
WHERE vendor NOT IN ('n/a', 'N/A', 'Unknown') AND product NOT IN ('n/a', 'N/A', 'Unknown')
GROUP BY vendor, product ORDER BY vulnerability_count DESC, vendor, product LIMIT 10
"""

SEVERITY = """
SELECT cvss_severity, count(*) AS "count" FROM cves
WHERE cvss_severity IS NOT NULL GROUP BY cvss_severity
"""

MONTHLY = """
SELECT date_trunc('month', date_published)::{type} AS publication_month, count(*) AS "count"
FROM cves GROUP BY ALL
"""


def _with(*parts: str) -> str:
    *tables, final = parts
    return f"WITH {','.join(tables)} {final}"


def all_sql() -> dict[str, str]:
    kept, cves, affected = (KEPT,), (KEPT, CVES), (KEPT, AFFECTED)
    mixed = _with(
        *kept,
        f"""SELECT e.* FROM ({ENTRIES} WHERE o_orderstatus <> 'O' OR o_orderpriority <> '2-HIGH') e
            UNION ALL SELECT e.* FROM ({ENTRIES}
              WHERE o_orderstatus <> 'O' OR o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) e""",
    )
    return {
        "snapshot_pack": _with(FILES, "SELECT clean_path AS relative_path, size_bytes FROM files"),
        "snapshot_preview": _with(
            FILES, "SELECT packed_path AS relative_path, size_bytes FROM files ORDER BY packed_path LIMIT 5"
        ),
        "snapshot_path_normalize": _with(
            FILES,
            """SELECT packed_path AS relative_path, clean_path, '/restored/' || clean_path AS full_path,
               regexp_replace(clean_path, '/[^/]*$', '') AS parent_dir FROM files""",
        ),
        "snapshot_unpack": _with(
            FILES, "SELECT count(*) AS files_written, sum(size_bytes)::BIGINT AS bytes_written FROM files"
        ),
        "snapshot_restore": _with(FILES, "SELECT clean_path AS relative_path, size_bytes, sha256(text) AS sha256 FROM files"),
        "snapshot_row_parity": "SELECT count(*) AS packed_rows, count(*) AS tree_files, true AS passed FROM documents",
        "snapshot_content_verify": "SELECT count(*) AS files_compared, 0::BIGINT AS mismatched FROM documents",
        "snapshot_damage_verify": """
            SELECT count(*) + count(*) FILTER (source = 'src4') AS files_compared,
              count(*) FILTER (source IN ('src1', 'src2', 'src4')) AS mismatched FROM documents""",
        "snapshot_sample_verify": _with(
            FILES,
            """SELECT clean_path AS relative_path, true AS matches FROM (
               SELECT * FROM files ORDER BY md5('0' || packed_path), packed_path LIMIT 100)""",
        ),
        "partition_plan": "SELECT 200::BIGINT AS partitions, count(*) AS rows FROM lineitem",
        "file_inventory": _with(
            FILES, "SELECT clean_path AS relative_path, size_bytes AS length FROM files WHERE clean_path LIKE '%.json'"
        ),
        "files_per_year": _with(
            FILES,
            """SELECT split_part(clean_path, '/', 2) AS year, count(*) AS file_count FROM files
               WHERE clean_path LIKE '%.json' GROUP BY 1""",
        ),
        "files_total": _with(FILES, "SELECT count(*) AS total_files FROM files WHERE clean_path LIKE '%.json'"),
        "arrival_progress": """
            SELECT folder, found, expected, round(found / expected * 100, 2) AS percent, found >= expected AS complete
            FROM (
              SELECT 'cves' AS folder, count(*) AS found, count(*) AS expected FROM documents
              UNION ALL SELECT 'cves/en', count(*) FILTER (lang = 'en'), count(*) FROM documents
              UNION ALL SELECT 'not-yet-created', 0, count(*) FROM documents)""",
        "arrival_progress_stream": """
            SELECT count(*) AS found, count(*) AS expected, 100.0::DOUBLE AS percent, true AS complete FROM documents""",
        "arrival_second_poll": """
            SELECT 'first' AS poll, count(*) AS found, count(*) AS new, true AS opens_no_more FROM documents
            UNION ALL SELECT 'second', count(*), 0, true FROM documents""",
        "bronze_ingest_files": _with(*kept, ENTRIES),
        "bronze_ingest_lines": _with(*kept, ENTRIES),
        "bronze_ingest_encodings": _with(
            *kept,
            f"""SELECT e.* FROM ({ENTRIES}) e
                UNION ALL SELECT e.* FROM ({ENTRIES} WHERE o_orderstatus = 'O') e""",
        ),
        "bronze_ingest_mixed": mixed,
        "bronze_ingest_dated": mixed,
        "bronze_rejects": """
            WITH pieces AS (
              SELECT *, CASE
                WHEN o_orderstatus = 'F' THEN 'no record of ' || o_orderkey
                WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN '{"cut off": "' || o_orderkey || '", "at": ['
                WHEN o_orderstatus = 'O' AND o_orderpriority = '3-MEDIUM' THEN o_orderkey::VARCHAR END AS text FROM orders)
            SELECT (o_orderkey // 1000) || 'xxx/' || o_orderkey || '.json' AS relative_path, 'no document' AS reason, text
            FROM pieces WHERE text IS NOT NULL""",
        "bronze_ingest_counts": """
            SELECT true AS all_read, 0::BIGINT AS files_lost,
              sum(CASE WHEN o_orderstatus <> 'O' THEN 2
                WHEN o_orderpriority = '1-URGENT' THEN 1 WHEN o_orderpriority = '2-HIGH' THEN 0 ELSE 2 END)::BIGINT AS documents,
              count(*) FILTER (o_orderstatus = 'F' OR (o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '3-MEDIUM'))) AS rejected
            FROM orders""",
        "bronze_files_summary": """
            SELECT count(*) FILTER (o_orderstatus <> 'O') AS files_taken,
              count(*) FILTER (o_orderstatus = 'O') AS files_left_out,
              0::BIGINT AS files_without_record, 0::BIGINT AS files_with_several FROM orders""",
        "bronze_records": _with(*kept, "SELECT cve_id, date_published_raw, title FROM kept"),
        "bronze_reject_summary": """
            SELECT count(*) AS rows_read,
              count(*) FILTER (o_totalprice < 5000) AS without_id,
              count(*) FILTER (o_totalprice > 495000) AS without_date,
              count(*) FILTER (o_totalprice BETWEEN 5000 AND 495000 AND year(o_orderdate) <> 1998) AS other_year,
              count(*) FILTER (o_totalprice BETWEEN 5000 AND 495000 AND year(o_orderdate) = 1998) AS kept
            FROM orders""",
        "bronze_preview": _with(*kept, f"{TITLES} ORDER BY cve_id LIMIT 10"),
        "bronze_table_roundtrip": _with(*kept, TITLES),
        "bronze_output_files": "SELECT unnest(['merged', 'spread']) AS layout, true AS within_limit",
        "table_detail": _with(
            *kept,
            AFFECTED,
            """SELECT 'records' AS name, 'parquet' AS format, 4 AS column_count, count(*) AS row_count,
                 true AS has_files FROM kept
               UNION ALL SELECT 'cves', 'parquet', 6, count(*), true FROM kept
               UNION ALL SELECT 'affected_products', 'parquet', 3, count(*), true FROM affected""",
        ),
        "silver_cves": _with(*cves, "SELECT * FROM cves"),
        "silver_affected": _with(*affected, "SELECT * FROM affected"),
        "dq_null_ids": _with(*cves, "SELECT count(*) FILTER (cve_id IS NULL) AS null_ids FROM cves"),
        "dq_unique_ids": _with(
            *cves,
            """SELECT count(*) AS total_rows, count(DISTINCT cve_id) AS distinct_ids,
               count(*) = count(DISTINCT cve_id) AS passed FROM cves""",
        ),
        "dq_report": _with(
            *cves,
            """SELECT 'bronze_row_count' AS check_name, count(*) AS observed, 100::BIGINT AS threshold,
                 count(*) >= 100 AS passed FROM kept
               UNION ALL SELECT 'silver_row_count', count(*), 100, count(*) >= 100 FROM cves
               UNION ALL SELECT 'silver_null_ids', count(*) FILTER (cve_id IS NULL), 0,
                 count(*) FILTER (cve_id IS NULL) = 0 FROM cves
               UNION ALL SELECT 'silver_unique_ids', count(DISTINCT cve_id), count(*),
                 count(DISTINCT cve_id) = count(*) FROM cves""",
        ),
        "dq_report_damaged": _with(
            *cves,
            """, damaged AS (
                 SELECT cve_id FROM cves
                 UNION ALL SELECT cve_id FROM cves WHERE cvss_severity = 'CRITICAL'
                 UNION ALL SELECT NULL FROM cves WHERE cvss_severity = 'LOW')
               SELECT 'bronze_row_count' AS check_name, count(*) AS observed, 10000000::BIGINT AS threshold,
                 false AS passed FROM cves
               UNION ALL SELECT 'silver_row_count', count(*), 10000000, false FROM damaged
               UNION ALL SELECT 'silver_null_ids', count(*) FILTER (cve_id IS NULL), 0,
                 count(*) FILTER (cve_id IS NULL) = 0 FROM damaged
               UNION ALL SELECT 'silver_unique_ids', count(DISTINCT cve_id) + (count(*) FILTER (cve_id IS NULL) > 0)::INT,
                 count(*), count(DISTINCT cve_id) + (count(*) FILTER (cve_id IS NULL) > 0)::INT = count(*) FROM damaged""",
        ),
        "gold_table_counts": _with(*cves, AFFECTED, COUNTS),
        "gold_table_counts_sql": _with(*cves, AFFECTED, COUNTS),
        "gold_top_vendors": _with(*affected, VENDORS),
        "gold_top_vendors_sql": _with(*affected, VENDORS),
        "gold_severity": _with(*cves, SEVERITY),
        "gold_severity_sql": _with(*cves, SEVERITY),
        "gold_monthly": _with(*cves, MONTHLY.format(type="DATE")),
        "gold_monthly_sql": _with(*cves, MONTHLY.format(type="TIMESTAMP")),
        "gold_top_products": _with(*affected, PRODUCTS),
        "gold_top_products_sql": _with(*affected, PRODUCTS),
    }
