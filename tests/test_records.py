"""Edge records, read from a tree and from a packed snapshot."""

import json

import pytest
from pyspark.sql import functions as F

from advisory_lake import schemas
from advisory_lake.functions.scalars import instant
from advisory_lake.operators import bronze, gold, packing, silver
from advisory_lake.session import settings, utc
from advisory_lake.sources.records import parse_packed, read_record_files, read_record_lines, taken
from advisory_lake.sources.snapshot import read_snapshot


def record(number, published="2024-03-05T10:00:00.000Z", **cna):
    return {
        "dataType": "CVE_RECORD",
        "cveMetadata": {"cveId": f"CVE-2024-{number:04d}", "datePublished": published, "state": "PUBLISHED"},
        "containers": {"cna": cna, "adp": [{"title": "dropped"}]},
    }


def score(**versions):
    return {name: {"baseScore": s, "baseSeverity": v} for name, (s, v) in versions.items()}


TWO = [{"vendor": "acme", "product": "anvil", "versions": []}, {"vendor": "n/a", "product": "n/a"}]

FILES = {
    "2024/a/compact.json": json.dumps(record(1, title="t1", affected=TWO)),
    "2024/a/pretty.json": json.dumps(record(2, title="t2", affected=TWO), indent=4),
    "2024/a/empty_lists.json": json.dumps(record(3, descriptions=[], affected=[], metrics=[])),
    "2024/a/absent_lists.json": json.dumps(record(4)),
    "2024/b/other_side_of_midnight.json": json.dumps(record(5, "2024-01-01T00:30:00+02:00")),
    "2024/b/no_zone.json": json.dumps(record(6, "2024-12-31T23:59:59")),
    "2024/b/malformed_date.json": json.dumps(record(7, "soon")),
    "2024/b/null_date.json": json.dumps(record(8, None)),
    "2024/b/array_of_others.json": '[{"a": 1}, {"b": 2}]',
    "2023/b/published_later.json": json.dumps(record(9, "2024-01-01T00:00:00Z")),
    "2024/c/text_score.json": json.dumps(record(10, metrics=[score(cvssV3_1=("7.5", "HIGH"))])),
    "2024/c/twice.json": json.dumps(record(11)),
    "2024/c/twice_again.json": json.dumps(record(11)),
    "2024/c/empty.json": "",
    "2024/c/truncated.json": json.dumps(record(12))[:-20],
    "2024/c/array_of_records.json": json.dumps([record(13), record(14)]),
    "2024/c/null_id.json": json.dumps({"cveMetadata": {"cveId": None, "datePublished": "2024-01-01T00:00:00Z"}}),
    "2024/d/mixed_versions.json": json.dumps(
        record(15, metrics=[score(cvssV4_0=(None, "LOW"), cvssV3_1=(8.0, "HIGH"))])
    ),
    "2024/d/second_metric.json": json.dumps(
        record(16, metrics=[score(cvssV3_0=(5.0, "MEDIUM")), score(cvssV3_1=(9.0, "CRITICAL"))])
    ),
    "2024/d/both_versions.json": json.dumps(
        record(17, metrics=[score(cvssV4_0=(6.1, "MEDIUM"), cvssV3_1=(9.0, "CRITICAL"))])
    ),
    "2024/d/.DS_Store": "junk",
    "2024/d/_x.json": json.dumps(record(18)),
    "2024/d/README.md": json.dumps(record(19)),
    "2024/d/records.JSON": json.dumps(record(20)),
}

KEPT = [1, 2, 3, 4, 6, 9, 10, 11, 11, 13, 14, 15, 16, 17, 18, 19, 20]
JSON_NAMES = KEPT[:-2]


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("records") / "cves"
    for name, text in FILES.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    (root / "2024/d/bad_bytes.json").write_bytes(b"\xff\xfe{\x80")
    return root


@pytest.fixture(scope="module")
def snapshot(spark, tree, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("packed"))
    return packing.pack_tree(spark, str(tree.parent), path)


def ids(df):
    return sorted(int(r[0][-4:]) for r in df.select("cveMetadata.cveId").collect())


def test_files_and_snapshot_keep_the_same_records(spark, tree, snapshot):
    with utc(spark):
        from_files = bronze.keep_published(read_record_files(spark, str(tree)))
        from_snapshot = bronze.published_records(snapshot)
        plain = bronze.keep_published(parse_packed(snapshot))
        named = bronze.published_records(snapshot, folder="cves", suffix=".json")
    assert ids(from_files) == KEPT
    assert ids(from_snapshot) == KEPT
    assert ids(plain) == KEPT
    assert ids(named) == JSON_NAMES
    text = F.to_json(F.struct("*")).alias("j")
    assert sorted(from_files.select(text).collect()) == sorted(from_snapshot.select(text).collect())


def test_year_is_that_of_the_utc_instant(spark, snapshot):
    with utc(spark):
        assert ids(bronze.published_records(snapshot, 2023)) == [5]


def test_single_line_mode_loses_pretty_documents(spark, tree):
    with utc(spark):
        kept = bronze.keep_published(read_record_lines(spark, str(tree)))
    assert 2 not in ids(kept) and 1 in ids(kept)


def test_rejects_are_counted(spark, snapshot):
    with utc(spark):
        parsed = parse_packed(taken(snapshot), schemas.RECORD_HEADER)
        row = bronze.reject_summary(parsed).first()
    # no record: two array elements, empty, truncated, bad bytes, junk, null id
    assert row.asDict() == {"rows_read": 27, "without_id": 7, "without_date": 2, "other_year": 1, "kept": 17}


def test_silver_rows(spark, snapshot):
    with utc(spark):
        kept = bronze.published_records(snapshot)
        rows = {r.cve_id[-4:]: r for r in silver.advisories(kept).collect()}
        products = silver.affected_products(kept).collect()
    assert rows["0003"].description is None and rows["0003"].cvss_score is None
    assert rows["0004"].title is None
    assert (rows["0010"].cvss_score, rows["0010"].cvss_severity) == (None, "HIGH")
    assert (rows["0015"].cvss_score, rows["0015"].cvss_severity) == (8.0, "LOW")
    assert (rows["0016"].cvss_score, rows["0016"].cvss_severity) == (None, None)
    assert (rows["0017"].cvss_score, rows["0017"].cvss_severity) == (6.1, "MEDIUM")
    of = lambda n: [(p.vendor, p.product) for p in products if p.cve_id.endswith(n)]
    assert of("0001") == [("acme", "anvil"), ("n/a", "n/a")]
    assert of("0003") == [(None, None)] and of("0004") == [(None, None)]


def test_snapshot_read_back(spark, snapshot, tree):
    path = snapshot.inputFiles()[0].rpartition("/")[0]
    # every file, also the empty one, .DS_Store and _x.json
    assert read_snapshot(spark, path).count() == len(FILES) + 1


ODD = {
    "bom.json": b"\xef\xbb\xbf" + json.dumps(record(30)).encode(),
    "little.json": b"\xff\xfe" + json.dumps(record(31, title="\u00e9\U0001f600")).encode("utf-16-le"),
    "big.json": b"\xfe\xff" + json.dumps(record(32)).encode("utf-16-be"),
    "lines.jsonl": "\n".join(json.dumps(record(n, title="a } { \"b")) for n in (33, 34, 35)).encode(),
    "pretty.jsonl": "\n\n".join(json.dumps(record(n), indent=2) for n in (36, 37)).encode(),
    "_under/_x.json": json.dumps(record(38)).encode(),
    "broken.json": b"\xff\xfe\x00\xd8{",
}


def test_no_file_is_lost_on_either_path(spark, tmp_path):
    for name, body in ODD.items():
        path = tmp_path / "tree" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(body)
    root = str(tmp_path / "tree")
    snapshot = packing.pack_tree(spark, root, str(tmp_path / "packed"))
    want = list(range(30, 39))
    assert ids(bronze.keep_published(read_record_files(spark, root))) == want
    assert ids(bronze.published_records(snapshot)) == want
    titles = {r.title for r in bronze.published_records(snapshot).select("containers.cna.title").collect()}
    assert {"\u00e9\U0001f600", 'a } { "b'} <= titles
    counted = bronze.files_summary(snapshot, suffix=".json").first().asDict()
    assert counted == {"files_taken": 5, "files_left_out": 2, "files_without_record": 1, "files_with_several": 0}
    assert bronze.files_summary(snapshot).first().files_with_several == 2


def test_functions_mean_utc_in_any_zone(spark, snapshot):
    with settings(spark, {"spark.sql.session.timeZone": "America/New_York"}):
        assert ids(bronze.published_records(snapshot)) == KEPT
        assert ids(bronze.published_records(snapshot, 2023)) == [5]
        moments = spark.createDataFrame(
            [("2024-03-01T01:00:00Z",), ("2024-03-01",), ("2024-03-31T23:30:00",), ("2024-04-01T00:30:00+02:00",)], "t STRING"
        )
        months = gold.monthly_trend(moments.select(instant(F.col("t")).alias("date_published"))).collect()
        assert [(str(r.publication_month), r["count"]) for r in months] == [("2024-03-01", 4)]
