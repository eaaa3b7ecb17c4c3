"""Cutting files into documents: nothing good is lost beside something bad."""

import json
import os
import random

import pytest
from harness import plan_of
from pyspark.sql import functions as F

from advisory_lake.operators import bronze, packing
from advisory_lake.plans import medallion
from advisory_lake.plans.feeds import feeds
from advisory_lake.sources import documents, records
from advisory_lake.sources.documents import Cutter, pieces_of
from advisory_lake.sources.stores import walk

G = '{"good": 1}'


@pytest.mark.parametrize(
    "text, good, bad",
    [
        (G, [0], []),
        ("  \n", [], []),
        (f"{G}\nbad line\n{G}", [0, 21], ["bad line"]),
        (f"{G}{G} {G}", [0, 11, 23], []),
        (f"{G},{G},\n{G}", [0, 12, 25], []),
        (f'[{G}, 17, "x, {{y", null, {{"b": [{{"c": 1}}]}}]', [1, 33], ["17", '"x, {y"', "null"]),
        (f'{{"cut": [\n{G}\n{G}', [10, 22], ['{"cut": [']),
        (f'{{"a": "open\n{G}', [12], ['{"a": "open']),
        ('{"x": "} { \\" }\\n{"}', [0], []),
        (f"[\n  {G},\n  {{bad}},\n  {G}\n]", [4, 28], ["{bad},"]),
        (f"[{G},{{bad}},{G}]", [1, 19], ["{bad},"]),
        (f'{{\n  "a": {{\n    "b": 1\n  }},\n  oops\n}}\n{G}', [36], ['{\n  "a": {\n    "b": 1\n  },\n  oops\n}']),
        (f"[{G}\n{G}", [1, 13], []),
        (f"é{G}", [2], ["é"]),
        ("[" * 5000, [], ["["] * 4999),
        ('{"a":' * 5000, [], ['{"a":' * 5000]),
    ],
)
def test_pieces(text, good, bad):
    found = pieces_of(text)
    assert [place for place, _, whole in found if whole] == good
    assert [piece for _, piece, whole in found if not whole] == bad
    for place, piece, _ in found:
        assert text.encode()[place:].startswith(piece.encode())


def _some_text(rng, documents_wanted):
    parts, wanted = [], []
    for n in range(documents_wanted):
        value = {"n": n, "s": rng.choice(["", "} {", '"', "\\", "}\n{", "é\U0001f600", "x" * 300]), "l": [{"a": 1}, {"a": [2]}]}
        wanted.append(value)
        parts.append(json.dumps(value, indent=rng.choice([None, None, 2]), ensure_ascii=rng.random() < 0.5))
        parts.append(rng.choice(["\n", "\n\n", " ", "", ",\n", "\r\n", "\nno document\n", "\n  \n", '\n{"cut": [\n', "\n}\n"]))
    return "".join(parts), wanted


def test_no_document_is_lost_however_the_stream_is_chunked():
    rng = random.Random(5)
    for _ in range(60):
        text, wanted = _some_text(rng, rng.randrange(1, 12))
        found = pieces_of(text)
        assert [json.loads(piece) for _, piece, whole in found if whole] == wanted
        cutter, again, at = Cutter(), [], 0
        while at < len(text):
            step = rng.randrange(1, 40)
            again += cutter.feed(text[at : at + step], at + step >= len(text))
            at += step
        assert again == found


def test_ranges_of_a_file_give_each_piece_once(spark, tmp_path):
    rng = random.Random(6)
    wanted = {}
    for name, encoding in (("a.txt", "utf-8"), ("b/c.json", "utf-8-sig"), ("w.json", "utf-16"), ("_e.json", "utf-8")):
        text, values = _some_text(rng, 0 if name == "_e.json" else 80)
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(text.encode(encoding))
        wanted[name] = sorted(v["n"] for v in values)
    want = None
    for range_bytes in (1 << 30, 5000, 700, 64):
        cut = documents.cut_tree(spark, str(tmp_path), range_bytes=range_bytes)
        rows = sorted((tuple(r) for r in cut.where("place is not null").collect()), key=str)
        for name, values in wanted.items():
            assert sorted(json.loads(t)["n"] for n, _, t, fault in rows if n == name and fault is None) == values
        opened = [r.relative_path for r in cut.where(F.col("fault") == documents.OPENED).collect()]
        assert sorted(opened) == sorted(wanted)
        want = want or rows
        assert rows == want


def test_files_that_cannot_be_read_are_rows_and_counts(spark, tmp_path):
    root = tmp_path / "tree"
    root.mkdir()
    text = json.dumps({"cveMetadata": {"cveId": "CVE-1", "datePublished": "2024-05-01"}})
    for n in range(5):
        (root / f"{n}.json").write_text(f"{text}\nbad {n}\n")
    (root / "empty.json").write_text("")
    listing = walk(spark, str(root))
    os.remove(root / "3.json")
    found = records.tree_documents(spark, str(root), listing=listing)
    assert found.agg(*records.read_counts()).first().asDict() == {"files_read": 5, "files_lost": 1, "documents": 4, "rejected": 4}
    rejects = sorted((tuple(r) for r in records.rejected(found).collect()), key=str)
    place = len(text) + 1
    assert rejects == [(f"{n}.json", place, "no document", f"bad {n}") for n in (0, 1, 2)] + [
        ("3.json", None, "unreadable", None), ("4.json", place, "no document", "bad 4")
    ]


def test_ingest_of_a_tree_counts_on_the_way(spark, tmp_path):
    root = tmp_path / "tree"
    root.mkdir()
    good = [json.dumps({"cveMetadata": {"cveId": f"CVE-{n}", "datePublished": "2024-05-01"}}) for n in range(3)]
    (root / "a.json").write_text(f"{good[0]}{good[1]}\n{{broken\n{good[2]}")
    (root / "b.txt").write_text("left out")
    tag = tmp_path.name.replace("-", "_")
    lake = medallion.Lake(spark, str(tmp_path / "lake"), f"b_{tag}", f"s_{tag}")
    kept = lake.ingest_tree(str(root), suffix=".json")
    assert sorted(r[0] for r in kept.select("cveMetadata.cveId").collect()) == ["CVE-0", "CVE-1", "CVE-2"]
    counts = spark.table(lake.ingest_counts).first().asDict()
    assert counts == {"files_listed": 1, "files_read": 1, "files_lost": 0, "documents": 3, "rejected": 1}


def test_tree_and_snapshot_are_cut_alike(spark, tmp_path):
    rng = random.Random(7)
    root = tmp_path / "tree"
    root.mkdir()
    for n in range(30):
        (root / f"{n}.json").write_text(_some_text(rng, rng.randrange(4))[0])
    packed = packing.pack_tree(spark, str(root), str(tmp_path / "packed"))

    def rows(df):
        shown = df.where("place is not null or fault is null").select("relative_path", "place", "text", "fault")
        return sorted((tuple(r) for r in shown.collect()), key=str)

    from_snapshot, from_tree = rows(records.packed_documents(packed)), rows(records.tree_documents(spark, str(root)))
    # a text that is one document is handed on with the blanks around it
    assert [(n, p and 0, t and t.strip(), f) for n, p, t, f in from_snapshot] == [(n, p and 0, t, f) for n, p, t, f in from_tree]
    assert sorted(map(tuple, records.rejected(records.packed_documents(packed)).collect())) == sorted(
        map(tuple, records.rejected(records.tree_documents(spark, str(root))).collect())
    )


def test_texts_of_one_record_stay_in_the_jvm(spark):
    """The Python side of the plan gets null for every text that is one record."""
    packed = spark.read.parquet(feeds(spark, "/root/testdata/sf0.001").record_snapshot)
    cut = records.cut_files(packed)
    assert cut.where("pieces is not null").count() == 0 and cut.count() > 0
    text = plan_of(bronze.published_records(packed, 1998))
    assert text.count("ArrowEvalPython") <= 2 and "Exchange" not in text


def test_the_odd_feed_is_written_first_and_parsed_once(spark):
    from advisory_lake.plans import registry

    text = plan_of(registry.all_queries()["bronze_ingest_encodings"](spark, "/root/testdata/sf0.001"))
    assert "to_json" not in text and text.count("make_valid_utf8") <= 2
