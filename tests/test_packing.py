import hashlib
import os
from pathlib import Path

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from advisory_lake.operators import packing
from advisory_lake.operators.quality import QualityError
from advisory_lake.sources import stores
from advisory_lake.sources.snapshot import read_snapshot, write_snapshot
from advisory_lake.sources.stores import arrow_uri, publish, with_default
from advisory_lake.sources.tree import list_files, read_files

CONTENT = {
    "cves/2024/a.json": b'{"x": 1}',
    "cves/2024/b c %20 d.json": b"blank and percent",
    "cves/2023/\u00fcml\u00e4ut/\u65e5\u672c.json": "\u65e5\u672c".encode(),
    "cves/2023/raw.bin": bytes(range(256)) * 50,
    "cves/2023/empty.json": b"",
    "README.md": b"top level",
}


@pytest.fixture
def packed(spark, tmp_path):
    rows = [(name.replace("/", "\\") if "2024" in name else name, body) for name, body in CONTENT.items()]
    path = str(tmp_path / "given")
    write_snapshot(spark.createDataFrame(rows, "relative_path STRING, file_content BINARY"), path)
    return path


@pytest.fixture
def root(spark, packed, tmp_path):
    target = str(tmp_path / "tree with blank")
    packing.unpack_snapshot(spark, packed, target, tasks=4).collect()
    return target


def on_disk(root):
    base = Path(root)
    return {str(p.relative_to(base)): p.read_bytes() for p in base.rglob("*") if p.is_file()}


def summary(spark, packed, root):
    compared = packing.compare_content(read_snapshot(spark, packed), read_files(spark, root))
    return tuple(packing.content_totals(compared).first())


def test_unpack_recreates_every_byte(spark, packed, root):
    assert on_disk(root) == CONTENT


def test_unpack_totals_and_overwrite(spark, packed, root):
    Path(root, "cves/2024/a.json").write_bytes(b"stale")
    totals = packing.written_totals(packing.unpack(read_snapshot(spark, packed), root)).first()
    assert tuple(totals) == (len(CONTENT), sum(map(len, CONTENT.values())))
    assert on_disk(root) == CONTENT


def test_unpack_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "relative_path STRING, file_content BINARY")
    totals = packing.written_totals(packing.unpack(empty, str(tmp_path / "none"))).first()
    assert tuple(totals) == (0, 0)


def test_pack_gives_the_tree_back(spark, root, tmp_path):
    again = packing.pack_tree(spark, root, str(tmp_path / "again"))
    assert {r.relative_path: bytes(r.file_content) for r in again.collect()} == CONTENT


def test_pack_is_gzip_with_bounded_rows_per_file(spark, root, tmp_path):
    again = packing.pack_tree(spark, root, str(tmp_path / "again"), rows_per_file=2)
    names = os.listdir(tmp_path / "again")
    assert any(n.endswith(".gz.parquet") for n in names)
    assert max(r[0] for r in again.groupBy("_metadata.file_name").count().select("count").collect()) <= 2


def test_relative_roots(spark, packed, tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    packing.unpack(read_snapshot(spark, packed), "here/tree").collect()
    assert on_disk(tmp_path / "here/tree") == CONTENT


def test_file_uri_roots(spark, packed, tmp_path):
    target = f"file:{tmp_path}/uri"
    packing.unpack(read_snapshot(spark, packed), target).collect()
    assert on_disk(f"{tmp_path}/uri") == CONTENT
    assert summary(spark, packed, target) == (len(CONTENT), 0)


@pytest.mark.parametrize("path", ["/etc/x", "../x", "a/../../x", "a\\..\\..\\x", "C:\\x", "", "a/", "\\x"])
def test_unsafe_paths_fail_the_job(spark, tmp_path, path):
    bad = spark.createDataFrame([(path, b"x")], "relative_path STRING, file_content BINARY")
    with pytest.raises(PySparkException, match="unsafe path"):
        packing.unpack(bad, str(tmp_path / "t")).collect()


def test_dotted_names_are_safe(spark, tmp_path):
    rows = spark.createDataFrame([("a..b/..c.json", b"x")], "relative_path STRING, file_content BINARY")
    packing.unpack(rows, str(tmp_path / "t")).collect()
    assert on_disk(tmp_path / "t") == {"a..b/..c.json": b"x"}


def beside(root):
    return [p.name for p in Path(root).parent.iterdir() if p.name.endswith(".staged")]


def test_restore_appears_as_a_whole(spark, packed, tmp_path):
    target = tmp_path / "some where" / "tree"
    target.parent.mkdir()
    totals = packing.restore_snapshot(spark, packed, str(target), tasks=4)
    assert tuple(totals.first()) == (len(CONTENT), sum(map(len, CONTENT.values())))
    assert on_disk(target) == CONTENT and not beside(target)


def test_restore_over_a_tree_replaces_its_files_and_keeps_others(spark, packed, root):
    Path(root, "cves/2024/a.json").write_bytes(b"stale")
    Path(root, "own.txt").write_bytes(b"kept")
    packing.restore_snapshot(spark, packed, root, tasks=None)
    assert on_disk(root) == CONTENT | {"own.txt": b"kept"} and not beside(root)


def test_restore_over_a_tree_does_not_list_what_it_staged(spark, packed, root, monkeypatch):
    def walked(*_):
        raise AssertionError("the names are those of the snapshot")

    monkeypatch.setattr(stores, "walk", walked)
    for name in CONTENT:
        Path(root, name).write_bytes(b"stale")
    packing.restore_snapshot(spark, packed, root, tasks=2)
    assert on_disk(root) == CONTENT and not beside(root)


def test_replacing_files_that_are_absent_linked_or_in_the_way(tmp_path):
    import pyarrow as pa

    source, target = tmp_path / "s", tmp_path / "t"
    for folder in (source / "d", target / "d"):
        folder.mkdir(parents=True)
    for name in ("new", "old", "linked"):
        (source / "d" / name).write_bytes(name.encode())
    (target / "d" / "old").write_bytes(b"stale")
    (target / "other").write_bytes(b"kept")
    (target / "d" / "linked").symlink_to(target / "other")
    mover = stores._file_mover(str(source), str(target))
    names = pa.RecordBatch.from_pydict({"relative_path": ["d/new", "d/old", "d/linked", "d/old"]})
    assert [b.column(0).to_pylist() for b in mover([names])] == [[4]]
    assert on_disk(target) == {"d/new": b"new", "d/old": b"old", "d/linked": b"linked", "other": b"kept"}
    (source / "d" / "old").write_bytes(b"again")
    (target / "x" / "d" / "old").mkdir(parents=True)
    with pytest.raises(OSError):
        list(stores._file_mover(str(source), str(target / "x"))([names.slice(1, 1)]))
    assert (source / "d" / "old").read_bytes() == b"again"


@pytest.mark.parametrize("fault", ["unsafe path", "lost worker"])
@pytest.mark.parametrize("there", [False, True])
def test_a_failed_restore_leaves_the_target_as_it_was(spark, tmp_path, monkeypatch, fault, there):
    target, given = tmp_path / "t", str(tmp_path / "p")
    if there:
        target.mkdir()
        (target / "f007").write_bytes(b"old")
    rows = [(f"f{i:03}", b"new") for i in range(200)]
    if fault == "unsafe path":
        rows.append(("../x", b"new"))
    else:
        plain = packing.unpack

        def dying(snapshot, root, tasks):
            def lose_one(batches):
                import os

                for batch in batches:
                    yield batch
                    if "f100" in batch.column(0).to_pylist():
                        os._exit(1)  # after its files were handed on

            return plain(snapshot.mapInArrow(lose_one, snapshot.schema), root, tasks)

        monkeypatch.setattr(packing, "unpack", dying)
    write_snapshot(spark.createDataFrame(rows, "relative_path STRING, file_content BINARY"), given)
    with pytest.raises((PySparkException, Py4JJavaError)):
        packing.restore_snapshot(spark, given, str(target), tasks=None)
    assert on_disk(target) == ({"f007": b"old"} if there else {})
    assert target.exists() == there and not beside(target)


def test_a_publication_that_stopped_is_finished(spark, packed, root, tmp_path):
    staged = tmp_path / ".x.staged"
    packing.unpack_snapshot(spark, packed, str(staged), tasks=2).collect()
    (staged / "README.md").rename(Path(root, "README.md"))  # what the first call had moved
    Path(root, "cves/2024/a.json").write_bytes(b"stale")
    publish(spark, str(staged), root)
    assert on_disk(root) == CONTENT and not staged.exists()


def test_restore_of_nothing(spark, tmp_path):
    write_snapshot(spark.createDataFrame([], "relative_path STRING, file_content BINARY"), str(tmp_path / "p"))
    totals = packing.restore_snapshot(spark, str(tmp_path / "p"), str(tmp_path / "t"))
    assert tuple(totals.first()) == (0, 0) and on_disk(tmp_path / "t") == {}


def test_staged_folders_are_beside_the_target():
    assert stores.beside("s3://b/x/").startswith("s3://b/.x-")
    assert stores.beside("file:///x").startswith("file:///.x-")
    assert stores.beside("/a/b c").startswith("/a/.b c-")
    for root in ("s3://b", "hdfs://name:8020", "/"):
        with pytest.raises(ValueError):
            stores.beside(root)


def test_verification_passes(spark, packed, root):
    assert summary(spark, packed, root) == (len(CONTENT), 0)
    assert tuple(packing.row_parity(read_snapshot(spark, packed), list_files(spark, root)).first()) == (6, 6, True)


def test_verification_sees_changed_missing_and_extra_files(spark, packed, root):
    Path(root, "cves/2024/a.json").write_bytes(b'{"x": 2}')
    Path(root, "README.md").unlink()
    Path(root, "cves/extra.json").write_bytes(b"")
    assert summary(spark, packed, root) == (len(CONTENT) + 1, 3)
    Path(root, "cves/extra.json").unlink()
    assert tuple(packing.row_parity(read_snapshot(spark, packed), list_files(spark, root)).first()) == (6, 5, False)


def test_sample_verification(spark, packed, root):
    given = read_snapshot(spark, packed)
    ok = packing.verify_sample(given, root, size=100)
    assert sorted(r.relative_path for r in ok.collect()) == sorted(CONTENT)
    assert all(r.matches for r in ok.collect())
    Path(root, "cves/2024/a.json").write_bytes(b"changed")
    Path(root, "README.md").unlink()
    wrong = packing.verify_sample(given, root, size=100).filter("NOT matches").collect()
    assert sorted(r.relative_path for r in wrong) == ["README.md", "cves/2024/a.json"]


def test_a_folder_in_place_of_a_file_does_not_match(spark, packed, root):
    Path(root, "README.md").unlink()
    Path(root, "README.md").mkdir()
    wrong = packing.verify_sample(read_snapshot(spark, packed), root, size=100).filter("NOT matches").collect()
    assert [r.relative_path for r in wrong] == ["README.md"]


def test_sample_of_an_empty_tree(spark, packed, tmp_path):
    (tmp_path / "bare").mkdir()
    rows = packing.verify_sample(read_snapshot(spark, packed), str(tmp_path / "bare"), size=4).collect()
    assert len(rows) == 4 and not any(r.matches for r in rows)


def test_sample_reads_compressed_names_as_they_are(spark, tmp_path):
    import gzip

    rows = spark.createDataFrame([("a/x.gz", gzip.compress(b"x"))], "relative_path STRING, file_content BINARY")
    packing.unpack(rows, str(tmp_path / "t")).collect()
    assert packing.verify_sample(rows, str(tmp_path / "t")).first().matches


def test_sample_is_repeatable_and_follows_the_seed(spark, packed):
    def take(seed):
        return [r[0] for r in packing.sample_paths(read_snapshot(spark, packed), 3, seed).collect()]

    assert take("a") == take("a")
    names = [n.replace("/", "\\") if "2024" in n else n for n in CONTENT]
    assert take("a") == sorted(names, key=lambda n: hashlib.md5(f"a{n}".encode()).hexdigest())[:3]


def test_a_file_that_vanishes_is_left_out(spark, root):
    files = read_files(spark, root)
    Path(root, "README.md").unlink()
    assert sorted(r.relative_path for r in files.collect()) == sorted(set(CONTENT) - {"README.md"})


def test_other_errors_of_a_store_fail(spark, root):
    listed = spark.createDataFrame([("README.md",), ("cves",)], "relative_path STRING")  # a folder is no file
    with pytest.raises(PySparkException):
        read_files(spark, root, listing=listed).collect()


def test_leftovers_of_lost_tasks_are_not_listed(spark, root):
    Path(root, "cves/.0123456789abcdef.part").write_bytes(b"half")
    assert list_files(spark, root).count() == len(CONTENT)


def test_shuffle_only_when_asked(spark, packed, tmp_path):
    dealt = packing.unpack_snapshot(spark, packed, str(tmp_path / "x"), tasks=3)
    plain = packing.unpack_snapshot(spark, packed, str(tmp_path / "x"), tasks=None)
    from harness import plan_of

    assert "hashpartitioning(relative_path" in plan_of(dealt)
    assert "Exchange" not in plan_of(plain)


def test_every_name_is_packed(spark, tmp_path):
    names = ["_under.json", "_dir/x.json", ".dot/y", "a/_b/.c", "flat/1", "flat/2"]
    for name in names:
        path = tmp_path / "tree" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"" if name.startswith("flat") else name.encode())
    root = str(tmp_path / "tree")
    packed = packing.pack_tree(spark, root, str(tmp_path / "packed"))
    assert {r.relative_path: bytes(r.file_content) for r in packed.collect()} == on_disk(root)
    assert sorted(r.relative_path for r in list_files(spark, root).collect()) == sorted(names)
    assert sorted(r.relative_path for r in list_files(spark, root, dot_names=False).collect()) == [
        "_dir/x.json", "_under.json", "flat/1", "flat/2"
    ]
    with pytest.raises(FileNotFoundError):
        list_files(spark, f"{root}/absent")


def test_pack_and_verify(spark, root, tmp_path):
    report = packing.pack_and_verify(spark, root, str(tmp_path / "checked"))
    assert all(r.passed for r in report.collect()) and report.count() == 2
    if os.geteuid():  # nothing is unreadable for root
        Path(root, "README.md").chmod(0)
        with pytest.raises(QualityError):
            packing.pack_and_verify(spark, root, str(tmp_path / "again"))


def test_colliding_paths_are_refused(spark, tmp_path):
    rows = spark.createDataFrame([("a\\b", b"1"), ("a/b", b"2"), ("c", b"3")], "relative_path STRING, file_content BINARY")
    write_snapshot(rows, str(tmp_path / "p"))
    with pytest.raises(ValueError, match="a/b"):
        packing.unpack_snapshot(spark, str(tmp_path / "p"), str(tmp_path / "t"))


def test_one_meaning_of_a_path():
    assert with_default("/data/x", "hdfs://name:8020") == "hdfs://name:8020/data/x"
    assert with_default("/data/x", "file:///") == "file:///data/x"
    assert with_default("s3a://b/x", "hdfs://name:8020") == "s3a://b/x"
    assert arrow_uri("s3a://b/x/") == "s3://b/x"
    assert arrow_uri("file:///data/x") == arrow_uri("file:/data/x") == "/data/x"
    assert arrow_uri("hdfs://name:8020/data") == "hdfs://name:8020/data"
    with pytest.raises(ValueError):
        arrow_uri("dbfs:/data")


def test_content_is_read_for_named_files_only(spark, packed, root):
    from harness import plan_of

    names = plan_of(packing.sample_paths(read_snapshot(spark, packed), 3))
    assert "file_content" not in names
    assert "In(relative_path" in plan_of(packing.verify_sample(read_snapshot(spark, packed), root, 3))


def test_a_tree_is_passed_through_in_waves(spark, tmp_path):
    """Every file is read once, and the disk holds the files of one wave at a time."""
    rows = [(f"{n % 7}\\{n % 3}/{n}.json", str(n).encode()) for n in range(400)] + [("top.json", b"top")]
    path, folder = str(tmp_path / "given"), tmp_path / "waves"
    write_snapshot(spark.createDataFrame(rows, "relative_path STRING, file_content BINARY").coalesce(1), path, rows_per_file=10)
    seen = []

    def read(root):
        seen.append(sum(len(names) for top, _, names in os.walk(folder) if "kept" not in top))
        return read_files(spark, root)

    found = packing.through_tree(spark, path, str(folder), read, wave_files=100)
    want = sorted((name.replace("\\", "/"), body) for name, body in rows)
    assert sorted((r.relative_path, bytes(r.file_content)) for r in found.collect()) == want
    assert len(seen) == 5 and sum(seen) == 401 and max(seen) < 250
    assert len([name for name in os.listdir(folder) if name.startswith("wave-")]) == 1
    few = packing.through_tree(spark, path, str(tmp_path / "one"), lambda root: read_files(spark, root))
    assert few.count() == 401 and not (tmp_path / "one" / "kept").exists()


def test_waves_refuse_colliding_paths_of_any_two(spark, tmp_path):
    rows = [(f"{n}/a", b"") for n in range(60)] + [("59\\a", b"")]
    path = str(tmp_path / "given")
    write_snapshot(spark.createDataFrame(rows, "relative_path STRING, file_content BINARY"), path, rows_per_file=10)
    with pytest.raises(ValueError, match="2 packed names"):
        packing.through_tree(spark, path, str(tmp_path / "t"), lambda root: read_files(spark, root), wave_files=10)


def test_files_of_a_wave_are_written_over_by_the_next(spark, tmp_path):
    """A file that was deleted has no name any more, which one that is held open tells."""
    rows = [(f"{n % 7}/{n}.json", str(n).encode() * (n * 31 % 5)) for n in range(300)]
    path, folder = str(tmp_path / "given"), tmp_path / "waves"
    write_snapshot(spark.createDataFrame(rows, "relative_path STRING, file_content BINARY").coalesce(1), path, rows_per_file=10)
    held, over = [], []

    def read(root):
        over.append(sum(os.fstat(file.fileno()).st_nlink for file in held))
        for file in held:
            file.close()
        held[:] = [open(os.path.join(top, name), "rb") for top, _, names in os.walk(root) for name in names]
        return read_files(spark, root)

    found = packing.through_tree(spark, path, str(folder), read, wave_files=100)
    assert sorted((r.relative_path, bytes(r.file_content)) for r in found.collect()) == sorted(rows)
    assert len(over) == 3 and all(over[1:])
    assert not os.listdir(folder / "spare")
    for file in held:
        file.close()


def test_folders_of_files_alone_are_kept_to_be_written_over(spark, tmp_path):
    part = f".{'0' * 32}.part"
    for name in ("a/b/1", "a/2", "c/3", "c/4", f"c/{part}", "5"):
        Path(tmp_path, "tree", name).parent.mkdir(parents=True, exist_ok=True)
        Path(tmp_path, "tree", name).write_bytes(b"old")
    spare = stores.spare_folder(str(tmp_path / "spare"))
    folders = spark.createDataFrame([("",), ("c",), ("a",), ("gone",)], "folder STRING")
    stores.delete_folders(spark, str(tmp_path / "tree"), folders, spare)
    assert not (tmp_path / "tree").exists()
    (kept,) = os.listdir(spare)
    names = os.listdir(f"{spare}/{kept}")
    assert len(names) == 2 and part not in names and all(name.endswith(".part") for name in names)
    rows = spark.createDataFrame([("n/x", b""), ("n/y", b"longer"), ("n/z", b"z")], "relative_path STRING, file_content BINARY")
    packing.unpack(rows.coalesce(1), str(tmp_path / "new"), spare=spare).collect()
    assert on_disk(tmp_path / "new") == {"n/x": b"", "n/y": b"longer", "n/z": b"z"}
    assert not os.listdir(spare)
    packing.unpack(rows.limit(0), str(tmp_path / "none"), spare=spare).collect()
    Path(spare, "0", "1").mkdir(parents=True)
    stores.delete_spare(spark, spare)
    assert not os.listdir(spare)
