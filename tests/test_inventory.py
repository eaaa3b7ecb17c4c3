import os
import time
from pathlib import Path

import pytest

from advisory_lake import session
from advisory_lake.functions import paths
from advisory_lake.operators import inventory, partitioning
from advisory_lake.session import remove_run_folders, run_folder
from advisory_lake.sources.stores import PAGE_NAMES, folder_lister
from advisory_lake.sources.tree import list_files, list_files_if_present
from advisory_lake.streaming.arrival import count_arrivals, count_until_now, keep_polling, ledger_of, watch_arrivals
from advisory_lake.streaming.ledger import ARRIVALS, Ledger, Poll


def write(root, *names):
    for name in names:
        path = Path(root, name)
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(name)


def test_files_per_year_counts_files_not_lines(spark, folder):
    write(folder, "cves/2023/a/x.json", "cves/2024/a/x.json", "cves/2024/b/y.json", "cves/2024/notes.md", "top.json")
    Path(folder, "cves/2024/a/x.json").write_text("one.json\ntwo.json\n")
    per_year = inventory.files_per_year(list_files(spark, folder))
    rows = [tuple(r) for r in per_year.collect()]
    assert rows == [(None, 1), ("2023", 1), ("2024", 2)]
    assert inventory.files_total(per_year).first().total_files == 4


def test_one_flat_folder_of_many_names_is_listed_in_pages(spark, folder):
    flat = Path(folder, "flat")
    flat.mkdir()
    for i in range(200_000):
        os.mknod(flat / f"f{i}.json")
    (flat / "f7.json").write_text("seven")
    (flat / "nowhere").symlink_to(flat / "absent")
    listed = list_files(spark, folder)
    assert listed.agg({"length": "sum"}).first()[0] == 5
    assert listed.select("relative_path").distinct().count() == 200_000

    import pyarrow as pa

    pages = list(folder_lister(folder)([pa.RecordBatch.from_pydict({"relative_path": ["flat", "absent", ""]})]))
    assert sum(page.num_rows for page in pages) == 200_001
    assert max(page.num_rows for page in pages) == PAGE_NAMES


def test_total_of_an_empty_tree_is_zero(spark, folder):
    per_year = inventory.files_per_year(list_files(spark, folder))
    assert inventory.files_total(per_year).first().total_files == 0


@pytest.mark.parametrize(
    "expected, percent, complete", [(4, 50.0, False), (2, 100.0, True), (3, 66.67, False), (0, 0.0, True)]
)
def test_progress(spark, folder, expected, percent, complete):
    write(folder, "a/1.json", "b/c/2.txt")
    row = inventory.arrival_progress(spark, folder, expected).first()
    assert (row.found, row.expected, row.percent, row.complete) == (2, expected, percent, complete)
    assert len(row.checked_at) == len("2024-01-01 00:00:00")


def test_progress_before_the_folder_exists(spark, folder):
    row = inventory.arrival_progress(spark, f"{folder}/later").first()
    assert (row.found, row.expected, row.percent, row.complete) == (0, 317623, 0.0, False)
    assert list_files_if_present(spark, f"{folder}/later").count() == 0


def test_stream_counts_in_several_batches_and_resumes(spark, folder):
    root, checkpoint = f"{folder}/tree", f"{folder}/progress"
    write(root, *(f"d{i}/f{i}.json" for i in range(5)))
    ledger = ledger_of(spark, root, checkpoint)
    assert ledger.poll() == Poll(5, 5, 6)
    write(root, "d5/f5.json")
    assert ledger.poll().new == 1
    query = count_arrivals(spark, ledger, "arrived", checkpoint, 8, files_per_trigger=1)
    query.awaitTermination()
    row = spark.table("arrived").first()
    assert (row.found, row.expected, row.percent, row.complete) == (6, 8, 75.0, False)
    assert len([p for p in query.recentProgress if p.numInputRows]) >= 2
    write(root, "late/1.json", "late/2.json", ".hidden.part")
    row = count_until_now(spark, root, "arrived_again", checkpoint, 8).first()
    assert (row.found, row.percent, row.complete) == (9, 112.5, True)


def test_stream_and_listing_agree_on_every_name(spark, folder):
    root = f"{folder}/tree"
    write(root, "a/1.json", "a/_b/2.json", "_c/.d/3", ".e", "_f", "blank name/x y.json")
    Path(root, "a/empty.json").touch()
    Path(root, "no/files/here").mkdir(parents=True)
    assert count_until_now(spark, root, "every_name", f"{folder}/c", 7).first().found == 7
    listed = {r.relative_path for r in list_files(spark, root).collect()}
    arrived = spark.read.parquet(ledger_of(spark, root, f"{folder}/c").arrivals)
    assert {r.relative_path for r in arrived.collect()} == listed and len(listed) == 7


def settle(root):
    """Let every folder look as if it had not changed for a while."""
    for path in [Path(root), *Path(root).rglob("*")]:
        if path.is_dir():
            os.utime(path, (1_700_000_000, 1_700_000_000))


def test_polls_open_changed_folders_only(spark, folder):
    root = f"{folder}/tree"
    write(root, *(f"y{i}/{k}/f.json" for i in range(3) for k in range(4)))
    settle(root)
    ledger = Ledger(spark, root, f"{folder}/ledger")
    assert ledger.poll() == Poll(12, 12, 16)
    # the root has been asked for its time for the first time; nothing else is opened
    assert ledger.poll().opened <= 1
    assert ledger.poll() == Poll(12, 0, 0)
    write(root, "y1/2/g.json", "y1/new/deep/h.json")
    assert ledger.poll() == Poll(14, 2, 4)  # y1, y1/2, y1/new, y1/new/deep
    settle(root)
    ledger.poll()
    Path(root, "y0/0/f.json").unlink()
    for name in ("y2/3/f.json", "y2/3"):
        path = Path(root, name)
        path.unlink() if path.is_file() else path.rmdir()
    found = ledger.poll()
    assert (found.found, found.new) == (12, 0)
    arrived = spark.read.parquet(ledger.arrivals)
    assert arrived.count() == arrived.select("relative_path").distinct().count() == 14
    assert len(ledger._polls()) == 1
    ledger.close()
    assert not Path(folder, "ledger").exists()


def test_a_poll_that_failed_is_repeated(spark, folder):
    root = f"{folder}/tree"
    write(root, "a/1", "a/2")
    ledger = Ledger(spark, root, f"{folder}/ledger")
    assert Ledger(spark, f"{folder}/later", f"{folder}/other").poll() == Poll(0, 0, 0)
    ledger.poll()
    write(root, "a/3")
    # what a poll leaves that dies after its arrivals were written
    spark.createDataFrame([("a", "a/3", 3, None)], ARRIVALS).write.parquet(f"{ledger.arrivals}/poll=1")
    spark.range(3).write.parquet(f"{ledger.folder}/polls/1/seen")
    assert (ledger.poll().new, ledger.poll().new) == (1, 0)
    assert spark.read.parquet(ledger.arrivals).count() == 3


def test_polling_goes_on_until_stopped(spark, folder):
    root = f"{folder}/tree"
    write(root, "a/1")
    ledger = Ledger(spark, root, f"{folder}/ledger")
    query = keep_polling(spark, ledger, "1 second", f"{folder}/ticks")
    try:
        deadline = time.time() + 60
        while time.time() < deadline and ledger._last() is None:
            time.sleep(0.5)
        write(root, "b/2")
        while time.time() < deadline and (not ledger._last() or ledger._found(ledger._last()) < 2):
            time.sleep(0.5)
    finally:
        query.stop()
    assert ledger._found(ledger._last()) == 2


def test_path_functions(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("a\\b/c.json",), ("c.json",)], "p STRING")
    clean = paths.clean_path(F.col("p"))
    rows = df.select(
        clean, paths.parent_dir(clean), paths.join_path("/r/", clean), paths.path_segment(clean, 1)
    ).collect()
    assert [tuple(r) for r in rows] == [
        ("a/b/c.json", "a/b", "/r/a/b/c.json", "b"),
        ("c.json", "", "/r/c.json", None),
    ]


@pytest.mark.parametrize(
    "root, path",
    [
        ("/data/x", "file:/data/x/a/b.json"),
        ("file:///data/x/", "file:/data/x/a/b.json"),
        ("hdfs://host:8020/data/x", "hdfs://host:8020/data/x/a/b.json"),
        ("s3a://bucket/data", "s3a://bucket/data/a/b.json"),
        ("s3a://bucket", "s3a://bucket/a/b.json"),
    ],
)
def test_relative_paths_of_listed_files(spark, root, path):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(path,)], "p STRING")
    assert df.select(paths.relative_to(F.col("p"), root)).first()[0] == "a/b.json"


def test_partition_plan(spark):
    row = partitioning.partition_plan(spark.range(10_000), 40).first()
    assert tuple(row) == (40, 10_000)


def test_merging_never_adds_partitions(spark):
    df = spark.range(0, 100, 1, 3)
    assert partitioning.merge_partitions(df, 16).rdd.getNumPartitions() == 3
    assert partitioning.spread_partitions(df, 16).rdd.getNumPartitions() == 16


def test_file_budget_grows_with_the_input():
    assert partitioning.file_budget(0) == 16
    assert partitioning.file_budget(100 << 40) == (100 << 40) // (512 << 20)


def test_watch_ends_when_the_tree_is_complete(spark, folder):
    reports = []
    for report in watch_arrivals(spark, f"{folder}/tree", expected=3, every=0):
        reports.append((report.found, report.percent, report.complete))
        write(f"{folder}/tree", f"a/{len(reports)}.json", *(["_x", "b/.y"] if len(reports) == 2 else []))
    assert reports == [(0, 0.0, False), (1, 33.33, False), (4, 133.33, True)]
    assert len(list(watch_arrivals(spark, f"{folder}/none", expected=3, every=0, most=2))) == 2
    shared = Path(session.shared_folder(spark).removeprefix("file:"), "advisory-lake")
    assert not list(shared.glob("watch-*"))


def test_run_folders_can_be_removed(spark):
    path = Path(run_folder(spark, "gone").removeprefix("file:"))
    write(path, "a/b")
    kept = [name for name in session._run_folders[spark.sparkContext.applicationId]]
    session._run_folders[spark.sparkContext.applicationId] = [str(path)]
    assert remove_run_folders(spark) == 1 and not path.exists()
    session._run_folders[spark.sparkContext.applicationId] = kept
