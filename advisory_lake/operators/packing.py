"""Pack a file tree into a snapshot, recreate it, and prove the two equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from advisory_lake.functions.paths import checked_relative, clean_path, join_path, parent_dir
from advisory_lake.operators.quality import Check, enforce, run_checks
from advisory_lake.session import delete_folder, few_tasks, shuffles_deleted
from advisory_lake.sources.snapshot import ROWS_PER_FILE, read_snapshot, write_snapshot
from advisory_lake.sources.stores import add_file_digests, arrow_uri, beside, delete_folders, delete_spare, publish, qualified, spare_folder, walk
from advisory_lake.sources.tree import read_files

PARALLEL_TASKS = 200
SAMPLE_SIZE = 100
WAVE_FILES = 500_000  # files of a tree that is only passed through

WRITTEN_DDL = "files_written LONG, bytes_written LONG"


def pack_tree(spark: SparkSession, root: str, snapshot_path: str, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Write every file below ``root`` into a snapshot and read it back. A task packs up
    to ``rows_per_file`` files; names alone move, and there is no swarm of small outputs."""
    write_snapshot(read_files(spark, root, rows_per_file), snapshot_path, rows_per_file)
    return read_snapshot(spark, snapshot_path)


def pack_and_verify(
    spark: SparkSession, root: str, snapshot_path: str, rows_per_file: int = ROWS_PER_FILE, sample: int = SAMPLE_SIZE
) -> DataFrame:
    """Pack a tree, hold the snapshot against the listing it was made from and a sample of its
    files against the tree. Gives the checks, or raises when one fails."""
    listing = walk(spark, root)
    write_snapshot(read_files(spark, root, rows_per_file, listing), snapshot_path, rows_per_file)
    packed = read_snapshot(spark, snapshot_path)
    counted = run_checks(row_parity(packed, listing), Check("packed_rows", F.sum("packed_rows"), F.sum("tree_files")))
    mismatched = F.coalesce(F.count_if(~F.col("matches")), F.lit(0))
    sampled = run_checks(verify_sample(packed, root, sample), Check("sample_mismatches", mismatched, F.lit(0)))
    report = counted.unionByName(sampled)
    enforce(report)
    return report


def target_paths(snapshot: DataFrame, root: str) -> DataFrame:
    """Where each packed file belongs: its clean path, full path and parent folder."""
    clean = clean_path(F.col("relative_path"))
    return snapshot.select(
        "relative_path",
        clean.alias("clean_path"),
        join_path(root, clean).alias("full_path"),
        parent_dir(clean).alias("parent_dir"),
    )


def unpack(snapshot: DataFrame, root: str, tasks: int | None = None, spare: str | None = None) -> DataFrame:
    """Recreate the tree below ``root``; one row of totals per Arrow batch.

    Lazy: the files appear when the result is consumed. ``root`` must be a folder every
    executor sees. A retried or speculative task is harmless: each file is written under
    a private hidden name and then moved into place. ``tasks`` adds a shuffle by path to
    that many tasks; leave it out when the snapshot's own splits are enough. ``spare`` holds old
    folders (``stores.spare_folder``): a task moves one to the place of a folder that it would make,
    writes over its files, and gives back those it has no use for.
    """
    rows = snapshot.select(
        checked_relative(clean_path(F.col("relative_path"))).alias("relative_path"), "file_content"
    )
    if tasks:
        rows = rows.repartition(tasks, "relative_path")
    return rows.mapInArrow(_file_writer(arrow_uri(root), arrow_uri(spare) if spare else None), WRITTEN_DDL)


def unpack_snapshot(
    spark: SparkSession, snapshot_path: str, root: str, tasks: int | None = PARALLEL_TASKS
) -> DataFrame:
    """Unpack a stored snapshot on so many tasks, which moves the contents through a shuffle; or
    with ``tasks=None`` on the snapshot's own splits, which does not."""
    packed = read_snapshot(spark, snapshot_path)
    refuse_colliding_paths(packed)
    return unpack(packed, root, tasks)


def through_tree(
    spark: SparkSession,
    snapshot_path: str,
    folder: str,
    read: Callable[[str], DataFrame],
    wave_files: int = WAVE_FILES,
    tasks: int | None = None,
) -> DataFrame:
    """What ``read(root)`` finds in the tree of a stored snapshot, by files, each for itself.

    The tree is recreated below ``folder`` in waves of about ``wave_files`` files, each below a
    root of its own. What a wave gives is stored before its files go, so that the disk holds one
    wave however many files there are. The last tree stays and is read as the result is consumed.
    A wave takes whole files of the snapshot, those with neighbouring paths, and opens no others.
    On a local or mounted store the files of a wave are written over by the next one, since making
    and deleting them costs more there than all the rest.
    """
    packed = read_snapshot(spark, snapshot_path)
    refuse_colliding_paths(packed)
    clean = clean_path(F.col("relative_path"))
    kept, spare, schema, last = f"{folder}/kept", spare_folder(f"{folder}/spare"), None, None
    for number, names in enumerate(_waves(packed, wave_files)):
        wave, root = packed.where(F.col("_metadata.file_name").isin(names)), f"{folder}/wave-{number}"
        if last:
            found, *tree = last
            found.write.mode("append").parquet(kept)
            delete_folders(spark, *tree, spare)
            schema = found.schema
        if last and spare:
            # a folder's files in one task, or in a few
            near = wave if tasks else wave.repartitionByRange(few_tasks(spark), clean).sortWithinPartitions(clean)
            with shuffles_deleted(spark):
                written_totals(unpack(near, root, tasks, spare)).collect()
            delete_spare(spark, spare)
        else:
            written_totals(unpack(wave, root, tasks)).collect()
        last = read(root), root, wave.select(parent_dir(clean).alias("folder")).distinct()
    if last is None:
        return read(f"{folder}/wave-0")
    return spark.read.schema(schema).parquet(kept).unionByName(last[0]) if schema else last[0]


def _waves(packed: DataFrame, wave_files: int) -> list[list[str]]:
    """Names of the snapshot's files by waves of about as many rows each, in the order of their
    first paths: files that were sorted hold neighbours, so that few folders are in several waves."""
    first = F.min(clean_path(F.col("relative_path")))
    files = packed.groupBy(F.col("_metadata.file_name").alias("name")).agg(F.count(F.lit(1)).alias("rows"), first.alias("first"))
    found = files.orderBy("first", "name").collect()
    total, before = sum(file.rows for file in found), 0
    waves = [[] for _ in range(max(1, -(-total // wave_files)))]
    for file in found:
        waves[before * len(waves) // total].append(file.name)
        before += file.rows
    return [names for names in waves if names]


def restore_snapshot(
    spark: SparkSession, snapshot_path: str, root: str, tasks: int | None = PARALLEL_TASKS
) -> DataFrame:
    """Recreate the tree as one step and give its totals; unlike ``unpack`` this runs at once.

    All files are written to a hidden folder beside ``root`` and published when every one is there,
    so a job that fails leaves ``root`` as it was. An absent ``root`` appears by one rename. Into a
    tree that is there, files are moved one by one; should that stop half way, the error names the
    staged folder, and ``stores.publish`` finishes the work.
    """
    target = qualified(spark, root)
    staged = beside(target)
    try:
        totals = written_totals(unpack_snapshot(spark, snapshot_path, staged, tasks)).first()
    except BaseException:
        delete_folder(spark, staged)
        raise
    try:
        named = read_snapshot(spark, snapshot_path).select(clean_path(F.col("relative_path")).alias("relative_path"))
        publish(spark, staged, target, named)
    except Exception as error:
        error.add_note(f"the whole tree is staged in {staged}")
        raise
    return spark.createDataFrame([tuple(totals)], WRITTEN_DDL)


def refuse_colliding_paths(snapshot: DataFrame) -> None:
    """Raise when two packed names have one clean path: one file would overwrite the other."""
    named = snapshot.select(clean_path(F.col("relative_path")).alias("clean_path"), "relative_path")
    several = named.groupBy("clean_path").agg(
        F.count(F.lit(1)).alias("n"), F.min("relative_path").alias("first"), F.max("relative_path").alias("last")
    )
    for row in several.where("n > 1").limit(1).collect():
        raise ValueError(f"{row.n} packed names for {row.clean_path}: {row.first!r} and {row.last!r}")


def written_totals(written: DataFrame) -> DataFrame:
    return written.agg(
        F.coalesce(F.sum("files_written"), F.lit(0)).alias("files_written"),
        F.coalesce(F.sum("bytes_written"), F.lit(0)).alias("bytes_written"),
    )


def row_parity(snapshot: DataFrame, listing: DataFrame) -> DataFrame:
    """Packed rows against files in the tree."""
    packed = snapshot.select(F.lit(1).alias("packed"), F.lit(0).alias("listed"))
    listed = listing.select(F.lit(0).alias("packed"), F.lit(1).alias("listed"))
    counted = packed.unionByName(listed).agg(
        F.coalesce(F.sum("packed"), F.lit(0)).alias("packed_rows"),
        F.coalesce(F.sum("listed"), F.lit(0)).alias("tree_files"),
    )
    return counted.withColumn("passed", F.col("packed_rows") == F.col("tree_files"))


def compare_content(snapshot: DataFrame, files: DataFrame) -> DataFrame:
    """Match packed rows to files by relative path; a file missing on either side does
    not match. Only digests are shuffled, never the contents."""
    return _digests(snapshot, "packed").join(
        _digests(files, "found"), "relative_path", "full_outer"
    ).select("relative_path", F.col("packed").eqNullSafe(F.col("found")).alias("matches"))


def content_totals(compared: DataFrame) -> DataFrame:
    return compared.agg(
        F.count(F.lit(1)).alias("files_compared"), F.count_if(~F.col("matches")).alias("mismatched")
    )


def sample_paths(snapshot: DataFrame, size: int = SAMPLE_SIZE, seed: str = "0") -> DataFrame:
    """A repeatable random sample without replacement; all rows when there are fewer."""
    order = F.md5(F.concat(F.lit(seed), F.col("relative_path")).cast("binary"))
    return snapshot.select("relative_path").orderBy(order, "relative_path").limit(size)


def verify_sample(snapshot: DataFrame, root: str, size: int = SAMPLE_SIZE, seed: str = "0") -> DataFrame:
    """Compare the sampled files only: relative_path, matches.

    The sampled names are chosen first, from the path column alone, and pushed to the scan as a
    filter. The tree is neither listed nor read beyond the files it names.
    """
    names = [row.relative_path for row in sample_paths(snapshot, size, seed).collect()]
    packed = _digests(snapshot.where(F.col("relative_path").isin(names)), "packed")
    named = packed.withColumn("relative_path", checked_relative(F.col("relative_path")))
    return add_file_digests(named, root).select(
        "relative_path", F.col("packed").eqNullSafe(F.col("found")).alias("matches")
    )


def _digests(files: DataFrame, name: str) -> DataFrame:
    return files.select(
        clean_path(F.col("relative_path")).alias("relative_path"), F.sha2("file_content", 256).alias(name)
    )


def _file_writer(uri: str, spare_uri: str | None = None):
    # A closure with its own imports: workers need no copy of this package.
    def write_batches(batches):
        import os
        import random
        import uuid

        import pyarrow as pa
        from pyarrow import fs

        def put(store, place, target):
            for attempt in range(5):
                try:
                    store.move(place, target)
                    return
                except OSError:  # not every store renames onto an existing file
                    if attempt == 4:
                        raise
                    try:
                        store.delete_file(target)
                    except OSError:
                        pass  # another attempt of this task was faster

        store, base = fs.FileSystem.from_uri(uri)
        renames = store.type_name not in ("s3", "gcs", "abfs")  # those publish whole objects
        old, enough = [], 500  # old files that a task holds before it takes no more for new folders

        def taken_over(folder):
            """The files of an old folder, which is moved here; none when there are no more, or when
            this folder is there already."""
            if spare_uri and not old:
                old.extend(name for name in os.listdir(spare_uri) if not name.startswith("."))
                random.shuffle(old)  # tasks seldom want the same one
            while old and not os.path.lexists(folder):
                place = f"{spare_uri}/{old[-1]}"
                try:
                    names = os.listdir(place)  # before others may write there
                    os.makedirs(os.path.dirname(folder), exist_ok=True)
                    os.rename(place, folder)
                except FileNotFoundError:
                    names = None  # another task has it
                except OSError:
                    break  # another task has made the folder since
                old.pop()
                if names:
                    return [f"{folder}/{name}" for name in names]
            return []

        folders, over, aside = set(), [], []
        for batch in batches:
            size = 0
            for path, content in zip(batch.column(0), batch.column(1)):
                target = f"{base}/{path.as_py()}"
                folder = target.rpartition("/")[0]
                if folder not in folders:
                    if len(over) < enough:
                        over += taken_over(folder)  # the last ones are used first, within their folder
                    store.create_dir(folder, recursive=True)
                    folders.add(folder)
                body = content.as_buffer()
                if spare_uri and not over and (over := taken_over(f"{spare_uri}/.{uuid.uuid4().hex}")):
                    aside.append(os.path.dirname(over[0]))
                if over:
                    place = over.pop()
                    with open(place, "r+b", buffering=0) as out:
                        rest = memoryview(body)
                        while rest:
                            rest = rest[out.write(rest) :]
                        if os.fstat(out.fileno()).st_size > body.size:
                            out.truncate()
                else:
                    place = f"{folder}/.{uuid.uuid4().hex}.part" if renames else target
                    with store.open_output_stream(place) as out:
                        out.write(body)
                if renames:
                    put(store, place, target)
                size += body.size
            yield pa.RecordBatch.from_pydict(
                {
                    "files_written": pa.array([batch.num_rows], pa.int64()),
                    "bytes_written": pa.array([size], pa.int64()),
                }
            )
        if over:  # for other tasks
            back = f"{spare_uri}/.{uuid.uuid4().hex}"
            os.mkdir(back)
            for place in over:
                os.rename(place, f"{back}/{os.path.basename(place)}")
            os.rename(back, f"{spare_uri}/{uuid.uuid4().hex}")
        for folder in aside:
            os.rmdir(folder)

    return write_batches
