"""File trees seen through Arrow's file systems: one walk that finds every file, and the
reading and checking of single files.

Spark's own file sources hold a tree's listing on the driver and leave out hidden and empty
files. The walk here goes level by level: tasks open the folders of a level, and what they
find is written to the shared folder, so that the driver holds no names and every later step
sees the same moment. A folder on a local or mounted store is listed page by page.
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from advisory_lake.session import delete_folder, few_tasks, run_folder

# Hadoop's names of stores and Arrow's.
ARROW_SCHEMES = {"s3": "s3", "s3a": "s3", "s3n": "s3", "hdfs": "hdfs", "viewfs": "viewfs", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}

RENAMING = ("local", "hdfs")  # Arrow's names of stores that rename a folder in one step

READ_BYTES = 16 << 20  # file contents that a task holds at once
PAGE_NAMES = 10_000  # names of a folder that a task holds at once


def qualified(spark: SparkSession, root: str) -> str:
    """The path with scheme and authority, as Spark itself understands it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    if path.isUriPathAbsolute() is False:
        path = spark._jvm.org.apache.hadoop.fs.Path(os.path.abspath(root))
    return with_default(path.toString(), spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///"))


def with_default(path: str, default: str) -> str:
    """Scheme and authority of the default store for a path that has none."""
    if re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*:", path):
        return path
    return default.rstrip("/") + path if default.rstrip("/") != "file:" else "file://" + path


def arrow_uri(root: str) -> str:
    """The folder as Arrow names it; schemes that Arrow does not know are refused.

    A path without scheme is one of the session's default store, so it needs a session.
    """
    if not re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*:", root):
        session = SparkSession.getActiveSession()
        if session is None:
            raise ValueError(f"{root} has no scheme, and there is no session to say which store is meant")
        root = qualified(session, root)
    scheme, _, rest = root.partition(":")
    if scheme == "file":
        return "/" + rest.strip("/")
    if scheme not in ARROW_SCHEMES:
        raise ValueError(f"Arrow has no file system for {scheme}: ({root})")
    return f"{ARROW_SCHEMES[scheme]}:{rest.rstrip('/')}"


def exists(root: str) -> bool:
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(arrow_uri(root))
    return store.get_file_info(base).type == fs.FileType.Directory


def walk(spark: SparkSession, root: str, dot_names: bool = True) -> DataFrame:
    """Every file below ``root``: relative_path, length, modificationTime.

    Names that start with ``_`` and empty files are among them, names that start with ``.`` and
    what lies below such folders as well unless ``dot_names`` is off. An absent root is an error.
    """
    if not exists(root):
        raise FileNotFoundError(f"no folder {root}")
    folder = run_folder(spark, "walk")
    lister = folder_lister(arrow_uri(root), dot_names)
    folders = spark.createDataFrame([("",)], "relative_path STRING")
    level = 0
    while True:
        path = f"{folder}/level={level}"
        folders.mapInArrow(lister, "relative_path STRING, length LONG, modificationTime TIMESTAMP").write.parquet(path)
        found = spark.read.schema("relative_path STRING, length LONG, modificationTime TIMESTAMP").parquet(path)
        folders = found.where("length is null").select("relative_path")
        if folders.isEmpty():
            break
        folders = folders.repartition(few_tasks(spark), "relative_path")
        level += 1
    every = spark.read.schema("relative_path STRING, length LONG, modificationTime TIMESTAMP, level INT").parquet(folder)
    return every.where("length is not null").drop("level")


def folder_lister(uri: str, dot_names: bool = True, page: int = PAGE_NAMES):
    """For mapInArrow over folders: their entries, folders without length.

    Of a local or mounted folder a task holds one page of names at a time, however many there
    are; other stores answer with the names of a folder at once.
    """
    # A closure with its own imports: workers need no copy of this package.
    def list_folders(batches):
        import os
        import re
        from itertools import islice

        import pyarrow as pa
        from pyarrow import fs

        unfinished = re.compile(r"\.[0-9a-f]{16,32}\.part")  # what a lost unpacking task leaves
        store, base = fs.FileSystem.from_uri(uri)

        def local_entries(folder):
            try:
                found = os.scandir(folder)
            except FileNotFoundError:
                return
            with found:
                for entry in found:
                    try:
                        known = entry.stat()
                        yield entry.name, None if entry.is_dir() else known.st_size, known.st_mtime_ns // 1000
                    except FileNotFoundError:
                        continue  # gone since, or a link to nothing

        def store_entries(folder):
            for e in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
                yield e.base_name, e.size if e.type == fs.FileType.File else None, e.mtime

        entries = local_entries if store.type_name == "local" else store_entries
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = (
                    e
                    for e in entries(f"{base}/{folder}" if folder else base)
                    if (dot_names or not e[0].startswith(".")) and not unfinished.fullmatch(e[0])
                )
                while part := list(islice(found, page)):
                    names, lengths, times = zip(*part)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "relative_path": pa.array([f"{folder}/{name}".lstrip("/") for name in names], pa.string()),
                            "length": pa.array(lengths, pa.int64()),
                            "modificationTime": pa.array(times, pa.timestamp("us", "UTC")),
                        }
                    )

    return list_folders


def beside(root: str) -> str:
    """A new hidden folder name next to ``root``, in the same store."""
    parent, slash, name = root.rstrip("/").rpartition("/")
    if not name or re.fullmatch(r"[a-zA-Z][a-zA-Z0-9+.-]*:/", parent):  # a whole bucket or host
        raise ValueError(f"{root} has no parent folder to stage files in")
    return f"{parent}{slash}.{name}-{uuid.uuid4().hex[:12]}.staged"


def spare_folder(root: str) -> str | None:
    """A new folder for folders that are not needed any more but whose files can be written over;
    None on stores where that is not done file by file."""
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(arrow_uri(root))
    if store.type_name != "local":
        return None
    store.create_dir(base, recursive=True)
    return root


def delete_folders(spark: SparkSession, root: str, folders: DataFrame, spare: str | None = None) -> None:
    """Delete a tree: ``folders`` (one column, relative to ``root``) in tasks, then what is left.
    With ``spare`` those that hold files alone are moved there, which frees nothing."""
    deleter = _folder_deleter(arrow_uri(root), arrow_uri(spare) if spare else None)
    gone = folders.repartition(few_tasks(spark), folders.columns[0]).mapInArrow(deleter, "deleted LONG")
    gone.agg(F.sum("deleted")).collect()
    delete_folder(spark, qualified(spark, root))


def delete_spare(spark: SparkSession, spare: str) -> None:
    """Delete the folders that nobody has taken, and leave an empty ``spare``."""
    if os.listdir(arrow_uri(spare)):
        listed = spark.createDataFrame([("",)], "relative_path STRING").mapInArrow(
            folder_lister(arrow_uri(spare)), "relative_path STRING, length LONG, modificationTime TIMESTAMP"
        )
        delete_folders(spark, spare, listed.select("relative_path"))
        spare_folder(spare)


def _folder_deleter(uri: str, spare_uri: str | None = None):
    # A closure with its own imports: workers need no copy of this package.
    def delete(batches):
        import os
        import re
        import uuid

        import pyarrow as pa
        from pyarrow import fs

        unfinished = re.compile(r"\.[0-9a-f]{16,32}\.part")
        store, base = fs.FileSystem.from_uri(uri)

        def retire(folder):
            # under a hidden name until all is done, so that no task takes half of it
            known = uuid.uuid4().hex
            held = f"{spare_uri}/.{known}"
            os.rename(folder, held)
            with os.scandir(held) as found:
                names = [entry.name if entry.is_file(follow_symlinks=False) else None for entry in found]
            if None in names:
                store.delete_dir(held)
                return
            for number, name in enumerate(names):
                if unfinished.fullmatch(name):
                    os.unlink(f"{held}/{name}")  # a lost task may still write to it
                else:
                    os.rename(f"{held}/{name}", f"{held}/.{known[:20]}{number:012x}.part")
            os.rename(held, f"{spare_uri}/{known}")

        for batch in batches:
            for folder in filter(None, batch.column(0).to_pylist()):
                try:
                    (retire if spare_uri else store.delete_dir)(f"{base}/{folder}")
                except OSError:
                    pass  # gone with the folder it lies in; what is left goes with the root
            yield pa.RecordBatch.from_pydict({"deleted": pa.array([batch.num_rows], pa.int64())})

    return delete


def publish(spark: SparkSession, staged: str, root: str, names: DataFrame | None = None) -> None:
    """Move a whole staged tree to ``root``.

    One rename when there is no ``root`` yet and the store has renames. Otherwise tasks move the
    files, each in one step, over those of the same path; other files of ``root`` stay. Files that
    have been moved are not staged any more, so that a call that failed can be made again.
    ``names`` (relative_path) are the files of the tree; without them it is walked. A task moves
    neighbouring files, so that tasks seldom wait for one another's folders.
    """
    from pyarrow import fs

    store, target = fs.FileSystem.from_uri(arrow_uri(root))
    _, source = fs.FileSystem.from_uri(arrow_uri(staged))
    if not exists(staged):
        store.create_dir(target, recursive=True)
    elif store.type_name in RENAMING and store.get_file_info(target).type == fs.FileType.NotFound:
        store.move(source, target)
    else:
        names = walk(spark, staged) if names is None else names
        moves = names.select("relative_path").repartitionByRange(few_tasks(spark), "relative_path")
        moves.mapInArrow(_file_mover(arrow_uri(staged), arrow_uri(root)), "moved LONG").agg(F.sum("moved")).collect()
        delete_folder(spark, staged)


def _file_mover(source_uri: str, target_uri: str):
    # A closure with its own imports: workers need no copy of this package.
    def move(batches):
        from contextlib import nullcontext

        import pyarrow as pa
        from pyarrow import fs

        store, source = fs.FileSystem.from_uri(source_uri)
        _, target = fs.FileSystem.from_uri(target_uri)
        def replaced(place):
            """The file that is there, open: it is freed when it is closed, not within the rename,
            during which a local store lets no other task rename."""
            if store.type_name == "local" and store.get_file_info(place).type == fs.FileType.File:
                try:
                    return store.open_input_file(place)
                except OSError:
                    pass  # gone since, or it may not be read
            return nullcontext()

        folders = set()
        for batch in batches:
            for name in batch.column(0).to_pylist():
                place, folder = f"{target}/{name}", f"{target}/{name}".rpartition("/")[0]
                if folder not in folders:
                    store.create_dir(folder, recursive=True)
                    folders.add(folder)
                for attempt in range(5):
                    try:
                        with replaced(place):
                            store.move(f"{source}/{name}", place)
                        break
                    except OSError:
                        if store.get_file_info(f"{source}/{name}").type == fs.FileType.NotFound:
                            break  # an earlier attempt of this task has moved it
                        there = store.get_file_info(place).type
                        if attempt == 4 or there == fs.FileType.Directory:
                            raise
                        if there == fs.FileType.File:  # not every store renames onto an existing file
                            store.delete_file(place)
            yield pa.RecordBatch.from_pydict({"moved": pa.array([batch.num_rows], pa.int64())})

    return move


def read_contents(listing: DataFrame, root: str) -> DataFrame:
    """relative_path and file_content of listed files. A file that has vanished since or may
    not be read is left out, as a count against the listing shows; any other error fails the
    task, which Spark tries again."""
    return listing.select("relative_path").mapInArrow(
        _file_reader(arrow_uri(root)), "relative_path STRING, file_content BINARY"
    )


def _file_reader(uri: str):
    # A closure with its own imports: workers need no copy of this package.
    def read(batches):
        import pyarrow as pa
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(uri)

        def rows(names, contents):
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(contents, pa.binary())], names=["relative_path", "file_content"]
            )

        for batch in batches:
            names, contents, held = [], [], 0
            for name in batch.column(0).to_pylist():
                try:
                    with store.open_input_stream(f"{base}/{name}", compression=None) as file:
                        content = file.read()
                except (FileNotFoundError, PermissionError):
                    continue
                names.append(name)
                contents.append(content)
                held += len(content)
                if held >= READ_BYTES:
                    yield rows(names, contents)
                    names, contents, held = [], [], 0
            if names:
                yield rows(names, contents)

    return read


def add_file_digests(named: DataFrame, root: str) -> DataFrame:
    """Add the SHA-256 of the file below ``root`` that each row names, null when there is none:
    relative_path, packed, found. A file that is there but cannot be read fails the task, which
    Spark tries again. For a few files out of a large tree."""
    return named.select("relative_path", "packed").mapInArrow(
        _file_digester(arrow_uri(root)), "relative_path STRING, packed STRING, found STRING"
    )


def _file_digester(uri: str):
    # A closure with its own imports: workers need no copy of this package.
    def digest(batches):
        import hashlib

        import pyarrow as pa
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(uri)

        def of_file(path):
            try:
                with store.open_input_stream(f"{base}/{path}", compression=None) as file:
                    known = hashlib.sha256()
                    while chunk := file.read(1 << 20):
                        known.update(chunk)
                return known.hexdigest()
            except OSError:
                if store.get_file_info(f"{base}/{path}").type == fs.FileType.File:
                    raise  # it is there: the store failed
                return None

        for batch in batches:
            found = pa.array([of_file(path) for path in batch.column(0).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=["relative_path", "packed", "found"])

    return digest
