"""Session set-up: UTC, the shared work folder and a default session builder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

ZONE_KEY = "spark.sql.session.timeZone"
SHARED_FOLDER_KEY = "spark.checkpoint.dir"
SPLIT_BYTES_KEY = "spark.sql.files.maxPartitionBytes"
OPEN_COST_KEY = "spark.sql.files.openCostInBytes"
LISTING_TASKS_KEY = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

_local_folder: tempfile.TemporaryDirectory | None = None


def build_session(app_name: str = "advisory-lake", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC whose scan tasks take many small files at once; keyword settings
    use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name).config(ZONE_KEY, "UTC").config(OPEN_COST_KEY, "64k")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, values: dict[str, str | int]) -> Iterator[None]:
    """Session settings for the length of a block."""
    before = {key: spark.conf.get(key) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def utc(spark: SparkSession):
    """Plan in UTC whatever the caller's session says.

    Spark writes the zone into an expression when it analyses it, so a frame built
    inside this block keeps UTC when it runs later.
    """
    return settings(spark, {ZONE_KEY: "UTC"})


def small_file_scans(spark: SparkSession, files_per_task: int = 5000):
    """Let a scan task take many small files: up to so many, or one split of bytes.
    Holds for jobs that run inside the block. Scans still use every core."""
    return settings(spark, {OPEN_COST_KEY: max(1, conf_bytes(spark, SPLIT_BYTES_KEY) // files_per_task)})


def shuffles_deleted(spark: SparkSession):
    """What jobs that run inside shuffle is deleted as each ends, not when the driver collects it."""
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def few_tasks(spark: SparkSession, per_core: int = 4) -> int:
    """A number of tasks for work with many tiny items; a cluster that starts small and
    grows still gets a fair number."""
    return max(32, per_core * spark.sparkContext.defaultParallelism)


def modest_listing(spark: SparkSession):
    """List folders in a few tasks per core rather than one task per folder."""
    return settings(spark, {LISTING_TASKS_KEY: min(int(spark.conf.get(LISTING_TASKS_KEY)), few_tasks(spark))})


def conf_bytes(spark: SparkSession, key: str) -> int:
    """A size setting such as ``128MB`` or ``134217728b`` in bytes."""
    text = spark.conf.get(key).strip().lower().removesuffix("b")
    factor = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(text[-1:], 1)
    return int(text.rstrip("kmg")) * factor


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster.

    Only a local session may fall back to a folder of this machine.
    """
    global _local_folder
    configured = spark.conf.get(SHARED_FOLDER_KEY, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {SHARED_FOLDER_KEY} to a folder every executor can reach")
    if _local_folder is None:
        _local_folder = tempfile.TemporaryDirectory(prefix="advisory-lake-")
    return _local_folder.name


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give executors this package, once per application; they need no copy of it before."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parent
    handle, path = tempfile.mkstemp(prefix="advisory-lake-", suffix=".zip")
    with os.fdopen(handle, "wb") as file, zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(top.rglob("*.py")):
            archive.write(source, source.relative_to(top.parent))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


_run_folders: dict[str, list[str]] = {}


def run_folder(spark: SparkSession, label: str) -> str:
    """A new, unused folder name below the shared folder."""
    folder = f"{shared_folder(spark)}/advisory-lake/{label}-{uuid.uuid4().hex[:12]}"
    _run_folders.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return folder


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder and what is below it; one that is not there is no error."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def remove_run_folder(spark: SparkSession, folder: str) -> None:
    """Delete one run folder, once no frame that reads it is needed any more."""
    owned = _run_folders.get(spark.sparkContext.applicationId, [])
    if folder in owned:
        owned.remove(folder)
    delete_folder(spark, folder)


def remove_run_folders(spark: SparkSession) -> int:
    """Delete what this application has written below run folders, once no frame that reads
    them is needed any more; gives their number."""
    folders = _run_folders.pop(spark.sparkContext.applicationId, [])
    for folder in folders:
        delete_folder(spark, folder)
    return len(folders)
