"""Tables written between the steps of one run.

They live below ``spark.checkpoint.dir``, the folder all executors share, so a
lost executor costs a re-read and never a recomputation with other contents.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
# States that a file: folder is on a file system that all machines mount.
_MOUNTED = "spark.ctrprep.sharedFileSystem"
_PATH = "_ctrprep_stored_at"
# Files that a trial of a folder writes for each core, so that all executors at hand take part.
_TRIAL_FILES = 4
# The folders, each with its application and the cores it had, that have passed a trial.
_tried: set[tuple[str, str, int]] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.

    Only a session on this machine may go without: it gets a temporary folder, which
    goes when the application ends.  On a cluster the folder has to be set, and one
    of scheme ``file`` is tried out once by an application, and again when it has got more
    executors, unless ``spark.ctrprep.sharedFileSystem`` says that all machines mount it.  It is
    refused where Spark has not opened a checkpoint folder or the trial does not get its rows back.
    """
    context = spark.sparkContext
    on_cluster = not context.master.startswith("local")
    folder = spark.conf.get(_SETTING, None) or context.getCheckpointDir()
    if folder is None:
        if on_cluster:
            raise RuntimeError(f"set {_SETTING} to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="ctrprep-")
        context.setCheckpointDir(folder)
        _remove_at_exit(spark, folder)
    if on_cluster and _scheme(spark, folder) == "file" and spark.conf.get(_MOUNTED, "false") != "true":
        if context.getCheckpointDir() is None or not _shared_by_all(spark, folder):
            raise RuntimeError(f"{_SETTING} is a folder of one machine: {folder}")
    return folder.rstrip("/")


def _shared_by_all(spark: SparkSession, folder: str) -> bool:
    """Whether what tasks write to ``folder`` is all there when other tasks read it."""
    context = spark.sparkContext
    cores = context.defaultParallelism
    trial = (context.applicationId, folder, cores)
    if trial not in _tried:
        path = f"{folder.rstrip('/')}/ctrprep-{context.applicationId}/trial-{uuid.uuid4().hex}"
        n = _TRIAL_FILES * cores
        try:
            rows = spark.range(0, n, 1, n)
            rows.write.parquet(path)
            if spark.read.schema(rows.schema).parquet(path).count() != n:
                return False
        finally:
            _delete(spark, path)
        _tried.add(trial)
    return True


def store(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    It is removed by :func:`release`, or else when the application ends.
    """
    spark = df.sparkSession
    home = _home(spark)
    path = f"{home}/{label}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    _remove_at_exit(spark, home)
    stored = spark.read.schema(df.schema).parquet(path)
    setattr(stored, _PATH, path)
    return stored


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that is not in use, removed when the application ends."""
    home = _home(spark)
    _remove_at_exit(spark, home)
    return f"{home}/{label}-{uuid.uuid4().hex}"


def is_stored(df: DataFrame) -> bool:
    return hasattr(df, _PATH)


def release(*tables: DataFrame) -> None:
    """Remove the files of tables that :func:`store` returned; they cannot be read any more."""
    for table in tables:
        if is_stored(table):
            _delete(table.sparkSession, getattr(table, _PATH))


def release_all(spark: SparkSession) -> None:
    """Remove everything this application has stored, for sessions that go on for long."""
    _delete(spark, _home(spark))


def _home(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/ctrprep-{spark.sparkContext.applicationId}"


def _file_system(spark: SparkSession, folder: str):
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(context._jsc.hadoopConfiguration())


def _scheme(spark: SparkSession, folder: str) -> str:
    _, system = _file_system(spark, folder)
    return system.getUri().getScheme()


def _delete(spark: SparkSession, folder: str) -> None:
    path, system = _file_system(spark, folder)
    system.delete(path, True)


def _remove_at_exit(spark: SparkSession, folder: str) -> None:
    path, system = _file_system(spark, folder)
    system.deleteOnExit(path)
