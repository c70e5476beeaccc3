"""Folders for what a run writes and reads again."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from tidebook.functions.workers import is_local

_folders: set[str] = set()


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever it is that Spark wrote it."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(found, True)


def exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)


def names(spark: SparkSession, path: str) -> list[str]:
    """What is in a folder; nothing if it isn't there."""
    if not exists(spark, path):
        return []
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [x.getPath().getName() for x in found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(found)]


def _delete_at_exit(spark: SparkSession, path: str) -> None:
    found, conf = spark._jvm.org.apache.hadoop.fs.Path(path), spark.sparkContext._jsc.hadoopConfiguration()

    def go() -> None:
        with contextlib.suppress(Exception):  # Spark may be gone by then, and whoever owns the folder clears it
            found.getFileSystem(conf).delete(found, True)

    atexit.register(go)


def shared_dir(spark: SparkSession) -> str:
    """This application's own folder in the one that the driver and all executors share, deleted when the driver ends.

    The shared one is what the session says in ``spark.checkpoint.dir``. Only where that is
    unset and Spark runs in this process alone, a temporary folder is made and set; on a
    cluster it would be another one on each machine, and the setting must be there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        made = tempfile.mkdtemp(prefix="tidebook-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        base = f"file://{made}"
        spark.conf.set("spark.checkpoint.dir", base)
    folder = f"{base.rstrip('/')}/tidebook-{spark.sparkContext.applicationId}"
    if folder not in _folders:
        _folders.add(folder)
        _delete_at_exit(spark, folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` written once to the shared folder and read back."""
    path = new_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
