"""What Python workers need."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ship(spark: SparkSession | None = None) -> None:
    """Let Python workers import this package: from where the driver has it if they share a machine, else as an archive that Spark hands out."""
    spark = spark or SparkSession.active()
    context = spark.sparkContext
    if is_local(spark):
        root, env = str(PACKAGE.parent), context.environment
        known = env.get("PYTHONPATH", "").split(os.pathsep)
        if root not in known:
            env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])
    elif context.applicationId not in _shipped:
        path = Path(tempfile.mkdtemp(prefix="tidebook-"), "tidebook.zip")
        with zipfile.ZipFile(path, "w") as archive:
            for file in sorted(PACKAGE.rglob("*.py")):
                archive.write(file, file.relative_to(PACKAGE.parent))
        context.addPyFile(str(path))
        _shipped.add(context.applicationId)


def release() -> None:
    """Give freed memory back to the system: Arrow's pool and the C library keep it else."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim:
        trim(0)


def releasing[T](rows: Iterable[T]) -> Iterator[T]:
    """The rows; once they end, what they took is given back. Spark keeps a task's worker for later ones, beside stages that need none."""
    try:
        yield from rows
    finally:
        release()
