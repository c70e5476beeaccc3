"""Payloads as files by name: what a provider said, one file each, written in two phases.

``df.write.format("payload_files").option("folder", ...).mode("append").save()`` takes rows of name and payload. Tasks write below
``_temporary``, which no reader of folders looks into; the driver moves what whole tasks wrote to the folder once all have ended,
and a job that fails leaves nothing. A name that is there already is overwritten. Of a name's payloads in one job one is kept, any; a null payload is an
empty file, and a row without a name, or with one that hides its file, fails the job. / in a name becomes _.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from tidebook.functions.workers import ship

SCHEMA = "name string, payload string"


def file_name(name: str | None) -> str:
    """A payload's name as that of a file."""
    made = (name or "").replace("/", "_")
    if not made or made.startswith(("_", ".")):
        raise ValueError(f"no name for a payload's file: {name!r}")
    return made


def system_of(folder: str):
    """The file system of a folder, and the folder's path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


@dataclass
class Written(WriterCommitMessage):
    """What a task wrote: where, and how many files. Their names stay in the folder."""

    path: str
    files: int


class PayloadWriter(DataSourceWriter):
    def __init__(self, folder: str):
        self.folder, self.job = folder.rstrip("/"), uuid.uuid4().hex

    def write(self, iterator: Iterator[Row]) -> Written:
        system, root = system_of(self.folder)
        path = f"{root}/_temporary/{self.job}/{uuid.uuid4().hex}"  # of this attempt alone
        system.create_dir(path, recursive=True)
        names: set[str] = set()
        try:
            for row in iterator:
                name = file_name(row["name"])
                with system.open_output_stream(f"{path}/{name}") as f:
                    f.write((row["payload"] or "").encode())
                names.add(name)
        except BaseException:
            system.delete_dir(path)
            raise
        return Written(path, len(names))

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        system, root = system_of(self.folder)
        for message in filter(None, messages):
            for found in system.get_file_info(fs.FileSelector(message.path)):
                system.move(found.path, f"{root}/{found.base_name}")
        self._clear(system, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*system_of(self.folder))

    def _clear(self, system, root: str) -> None:
        """What is left of this job, also by attempts that no message tells of."""
        from pyarrow import fs

        path = f"{root}/_temporary/{self.job}"
        if system.get_file_info(path).type == fs.FileType.Directory:
            system.delete_dir(path)


class PayloadFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "payload_files"

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema, overwrite: bool) -> PayloadWriter:
        if overwrite:
            raise ValueError("payload files are added to; overwrite isn't offered")
        return PayloadWriter(self.options["folder"])


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(PayloadFiles)
