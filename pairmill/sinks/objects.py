"""One object per result, under a name of its own, as a Spark data source.

A task stages its objects in a folder that no other attempt uses. Only when all of them
are complete does it give them their names; one that fails before or while doing so takes
back what it made. Names are a function of the result, so a repeated task overwrites its
objects with the same bytes. When the whole write fails, the objects of tasks that did end
are taken back too; otherwise the staging folder goes and an empty `_committed` file stays.

The driver sees one message per task, not the names: those are in a file per task.
"""

from __future__ import annotations

import contextlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from pairmill.sinks.folder import fresh_name, open_folder

FORMAT = "pairmill_objects"


@dataclass
class Staged(WriterCommitMessage):
    """Objects that one task has written, and the file that lists their names."""

    objects: int
    names: str


class ObjectWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path
        self.job = fresh_name("")

    def _open(self) -> tuple[fs.FileSystem, str, str]:
        system, folder = open_folder(self.path)
        return system, folder, f"{folder}/.staging-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        system, folder, staging = self._open()
        attempt = f"{staging}/{fresh_name('')}"
        system.create_dir(attempt, recursive=True)
        names: list[str] = []
        moved: list[str] = []
        try:
            for batch in iterator:
                for name, content in zip(batch["name"], batch["content"], strict=True):
                    names.append(checked(name.as_py()))
                    with system.open_output_stream(f"{attempt}/{names[-1]}", compression=None) as out:
                        out.write(content.as_buffer() if content.is_valid else b"")
            for name in names:
                moved.append(name)
                system.move(f"{attempt}/{name}", f"{folder}/{name}")
            listed = f"{attempt}.names"
            with system.open_output_stream(listed, compression=None) as out:
                out.write(json.dumps(names).encode())
        except BaseException:
            take_back(system, folder, moved)
            raise
        finally:
            with contextlib.suppress(OSError):
                system.delete_dir(attempt)
        return Staged(len(names), listed)

    def commit(self, messages: list[Staged | None]) -> None:
        system, folder, staging = self._open()
        with contextlib.suppress(OSError):
            system.delete_dir(staging)
        with system.open_output_stream(f"{folder}/_committed", compression=None):
            pass

    def abort(self, messages: list[Staged | None]) -> None:
        system, folder, staging = self._open()
        for message in messages:
            if message is not None:
                with system.open_input_file(message.names) as listed:
                    take_back(system, folder, json.loads(listed.read()))
        with contextlib.suppress(OSError):
            system.delete_dir(staging)


def checked(name: str | None) -> str:
    """An object's name is one part of a path, and none of the names used here."""
    if not name or "/" in name or name.startswith((".", "_")):
        raise ValueError(f"no name of an object: {name!r}")
    return name


def take_back(system: fs.FileSystem, folder: str, names: list[str]) -> None:
    for name in names:
        with contextlib.suppress(OSError):
            system.delete_file(f"{folder}/{name}")


class ObjectSink(DataSource):
    """Rows of `name` and `content` (text or bytes) to objects below the path."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> ObjectWriter:
        missing = {"name", "content"} - set(schema.fieldNames())
        if missing:
            raise ValueError(f"no column {', '.join(sorted(missing))}")
        if overwrite:
            raise ValueError("objects are added; write them to a folder of their own")
        return ObjectWriter(self.options["path"])


def write_objects(contents: DataFrame, path: str) -> None:
    """Write each row's `content` as the object `name` below `path`."""
    contents.sparkSession.dataSource.register(ObjectSink)
    contents.select("name", "content").write.format(FORMAT).mode("append").save(path)


def read_objects(spark: SparkSession, path: str) -> DataFrame:
    """`name, content` (bytes) of the objects below `path`; Spark passes over empty files."""
    files = spark.read.format("binaryFile").load(path)
    return files.selectExpr("url_decode(element_at(split(path, '/'), -1)) as name", "content").where("name not like '\\\\_%'")
