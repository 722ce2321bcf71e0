"""Files of any kind in a shared folder, written and read inside tasks.

Spark writes tables; files whose bytes a task lays out itself go through Arrow's file
systems (local and mounted folders, HDFS, S3, GCS). A task writes under a name that no
other attempt uses and returns it as a row; only names in the stored rows count, so what a
failed or speculative attempt leaves behind is never read.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system that holds `uri`, and the path there; the folder is made."""
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path, recursive=True)
    return system, path


def fresh_name(suffix: str) -> str:
    """A file name of this attempt alone."""
    return uuid.uuid4().hex + suffix


def read_range(file, start: int, length: int) -> bytes:
    """`length` bytes from `start` of a file opened by `open_input_file`."""
    file.seek(start)
    return file.read(length)
