"""Files written and read inside tasks, below the shared scratch folder.

A task gives each file a name of its own and returns it in its result row; only
rows of attempts that Spark committed name files, so a lost executor or a
repeated attempt can leave an unread file behind but never a torn or doubled one.
"""

from __future__ import annotations

import uuid


def open_fs(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def new_file(folder: str, stem: str, suffix: str, data) -> str:
    """Write ``data`` (bytes or a list of bytes) to a fresh file; its URI."""
    name = f"{folder.rstrip('/')}/{stem}-{uuid.uuid4().hex}{suffix}"
    filesystem, path = open_fs(name)
    filesystem.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with filesystem.open_output_stream(path, compression=None) as out:
        for part in ([data] if isinstance(data, (bytes, bytearray)) else data):
            out.write(part)
    return name


def read_file(uri: str) -> bytes:
    filesystem, path = open_fs(uri)
    with filesystem.open_input_file(path) as f:
        return f.read()


def partition_id() -> int:
    from pyspark import TaskContext
    return TaskContext.get().partitionId()
