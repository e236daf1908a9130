"""Binary files in the shared folder, written and read by tasks.

Paths are URIs; pyarrow opens them, so file, hdfs, s3 and gs folders work from every executor.
A task writes under a name of its own attempt and renames the finished file, so a repeated or
speculative attempt leaves the same file and never a part of one.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import SparkSession

from casona.session import shared_folder


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def located(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def partition() -> int:
    context = TaskContext.get()
    return context.partitionId() if context else 0


@contextmanager
def new_file(path: str):
    """A binary stream that becomes ``path`` when it closes without an error."""
    store, place = located(path)
    folder, _, name = place.rpartition("/")
    store.create_dir(folder, recursive=True)
    context = TaskContext.get()
    draft = f"{folder}/.{name}.{context.taskAttemptId() if context else 0}"
    with store.open_output_stream(draft, compression=None) as out:
        yield out
    store.move(draft, place)


@contextmanager
def opened(path: str):
    """A seekable binary file."""
    store, place = located(path)
    with store.open_input_file(place) as f:
        yield f
