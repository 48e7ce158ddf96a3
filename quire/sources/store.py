"""Files that tasks write to and read from the shared folder, through pyarrow's file systems."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from typing import BinaryIO

from pyarrow import fs


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder's URI (file, hdfs, s3, gs, or a plain path)."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))


def commit_file(folder: str, name: str, write: Callable[[BinaryIO], None]) -> None:
    """Write under a temporary name of this attempt, then rename.

    A repeated or speculative attempt of the task writes the same bytes and replaces the file;
    an attempt that dies leaves only a temporary name, which no manifest lists.
    """
    store, root = open_store(folder)
    final = f"{root}/{name}"
    parent, _, base = final.rpartition("/")
    store.create_dir(parent, recursive=True)
    temporary = f"{parent}/.{base}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(temporary) as out:
        write(out)
    try:
        store.move(temporary, final)
    except OSError:  # stores that don't rename onto an existing file
        store.delete_file(final)
        store.move(temporary, final)


def open_input(folder: str, name: str):
    store, root = open_store(folder)
    return store.open_input_file(f"{root}/{name}")
