"""Byte files in the shared folder: written once under their final name, read by range."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:/"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


@contextmanager
def writing(path: str) -> Iterator[pa.NativeFile]:
    """A stream to a new file that gets its name only when it is whole, so a task that dies leaves no half file."""
    system, place = opened(path)
    system.create_dir(place.rpartition("/")[0], recursive=True)
    part = f"{place}.{uuid4().hex}.tmp"
    try:
        with system.open_output_stream(part) as out:
            yield out
        system.move(part, place)
    except BaseException:
        if system.get_file_info(part).type != fs.FileType.NotFound:
            system.delete_file(part)
        raise


def read_range(path: str, start: int, size: int) -> bytes:
    system, place = opened(path)
    with system.open_input_file(place) as source:
        return source.read_at(size, start)


def file_size(path: str) -> int:
    system, place = opened(path)
    return system.get_file_info(place).size
