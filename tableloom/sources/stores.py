"""Small files in a store, by path or URI."""

from __future__ import annotations

from pyarrow import fs


def put_text(path: str, body: str) -> None:
    """Writes one file, with the folders that it needs."""
    if path.startswith("file:/"):
        system, place = fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    else:
        system, place = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    system.create_dir(place.rpartition("/")[0], recursive=True)
    with system.open_output_stream(place) as out:
        out.write(body.encode())
