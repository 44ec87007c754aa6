"""Binary files in the shared folder, by URI, for code that runs inside tasks."""

from __future__ import annotations

import sys
from urllib.parse import unquote, urlsplit

import pyarrow.fs as fs
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def located(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it. A path without scheme, or with ``file``, is one that all machines mount."""
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parts.path)
    return fs.FileSystem.from_uri(uri)


def make_folder(uri: str) -> None:
    system, path = located(uri)
    system.create_dir(path, recursive=True)


def publish(uri: str, write) -> int:
    """Calls ``write`` with an output stream; the file appears under its name only when complete. Returns its size."""
    system, path = located(uri)
    parent, _, name = path.rpartition("/")
    import uuid

    aside = f"{parent}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(aside) as out:
        write(out)
        size = out.tell()
    system.move(aside, path)
    return size


class Ranges:
    """Reads byte ranges of one file."""

    def __init__(self, uri: str):
        system, path = located(uri)
        self._file = system.open_input_file(path)
        self.size = self._file.size()

    def read(self, start: int, length: int) -> bytes:
        if start < 0 or start + length > self.size:
            raise ValueError(f"bytes {start} to {start + length} lie outside a file of {self.size}")
        return self._file.read_at(length, start)

    def __enter__(self) -> Ranges:
        return self

    def __exit__(self, *_) -> None:
        self._file.close()
