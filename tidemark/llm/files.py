"""Files that tasks write and read in the shared folder, on any file system that pyarrow knows."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator


def _place(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(address(path))


def address(path: str) -> str:
    """A path as pyarrow takes it; Hadoop's names of an object store become the store's own."""
    if path.startswith("file:/") and not path.startswith("file://"):
        return f"file://{path[5:]}"
    scheme, mark, rest = path.partition("://")
    return f"s3{mark}{rest}" if scheme in ("s3a", "s3n") else path


@contextlib.contextmanager
def create_file(path: str) -> Iterator:
    """A stream to a new file, which appears under its name only when all is written: a task that runs again replaces it by the same bytes."""
    system, base = _place(path)
    system.create_dir(base.rsplit("/", 1)[0], recursive=True)
    folder, name = base.rsplit("/", 1)
    hidden = f"{folder}/_{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(hidden, compression=None) as out:
        yield out
    system.move(hidden, base)


def open_file(path: str):
    """A seekable stream."""
    system, base = _place(path)
    return system.open_input_file(base)
