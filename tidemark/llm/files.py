"""Plain binary files in the shared folder, written and read from tasks.

A file is written under a name of its own attempt and renamed when complete, so a second attempt of
a task, or a speculative one, replaces it with the same bytes.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyarrow import fs


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


@contextmanager
def written(uri: str):
    system, path = _open(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    attempt = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(attempt) as out:
        yield out
    system.move(attempt, path)


@contextmanager
def opened(uri: str):
    system, path = _open(uri)
    with system.open_input_file(path) as source:
        yield source
