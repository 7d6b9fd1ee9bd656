"""Executor-side access to files under the shared scratch folder, by URI."""

from __future__ import annotations

import re

from pyarrow import fs


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a URI as Spark writes it (``s3a:`` is ``s3:`` to Arrow; a
    path without a scheme is a local or mounted one)."""
    uri = re.sub(r"^s3[an]:", "s3:", uri)
    if re.match(r"^file:", uri) or "://" not in uri:
        return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", uri)
    return fs.FileSystem.from_uri(uri)


def read_range(uri: str, offset: int, size: int) -> bytes:
    """Exactly ``size`` bytes from ``offset``; a shorter file is an error."""
    system, path = open_fs(uri)
    with system.open_input_file(path) as f:
        data = f.read_at(size, offset)
    if len(data) != size:
        raise OSError(f"{uri}: {len(data)} of {size} bytes at {offset}")
    return data
