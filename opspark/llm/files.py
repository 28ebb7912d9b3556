"""Files that tasks write and read themselves, in the shared folder."""

from __future__ import annotations

import re

from pyarrow import fs


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """(file system, path in it) of a plain path or a URI of any store pyarrow knows."""
    path = re.sub(r"^file:/+", "/", path)
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path
