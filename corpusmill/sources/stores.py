"""Files in any store that pyarrow's file systems reach (local or mounted paths, HDFS, S3,
GCS): opening by URI and glob listing, for tasks that must read a file's bytes themselves."""

from __future__ import annotations

import fnmatch
from typing import NamedTuple

import pyarrow.fs as pafs


class StoredFile(NamedTuple):
    path: str
    size: int


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI; a plain path is a local or mounted one."""
    return pafs.FileSystem.from_uri(uri if ":/" in uri else f"file://{uri}")


def _prefix(uri: str, path: str) -> str:
    return uri[: len(uri) - len(path)] if uri.endswith(path) else ""


def list_matching(pattern: str) -> list[StoredFile]:
    """Files that match a glob (``*``, ``?``, ``[..]`` in any component), in name order."""
    fixed = pattern
    for mark in "*?[":
        fixed = fixed.split(mark, 1)[0]
    base = fixed.rsplit("/", 1)[0] or "/"
    store, root = open_store(base)
    prefix = _prefix(base, root)
    wanted = pattern[len(prefix) :].split("/")
    found = []
    for info in store.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)):
        parts = info.path.split("/")
        same = len(parts) == len(wanted) and all(fnmatch.fnmatchcase(a, b) for a, b in zip(parts, wanted))
        if info.type == pafs.FileType.File and same:
            found.append(StoredFile(prefix + info.path, info.size))
    return sorted(found)
