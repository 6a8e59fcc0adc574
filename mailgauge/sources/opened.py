"""File systems as tasks open them, without Hadoop."""

from __future__ import annotations

from collections.abc import Callable

from pyarrow import fs

# From the URI of a directory or file to its file system, its path there, and what to put before such paths.
Opened = Callable[[str], tuple[fs.FileSystem, str, str]]


def open_path(uri: str) -> tuple[fs.FileSystem, str, str]:
    """The file system of a path as Hadoop writes it, without escapes; see ``Opened``."""
    scheme, colon, rest = uri.partition(":")
    if not colon or scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/"), "file:"
    authority, _, key = rest.removeprefix("//").partition("/")
    system, base = fs.FileSystem.from_uri(f"{scheme.replace('s3a', 's3')}://{authority}/")
    base = base.rstrip("/")
    return system, f"{base}/{key}", f"{scheme}://" + ("" if base else authority)
