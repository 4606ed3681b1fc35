"""Files on storage that all tasks reach, opened by the tasks themselves."""

from __future__ import annotations

from pyarrow import fs

# Spark's names of storage schemes where Arrow has another.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark gives it, and the path there.  A name may hold signs
    that would have to be escaped in an address, so only what precedes it is read as one."""
    scheme, found, rest = path.partition("://")
    if not found:
        return fs.LocalFileSystem(), path.removeprefix("file:")
    if scheme == "file":
        return fs.LocalFileSystem(), rest
    authority, _, inner = rest.partition("/")
    system, base = fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{authority}")
    return system, f"{base.rstrip('/')}/{inner}"


def listed(files: fs.FileSystem, folder: str) -> list[fs.FileInfo]:
    """What is right in a folder; nothing where there is none."""
    return files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
