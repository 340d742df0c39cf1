"""Files by URI, on the driver and in tasks.

Spark's own readers and writers reach every Hadoop file system. What they
cannot do (seek past payloads, write a file under a given name, see empty
files) goes through pyarrow's file systems here, one layer for local and
mounted paths and for object stores: ``file:``, ``s3:`` (``s3a:``), ``gs:``,
``abfs:``, ``hdfs:`` where libhdfs is installed, and whatever scheme a mount
table of the session (``viewfs:``) leads to. :func:`resolve` runs on the driver,
the rest anywhere.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote

from pyarrow import fs as pafs
from pyspark.sql import SparkSession

_SCHEME = re.compile(r"([A-Za-z][A-Za-z0-9+.-]*):")
# Names of one store in Hadoop and in pyarrow.
_ALIASES = {"s3a": "s3", "s3n": "s3", "gcs": "gs", "abfss": "abfs"}
_KNOWN = {"file", "s3", "gs", "abfs", "hdfs"}


class Entry(NamedTuple):
    uri: str
    size: int
    is_dir: bool


def scheme_of(uri: str) -> str:
    found = _SCHEME.match(uri)
    return found.group(1).lower() if found else "file"


def reachable(uri: str) -> bool:
    """Whether tasks can open ``uri`` (a resolved one) by this layer."""
    return _ALIASES.get(scheme_of(uri), scheme_of(uri)) in _KNOWN


def resolve(spark: SparkSession, uri: str) -> str:
    """The URI behind ``uri``: qualified by the session's default file system and led through its mount tables.

    What does not exist yet is resolved by its nearest ancestor that does.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    path = files.makeQualified(path)
    if path.toUri().getScheme() != "viewfs":
        return path.toString()
    rest: list[str] = []
    while not files.exists(path) and path.getParent() is not None:
        rest.insert(0, path.getName())
        path = path.getParent()
    return "/".join([files.resolvePath(path).toString().rstrip("/"), *rest])


def rebase(uri: str, root: str, resolved: str) -> str:
    """``uri``, a file below ``root`` as Spark lists it, below the root's resolved URI."""
    bare = lambda x: re.sub(r"^file:/+", "/", x)
    below = bare(uri).removeprefix(bare(root.rstrip("/")))
    return resolved.rstrip("/") + below if below != bare(uri) else uri


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    scheme = scheme_of(uri)
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + re.sub(r"^file:", "", uri).lstrip("/") if uri.startswith(("file:", "/")) else uri
    if not reachable(uri):
        raise ValueError(f"{uri}: tasks cannot open {scheme}: files")
    return pafs.FileSystem.from_uri(_ALIASES.get(scheme, scheme) + quote(uri[len(scheme):], safe="/:@?&=%"))


def _prefix(uri: str, path: str) -> str:
    """What stands before a path of the file system in URIs like ``uri``."""
    return "file:" if scheme_of(uri) == "file" else uri[: len(uri.rstrip("/")) - len(path.rstrip("/"))]


def list_dir(uri: str) -> list[Entry]:
    """The direct children of a directory, by name; none if it is missing."""
    files, path = _open(uri)
    prefix = _prefix(uri, path)
    found = files.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    return sorted(Entry(prefix + f.path, f.size or 0, f.type == pafs.FileType.Directory) for f in found)


def walk(uri: str) -> Iterator[Entry]:
    """Every file below a directory; directories that go meanwhile are left out."""
    stack = [uri]
    while stack:
        for entry in list_dir(stack.pop()):
            if entry.is_dir:
                stack.append(entry.uri)
            else:
                yield entry


def scan(uri: str) -> Iterator[Entry]:
    """Every file below a directory, in no order; of a local one no more than an entry is held at once."""
    if scheme_of(uri) != "file":
        yield from walk(uri)
        return
    stack = [_open(uri)[1]]
    while stack:
        try:
            entries = os.scandir(stack.pop())
        except FileNotFoundError:
            continue
        with entries:
            for entry in entries:
                if entry.is_dir():
                    stack.append(entry.path)
                    continue
                try:
                    size = entry.stat().st_size
                except FileNotFoundError:
                    continue
                yield Entry(f"file:{entry.path}", size, False)


def size_of(uri: str) -> int | None:
    """Bytes of a file; None if there is no such file."""
    files, path = _open(uri)
    info = files.get_file_info(path)
    return info.size if info.type == pafs.FileType.File else None


def open_file(uri: str):
    """A file for reading at any place."""
    files, path = _open(uri)
    return files.open_input_file(path)


def make_dir(uri: str) -> None:
    files, path = _open(uri)
    files.create_dir(path, recursive=True)


def create_file(uri: str):
    """A new file for writing, in an existing directory."""
    files, path = _open(uri)
    return files.open_output_stream(path, compression=None)


def move(source: str, target: str) -> None:
    """A file to another name of the same file system, in place of what stands there."""
    files, path = _open(source)
    files.move(path, _open(target)[1])


def delete(uri: str) -> None:
    """A file or a directory with all that is in it, if there is one."""
    files, path = _open(uri)
    kind = files.get_file_info(path).type
    if kind == pafs.FileType.Directory:
        files.delete_dir(path)
    elif kind == pafs.FileType.File:
        files.delete_file(path)
