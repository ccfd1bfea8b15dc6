"""Opening files from tasks, on any filesystem Arrow knows."""

from __future__ import annotations

import re
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

# How names of files begin that are being written; listings pass over these and nothing else.
UNFINISHED = "_samplelake_unfinished-"

_URI = re.compile(r"^([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(/.*)?$")


def split_path(path: str) -> tuple[str, str, str]:
    """Scheme, authority and path of a URI or a plain path."""
    found = _URI.match(path)
    if not found:
        return "file", "", path
    scheme, authority, inner = found.groups()
    return scheme, authority or "", inner or "/"


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme Spark's own readers would give it; call it on the driver."""
    if _URI.match(path):
        return path
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    return named.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(named).toString()


class Files:
    """Filesystems opened by one task, by scheme and authority."""

    def __init__(self) -> None:
        self._open: dict[tuple[str, str], tuple[fs.FileSystem, str]] = {}

    def at(self, path: str) -> tuple[fs.FileSystem, str]:
        scheme, authority, inner = split_path(path)
        if scheme == "file":
            inner = re.sub("^/+", "/", inner)
        if (scheme, authority) not in self._open:
            if scheme == "file":
                self._open[scheme, authority] = (fs.LocalFileSystem(), "")
            else:
                root = f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{authority}/"
                system, base = fs.FileSystem.from_uri(root)
                self._open[scheme, authority] = (system, base.rstrip("/"))
        system, base = self._open[scheme, authority]
        return system, base + inner

    def entries(self, folder: str) -> list[tuple[str, int | None]]:
        """Full paths directly in a folder, with sizes; folders have none."""
        scheme, authority, _ = split_path(folder)
        system, inner = self.at(folder)
        prefix = {"file": "file:", "hdfs": f"hdfs://{authority}"}.get(scheme, f"{scheme}://")
        found = system.get_file_info(fs.FileSelector(inner))
        return [
            (prefix + f.path, None if f.type == fs.FileType.Directory else f.size) for f in found
        ]

    def open(self, path: str):
        system, inner = self.at(path)
        return system.open_input_file(inner)

    def read(self, path: str) -> bytes:
        with self.open(path) as f:
            return f.read()

    def read_range(self, handle, offset: int, size: int) -> bytes:
        handle.seek(offset)
        return handle.read(size)

    def start(self, path: str):
        """A writer beside ``path``; :meth:`finish` gives the file its name."""
        system, inner = self.at(path)
        folder, _, name = inner.rpartition("/")
        system.create_dir(folder, recursive=True)
        part = f"{folder}/{UNFINISHED}{uuid.uuid4().hex[:8]}-{name}"
        return system.open_output_stream(part), part

    def finish(self, path: str, part: str) -> None:
        """Rename a closed part.  A repeated task replaces the same bytes."""
        system, inner = self.at(path)
        system.move(part, inner)

    def write(self, path: str, data: bytes) -> None:
        out, part = self.start(path)
        with out:
            out.write(data)
        self.finish(path, part)
