"""Raw byte streams in the shared folder, opened inside tasks.

Spark has no writer for raw bytes, so archives and token files are written through
``pyarrow.fs`` (local and mounted paths, HDFS, S3, GCS). A task writes files under
names of its own attempt and returns them as rows; only files named in the manifest
that Spark commits are ever read, so an attempt that is lost leaves nothing behind but
an unread file.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``uri`` (a plain path is local) and the path in it."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def new_file(folder: str, suffix: str) -> tuple[str, object]:
    """(uri, output stream) of a file that no other attempt writes."""
    system, path = opened(folder)
    system.create_dir(path, recursive=True)
    name = f"part-{uuid.uuid4().hex}{suffix}"
    return f"{folder}/{name}", system.open_output_stream(f"{path}/{name}", compression=None)


def reader(uri: str):
    """A sequential input stream."""
    system, path = opened(uri)
    return system.open_input_stream(path, compression=None)


def random_reader(uri: str):
    """A seekable input file."""
    system, path = opened(uri)
    return system.open_input_file(path)
