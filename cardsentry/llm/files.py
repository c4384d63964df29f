"""Raw files in the shared folder, through ``pyarrow.fs`` (file, hdfs, s3, gs).

A file is written under a name of its own for each attempt and renamed at the
end, so a task that runs twice leaves one whole file under the final name.
"""
from __future__ import annotations

import contextlib
import uuid

from pyarrow import fs


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


@contextlib.contextmanager
def written(uri: str):
    """A binary stream; the file appears under ``uri`` when the block ends well."""
    store, path = open_fs(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex[:8]}.tmp"
    with store.open_output_stream(part, compression=None) as out:
        yield out
    store.move(part, path)


def listed(uri: str, suffix: str) -> list[tuple[str, int]]:
    """Names and sizes of the files of a folder, in order of their names."""
    store, path = open_fs(uri)
    if store.get_file_info(path).type == fs.FileType.NotFound:
        return []
    found = store.get_file_info(fs.FileSelector(path))
    return sorted((f.base_name, f.size) for f in found if f.base_name.endswith(suffix))
