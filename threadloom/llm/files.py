"""Files of our own formats in a folder that driver and executors share, by whatever file system its URI names."""

from __future__ import annotations

import uuid

from pyarrow import fs


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI (file://, hdfs://, s3://, ... or a plain path) and the path on it."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


def write_whole(uri: str, parts) -> int:
    """Write the byte strings to a file that appears complete or not at all; a task that runs again replaces it."""
    at, path = open_fs(uri)
    at.create_dir(path.rpartition("/")[0], recursive=True)
    temporary = f"{path}.{uuid.uuid4().hex}.tmp"
    size = 0
    with at.open_output_stream(temporary, compression=None) as out:
        for part in parts:
            out.write(part)
            size += len(part)
    at.move(temporary, path)
    return size


def names(uri: str, suffix: str) -> list[tuple[str, int]]:
    """(URI, size) of the folder's files with the suffix, by name; none for a folder that isn't there."""
    at, path = open_fs(uri)
    found = at.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return [(f"{uri.rstrip('/')}/{f.base_name}", f.size) for f in sorted(found, key=lambda f: f.base_name) if f.type == fs.FileType.File and f.base_name.endswith(suffix)]
