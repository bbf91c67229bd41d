"""Texts written as files of their own, from the tasks that hold them, or many to a file as a bundle."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_texts(frame: DataFrame, folder: str | None = None, path: str = "name", text: str = "text", suffix: str = "") -> DataFrame:
    """(path, bytes) of files written: each row's text under folder/path+suffix, or under its path where folder is None.

    Lazy: files are written when the result is acted on. A task writes a hidden name and moves it, so a task that is run
    again leaves the same files. The folder must be reachable from executors (a path that pyarrow's file systems know)."""
    target = F.col(path) if folder is None else F.concat(F.lit(folder.rstrip("/") + "/"), F.col(path), F.lit(suffix))
    return frame.select(target.alias("path"), F.col(text).alias("text")).where("path is not null and text is not null").mapInPandas(_write, "path string, bytes long")


def write_bundle(frame: DataFrame, folder: str, path: str = "name", text: str = "text", suffix: str = "") -> None:
    """Texts as a bundle, a Parquet table of (path, text): files by the task, not by the text, so that whoever reads millions
    of them lists a few. The path, with the suffix, is where a text would lie under the folder."""
    frame.select(F.concat(F.col(path), F.lit(suffix)).alias("path"), F.col(text).alias("text")).where("path is not null and text is not null").write.parquet(folder)


def _write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import posixpath
    import re
    import uuid

    from pyarrow import fs

    for b in batches:
        sizes = []
        for path, text in zip(b["path"], b["text"], strict=True):
            path = re.sub(r"^file:/+", "/", path)
            system, place = fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)
            system.create_dir(posixpath.dirname(place), recursive=True)
            hidden = posixpath.join(posixpath.dirname(place), f".{uuid.uuid4().hex}.tmp")
            data = text.encode()
            with system.open_output_stream(hidden) as out:
                out.write(data)
            system.move(hidden, place)
            sizes.append(len(data))
        yield pd.DataFrame({"path": b["path"], "bytes": pd.Series(sizes, dtype="int64")})
