"""Files of session folders as a stream, each once for every state that it has been in: format("session_files").

A Python data source whose offsets are (time of change, path): a batch is the files between two offsets, so a restart takes
none twice and a file that changes is taken again. Inputs whose output is newer than they are left out by an anti-join."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "path string, changed timestamp, size long, text string"


def listed(folder: str, suffix: str) -> list[tuple[int, str, int]]:
    """(time of change in microseconds, path, size) of the files below a folder, in that order; hidden ones aside."""
    import re

    from pyarrow import fs

    plain = re.sub(r"^file:/+", "/", folder)
    system, place = fs.FileSystem.from_uri(plain) if ":/" in plain else (fs.LocalFileSystem(), plain)
    prefix = plain[: -len(place)] if plain.endswith(place) else ""
    found = system.get_file_info(fs.FileSelector(place, recursive=True, allow_not_found=True))
    return sorted((f.mtime_ns // 1000, prefix + f.path, f.size) for f in found if f.is_file and f.path.endswith(suffix) and not f.base_name.startswith((".", "_")))


class Files(InputPartition):
    def __init__(self, files: list[tuple[int, str, int]]):
        self.files = files


def read_files(files: list[tuple[int, str, int]]) -> Iterator[tuple]:
    """Rows of files; one that is gone or was written meanwhile is left to the batch that its new state is in."""
    import datetime

    from pyarrow import fs

    for changed, path, size in files:
        system, place = fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)
        info = system.get_file_info(place)
        if not info.is_file or info.mtime_ns // 1000 != changed:
            continue
        with system.open_input_stream(place) as f:
            text = f.read().decode(errors="replace")
        yield path, datetime.datetime.fromtimestamp(changed / 1e6, datetime.UTC), size, text


def dealt(files: list[tuple[int, str, int]], most: int, bytes_: int) -> list[Files]:
    """Files in order, cut into partitions of at most so many files and about so many bytes."""
    out, held, size = [], [], 0
    for f in files:
        if held and (len(held) >= most or size + f[2] > bytes_):
            out.append(Files(held))
            held, size = [], 0
        held.append(f)
        size += f[2]
    return [*out, Files(held)] if held else out


class Stream(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.folder, self.suffix = options["path"], options.get("suffix", "")
        self.most, self.bytes_ = int(options.get("filesPerPartition", 1000)), int(options.get("bytesPerPartition", 64 << 20))
        self.settle = int(float(options.get("settleSeconds", 0)) * 1_000_000)

    def initialOffset(self) -> dict:
        return {"changed": -1, "path": ""}

    def latestOffset(self) -> dict:
        import time

        until = time.time_ns() // 1000 - self.settle
        files = [f for f in listed(self.folder, self.suffix) if f[0] <= until]
        return {"changed": files[-1][0], "path": files[-1][1]} if files else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Files]:
        after, upto = (start["changed"], start["path"]), (end["changed"], end["path"])
        return dealt([f for f in listed(self.folder, self.suffix) if after < f[:2] <= upto], self.most, self.bytes_)

    def read(self, partition: Files) -> Iterator[tuple]:
        return read_files(partition.files)

    def commit(self, end: dict) -> None:
        pass


class Batch(DataSourceReader):
    def __init__(self, stream: Stream):
        self.stream = stream

    def partitions(self) -> list[Files]:
        return dealt(listed(self.stream.folder, self.stream.suffix), self.stream.most, self.stream.bytes_) or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        return read_files(partition.files)


class SessionFiles(DataSource):
    """Options: path; suffix of file names; settleSeconds, in which a file must not have changed before a stream takes it (two
    files of one microsecond of which the second appears later need some); filesPerPartition, bytesPerPartition."""

    @classmethod
    def name(cls) -> str:
        return "session_files"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: object) -> Stream:
        return Stream(self.options)

    def reader(self, schema: object) -> Batch:
        return Batch(Stream(self.options))


def watch(spark: SparkSession, folder: str, suffix: str = "", **options: str) -> DataFrame:
    """A stream of (path, changed, size, text): every file below the folder, again whenever it has changed."""
    spark.dataSource.register(SessionFiles)
    return spark.readStream.format("session_files").options(path=folder, suffix=suffix, **options).load()


def files(spark: SparkSession, folder: str, suffix: str = "", **options: str) -> DataFrame:
    """The same files once, as a table."""
    spark.dataSource.register(SessionFiles)
    return spark.read.format("session_files").options(path=folder, suffix=suffix, **options).load()


def name_of(path: str = "path") -> Column:
    """A file's name without folders and ending."""
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]+)?$", 1)


def stale(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Inputs (path, changed, ...) without an output of the same name that is at least as new: an anti-join."""
    done = outputs.select(name_of().alias("_done"), F.col("changed").alias("_at")).groupBy("_done").agg(F.max("_at").alias("_at"))
    return inputs.join(done, (name_of() == F.col("_done")) & (F.col("_at") >= F.col("changed")), "left_anti")
