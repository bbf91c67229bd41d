"""The event log on disk: months as partitions, an index of positions, appends and exports."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import month, parse_time
from ..sources.lines import lines, offsets
from .ordering import numbered

#: Columns of a log record, in order.
RECORD = ["ts", "session_id", "provider", "target_id", "target_type", "mention_type", "authorship", "valence", "evidence_quote", "mentioned_as"]
SCHEMA = ", ".join(f"{c} string" for c in RECORD) + ", project string, ym string"


def records(events: DataFrame, project: str | None = None) -> DataFrame:
    """Log records of events: strings, evidence cut at 400 characters, and their month."""
    have = set(events.columns)
    ts = F.coalesce("ts_raw", F.lit("")) if "ts_raw" in have else F.col("ts").cast("string")
    cols = {c: (F.col(c) if c in have else F.lit(None)).cast("string") for c in RECORD if c != "ts"}
    cols["evidence_quote"] = F.substring(cols["evidence_quote"], 1, 400)
    seq = F.col("seq") if "seq" in have else F.lit(0)
    return events.select(ts.alias("ts"), *[c.alias(n) for n, c in cols.items()], F.lit(project).cast("string").alias("project"), month(ts).alias("ym"), seq.alias("seq"))


def by_month(events: DataFrame) -> DataFrame:
    """Events a month, with sessions and targets."""
    return events.groupBy(month(F.col("ts_raw")).alias("ym")).agg(F.count("*").alias("events"), F.count_distinct("session_id").alias("sessions"), F.count_distinct("target_id").alias("targets"))


def write_months(events: DataFrame, path: str, project: str | None = None, files: int | None = None) -> None:
    """Rebuild the log: a folder a month, records sorted by time and session. A month is cut into `files` ranges of time, so
    a hot month is many tasks' work; by default the session's shuffle partitions."""
    n = files or int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    r = records(events, project).repartitionByRange(n, "ym", "ts", "session_id").sortWithinPartitions("ym", "ts", "session_id", "seq").drop("seq")
    r.write.partitionBy("ym").mode("overwrite").json(path)


def append(events: DataFrame, path: str, project: str | None = None, now: Column | None = None) -> None:
    """Append records of sessions that the log does not have yet; running it again adds nothing. Events without a time go to
    the month of `now`, by default the current one."""
    spark = events.sparkSession
    r = records(events, project).drop("seq")
    r = r.withColumn("ym", F.when(F.col("ts") == "", F.date_format(F.current_timestamp() if now is None else now, "yyyy-MM")).otherwise(F.col("ym")))
    try:
        have = read_log(spark, path).select("session_id").distinct()
        r = r.join(have, "session_id", "left_anti").select(*[c for c in r.columns])
    except Exception as e:  # no log yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
    r.write.partitionBy("ym").mode("append").json(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Records of the log; lines that aren't JSON are dropped, months prune by ym."""
    return spark.read.schema(SCHEMA).option("mode", "DROPMALFORMED").json(path).where("target_id is not null")


def index(events: DataFrame) -> DataFrame:
    """(target_id, refs): where in a log kept as one file a month each target is: time, file and line in the month's order.
    The log that write_months writes has several files a month; file_index() names those.

    Lines come from one range sort of all events, less the first place of their month, so no day or month is one task's;
    events without a time are the month `unknown`."""
    e = events.select("target_id", F.coalesce("ts_raw", F.lit("")).alias("ts"), "session_id", "seq", month(F.col("ts_raw")).alias("ym"))
    x = numbered(e, [F.col("ym"), F.col("ts"), F.col("session_id"), F.col("seq")], "at", 0)
    first = x.groupBy("ym").agg(F.min("at").alias("first"))  # a row a month
    lined = x.join(F.broadcast(first), "ym").select("target_id", F.struct("ts", F.concat("ym", F.lit(".jsonl")).alias("file"), (F.col("at") - F.col("first")).alias("line")).alias("ref"))
    return lined.groupBy("target_id").agg(F.array_sort(F.collect_list("ref")).alias("refs"))


def placed(spark: SparkSession, path: str) -> DataFrame:
    """Records of the log with the place of their line: file (below the log's folder), offset and length in bytes."""
    x = offsets(lines(spark, path, "*.json")).withColumn("r", F.from_json("line", SCHEMA))
    x = x.where("r.target_id is not null").select(F.regexp_extract("path", r"([^/]+/[^/]+)$", 1).alias("file"), "offset", "length", "r.*")
    return x.withColumn("ym", F.regexp_extract("file", r"^ym=([^/]+)/", 1))


def file_index(spark: SparkSession, path: str) -> DataFrame:
    """(target_id, refs): time, file, byte offset and length of each of a target's lines, in the order of time and place."""
    ref = F.struct("ts", "file", "offset", "length")
    return placed(spark, path).groupBy("target_id").agg(F.array_sort(F.collect_list(ref)).alias("refs"))


def read_refs(spark: SparkSession, path: str, refs: DataFrame) -> DataFrame:
    """The records at rows (file, offset, length): only the files that they name are opened, and only those bytes read.

    Rows meet by file, in the order of their offsets, so that a task reads a file forwards. The folder must be reachable
    from executors."""
    wanted = refs.select(F.concat(F.lit(path.rstrip("/") + "/"), "file").alias("file"), "offset", "length")
    wanted = wanted.repartition("file").sortWithinPartitions("file", "offset")
    got = wanted.mapInPandas(_read_at, "file string, offset long, line string")
    x = got.select(F.regexp_extract("file", r"([^/]+/[^/]+)$", 1).alias("file"), "offset", F.from_json("line", SCHEMA).alias("r")).select("file", "offset", "r.*")
    return x.withColumn("ym", F.regexp_extract("file", r"^ym=([^/]+)/", 1))


def _read_at(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import re

    from pyarrow import fs

    held, name = None, None
    for b in batches:
        texts = []
        for file, offset, length in zip(b["file"], b["offset"], b["length"], strict=True):
            if file != name:
                plain = re.sub(r"^file:/+", "/", file)
                system, place = fs.FileSystem.from_uri(plain) if ":/" in plain else (fs.LocalFileSystem(), plain)
                held, name = system.open_input_file(place), file
            held.seek(offset)
            texts.append(held.read(length).decode())
        yield pd.DataFrame({"file": b["file"], "offset": b["offset"], "line": texts})


def logged_events(spark: SparkSession, path: str) -> DataFrame:
    """The log as mention events again: seq is the line's time and place, ts_raw the time as written, ts parsed."""
    x = placed(spark, path)
    return x.withColumns({"seq": F.struct("ts", "file", "offset"), "ts_raw": F.col("ts"), "ts": parse_time(F.col("ts"))}).drop("file", "offset", "length")


def meta(events: DataFrame) -> DataFrame:
    return events.agg(F.count_distinct("session_id").alias("sessions_read"), F.count("*").alias("events_total"), F.count_distinct("target_id").alias("distinct_targets"), F.count_distinct(month(F.col("ts_raw"))).alias("months"), F.max_by("session_id", F.struct("ts_raw", "seq")).alias("last_session"))


def commits(events: DataFrame) -> DataFrame:
    """A commit-shaped row a session with a target: date, targets sorted, in (date, session) order by sort."""
    e = events.where("target_id <> ''")
    return e.groupBy("session_id").agg(F.substring(F.min("ts_raw"), 1, 10).alias("date"), F.array_sort(F.collect_set("target_id")).alias("files"))
