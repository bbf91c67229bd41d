"""Incremental profiles and windows over event streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def append_new(batch: DataFrame, state: str, key: str = "session_id") -> int:
    """Append the rows of sessions that the state table does not hold; how many rows that was. Running a batch again adds
    nothing, so a retried micro-batch is safe; changed sessions are not read again."""
    spark = batch.sparkSession
    try:
        have = spark.read.parquet(state).select(key).distinct()
        batch = batch.join(have, key, "left_anti").select(*batch.columns)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    n = batch.count()
    if n:
        batch.write.mode("append").parquet(state)
    return n


def follow(stream: DataFrame, state: str, checkpoint: str, derive: Callable[[DataFrame], None] | None = None, interval: str | None = None) -> StreamingQuery:
    """Append each micro-batch's new sessions to the state and derive anew from all of it; late sessions are simply new
    ones, so no watermark drops them. Without an interval what is there is taken and the query ends."""

    def each(batch: DataFrame, _: int) -> None:
        if append_new(batch, state) and derive is not None:
            derive(batch.sparkSession.read.parquet(state))

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=interval) if interval else w.trigger(availableNow=True)).start()


def tumbling(events: DataFrame, size: str = "1 day", watermark: str | None = None) -> DataFrame:
    """(start, events, targets): events and different targets of each window, exact in batch and in a stream alike (a stream
    keeps a window's targets as its state)."""
    e = events.withWatermark("ts", watermark) if watermark else events
    targets = F.size(F.collect_set("target_id")).cast("long") if events.isStreaming else F.count_distinct("target_id")
    return e.groupBy(F.window("ts", size)).agg(F.count("*").alias("events"), targets.alias("targets")).select(F.col("window.start").alias("start"), "events", "targets")


def sliding(events: DataFrame, size: str = "2 days", slide: str = "1 day", watermark: str | None = None) -> DataFrame:
    e = events.withWatermark("ts", watermark) if watermark else events
    return e.groupBy(F.window("ts", size, slide), "provider").agg(F.count("*").alias("events")).select(F.col("window.start").alias("start"), "provider", "events")


def sessions(events: DataFrame, gap: str = "30 days", key: str = "target_id", watermark: str | None = None) -> DataFrame:
    """Runs of events of a key that lie less than the gap apart."""
    e = events.withWatermark("ts", watermark) if watermark else events
    w = e.groupBy(key, F.session_window("ts", gap)).agg(F.count("*").alias("events"))
    return w.select(key, F.col("session_window.start").alias("start"), "events")


def incremental(spark: SparkSession, halves: list[DataFrame], state: str, op: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """op over a state that was appended half by half."""
    for h in halves:
        append_new(h, state)
    return op(spark.read.parquet(state))
