"""Session construction: UTC, adaptive execution, shuffle sizing left to the caller."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(app: str = "threadloom", master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on (UTC, AQE); other settings stay the cluster's own."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()
