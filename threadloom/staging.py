"""Tables written once in the folder that driver and executors share, so that later jobs read files and not a lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: The folder of a staged table in the path of one of its files.
STAGED = re.compile(r".*/staged-[0-9a-f]{32}(?=/)")


def scratch(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; unset, a temporary one in local mode only."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if at is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="threadloom-"))
        at = spark.sparkContext.getCheckpointDir()
    return at.rstrip("/")


def stage(frame: DataFrame) -> DataFrame:
    """The frame, written as Parquet and read back."""
    spark = frame.sparkSession
    frame.write.parquet(path := f"{scratch(spark)}/staged-{uuid.uuid4().hex}")
    return spark.read.schema(frame.schema).parquet(path)


def unstage(*frames: DataFrame) -> None:
    """Delete the files of staged frames that nothing reads any more."""
    for frame in frames:
        spark = frame.sparkSession
        for root in {m[0] for f in frame.inputFiles() if (m := STAGED.match(f))}:
            path = spark._jvm.org.apache.hadoop.fs.Path(root)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
