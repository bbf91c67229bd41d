"""Lines of text files, read in ranges: a file of any size is many tasks' work, and every line keeps its place.

Spark's own text source splits files at line breaks. A line's place is its file, the start of its split and its order
there; numbers and byte offsets follow from one sum a split, so no file is read or numbered in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PLACE = ["path", "block", "n"]


def lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, block, n, line) of each line under a path, blank ones too; n orders the lines of a block. Lines end at a line
    feed alone; a carriage return before it stays. Compressed files are not split."""
    r = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true")
    t = (r.option("pathGlobFilter", glob) if glob else r).text(path)
    return t.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"), F.col("value").alias("line"))


def running(frame: DataFrame, size: Column, name: str) -> DataFrame:
    """frame (path, block, n, ...) with the sum of size over all earlier rows of the file: inside a block by window, whose
    rows are bounded by the split size, and over the file's earlier blocks by one row a block."""
    sized = frame.withColumn("_size", size)
    per = sized.groupBy("path", "block").agg(F.sum("_size").alias("_sum"))
    ahead = F.coalesce(F.sum("_sum").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per = per.select("path", "block", ahead.alias("_ahead"))
    inside = F.coalesce(F.sum("_size").over(Window.partitionBy("path", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return sized.withColumn("_inside", inside).join(per, ["path", "block"]).select(*frame.columns, (F.col("_ahead") + F.col("_inside")).alias(name))


def offsets(frame: DataFrame) -> DataFrame:
    """lines() with offset and length, in bytes of the file, of each line without its line feed."""
    length = F.octet_length("line").cast("long")
    return running(frame, length + 1, "offset").withColumn("length", length)
