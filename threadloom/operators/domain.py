"""Audit of a project's domain files: what is there, how complete, what is missing or stale."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Kinds of file and their weights; lines of a full file, days behind the newest of a stale one.
KINDS = {"viability_verdict": 0.30, "current_conditions": 0.20, "customer_personas": 0.15, "industry_map": 0.10, "open_questions": 0.10, "success_stories": 0.075, "failure_stories": 0.075}
FULL_LINES, STALE_DAYS = 8, 30


def load(spark: SparkSession, root: str) -> DataFrame:
    """(kind, path, length, modificationTime, content) of the Markdown files under a folder; the kind is the file's name."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", "*.md").option("recursiveFileLookup", "true").load(root)
    return f.select(F.lower(F.regexp_extract("path", r"([^/]+)\.md$", 1)).alias("kind"), "path", "length", "modificationTime", F.col("content").cast("string").alias("content"))


def inspect(files: DataFrame) -> DataFrame:
    """Lines, first-person voice in the first twenty, and a summary of at most 160 characters."""
    lines = F.filter(F.split("content", "\n"), lambda x: F.trim(x) != "")
    head = F.array_join(F.slice(F.split("content", "\n"), 1, 20), "\n")
    whole = F.size(F.split(F.regexp_replace("content", r"\n$", ""), "\n"))
    count = F.when(F.length("content") == 0, 0).otherwise(whole)
    prose = F.filter(lines, lambda x: ~x.rlike(r"^\s*(#|---|[-*]\s)"))
    return files.select("kind", "path", "length", "modificationTime", count.alias("lines"), head.rlike(r"(?i)\b(I|we|my|our)\b").alias("first_person"), F.substring(F.coalesce(F.get(prose, F.lit(0)), F.lit("")), 1, 160).alias("summary"))


def coverage(seen: DataFrame) -> DataFrame:
    """One row: the sum of the weights of kinds, a quarter of it for files of under eight lines; missing kinds."""
    spark = seen.sparkSession
    want = spark.createDataFrame(list(KINDS.items()), "kind string, weight double")
    x = want.join(seen.groupBy("kind").agg(F.max("lines").alias("lines")), "kind", "left")
    credit = F.when(F.col("lines") >= FULL_LINES, F.col("weight")).when(F.col("lines").isNotNull(), F.col("weight") / 4).otherwise(0.0)
    return x.agg(F.round(F.sum(credit), 4).alias("coverage"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("lines").isNull(), F.col("kind")))), ",").alias("missing"))


def gaps(seen: DataFrame) -> DataFrame:
    """(kind, gap, severity): missing files (the verdict's is a blocker), stubs of under eight lines, and files over thirty
    days behind the newest where there are two or more."""
    spark = seen.sparkSession
    want = spark.createDataFrame([(k,) for k in KINDS], "kind string")
    missing = want.join(seen, "kind", "left_anti").select("kind", F.lit("missing").alias("gap"), F.when(F.col("kind") == "viability_verdict", "blocker").otherwise("high").alias("severity"))
    stub = seen.where(F.col("lines") < FULL_LINES).select("kind", F.lit("stub").alias("gap"), F.lit("medium").alias("severity"))
    newest = F.max("modificationTime").over(Window.partitionBy())  # a handful of files
    n = F.count("*").over(Window.partitionBy())
    old = (n >= 2) & (F.unix_timestamp(newest) - F.unix_timestamp("modificationTime") > 86_400 * STALE_DAYS)
    stale = seen.withColumn("_old", old).where("_old").select("kind", F.lit("stale").alias("gap"), F.lit("low").alias("severity"))
    return missing.unionByName(stub).unionByName(stale)
