"""What the operators share: the cluster's shared folder, staged tables, row keys and global running totals."""

from __future__ import annotations

import contextlib
import gc
import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The upper- and lower-case ASCII letters, for lower-casing A-Z only.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Unset, a temporary one in local mode only."""
    conf = spark.sparkContext.getConf()
    if at := conf.get("spark.checkpoint.dir"):
        return at.rstrip("/")
    if (at := spark.sparkContext.getCheckpointDir()) is not None:
        return at.rstrip("/")
    if not conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="threadloom-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


#: The folder of a staged table in the path of one of its files.
STAGED = re.compile(r".*-[0-9a-f]{32}(?=/)")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, compression: str = "snappy", by: str | None = None) -> DataFrame:
    """Write df once as Parquet in the shared folder and read it back: cuts lineage, survives lost executors. A column `by`
    of few values makes a folder of each, so that filters on it read no other."""
    spark = df.sparkSession
    df.write.parquet(path := new_path(spark, name), compression=compression, partitionBy=by)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def large_rows(spark: SparkSession) -> Iterator[None]:
    """For actions over rows of megabytes: the Parquet reader and the Arrow channel take few of them at once. The session's
    settings are put back afterwards."""
    few = {"spark.sql.parquet.columnarReaderBatchSize": "8", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}
    before = {k: spark.conf.get(k) for k in few}
    try:
        for k, v in few.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def few_texts(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in slices of some rows, for workers that take texts apart; what Arrow no longer needs goes back at the end
    of each batch, so an idle worker holds little."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
        del b
        pa.default_memory_pool().release_unused()


def unstage(*frames: DataFrame) -> None:
    """Delete the files of staged frames that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        for root in {m[0] for f in df.inputFiles() if (m := STAGED.match(f))}:
            path = spark._jvm.org.apache.hadoop.fs.Path(root)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of frames that are out of scope; it does so as the driver collects its garbage."""
    gc.collect()
    spark._jvm.System.gc()


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else; the built-in lower() serves texts of ASCII alone."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A digest of id and text. With doc_id it stands for the row: rows equal in both are the same to every operator."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def free(frame: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes to be none of frame's columns, in any case."""
    have = {c.lower() for c in frame.columns}
    out = []
    for n in names:
        while n.lower() in have:
            n = "_" + n
        out.append(n)
    return out


def same_row(a: DataFrame, b: DataFrame, *keys: str) -> Column:
    """Null-safe equality on the keys."""
    out = F.lit(True)
    for k in keys:
        out = out & a[k].eqNullSafe(b[k])
    return out


#: A key is hot with over BLOCK rows that are also over one in SHARE of all, so there are fewer than SHARE hot keys.
BLOCK, SHARE = 20_000, 1000


def hot_keys(rows: DataFrame, on: list[str], block: int, counts: DataFrame | None = None) -> DataFrame | None:
    """(on, blocks): the hot keys of rows and the blocks each is to be dealt in; none if there is no hot key. Counted with
    map-side combination, unless counts (on, n) are given; there are fewer than SHARE, so the frame may be broadcast."""
    counts = rows.groupBy(*on).agg(F.count("*").alias("n")) if counts is None else counts
    counts = stage(counts.where(F.col("n") > block), "counts")
    if counts.isEmpty():
        return None
    total = rows.count()
    hot = counts.where(F.col("n") > total / SHARE).select(*on, F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    return None if hot.isEmpty() else hot


def spread_join(many: DataFrame, few: DataFrame, on: list[str], deal: list[str], block: int | None = None, counts: DataFrame | None = None) -> DataFrame:
    """The inner join of many with few, whose rows a key are few. Rows of hot keys of many are dealt over blocks by the hash
    of `deal`, and the rows of few for such a key are given to every block, so no key meets in one task."""
    hot = hot_keys(many, on, block or BLOCK, counts)
    if hot is None:
        return many.join(few, on)
    dealt = many.join(F.broadcast(hot), on, "left").withColumn("_block", F.coalesce(F.pmod(F.xxhash64(*deal), F.col("blocks")).cast("int"), F.lit(0))).drop("blocks")
    given = few.join(F.broadcast(hot), on, "left").withColumn("_block", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))).drop("blocks")
    return dealt.join(given, [*on, "_block"]).drop("_block")


def running_total(df: DataFrame, order: list[Column], value: str, name: str) -> DataFrame:
    """df staged in global order, with `rank` (from 0) and `before` (the sum of value over all earlier rows).

    A range sort, then one row a partition for the offsets: no task sees more than its own range, and the frame
    of offsets has as many rows as there are partitions."""
    part = F.shiftright(F.col("_at"), 33)
    x = stage(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), name).withColumn("_part", part)
    totals = x.groupBy("_part").agg(F.count("*").alias("_n"), F.sum(value).alias("_sum"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_rows"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    x = x.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    x = x.join(offsets, "_part")
    rank = F.col("_rows") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return x.select(*df.columns, rank.alias("rank"), (F.col("_base") + F.col("_in")).alias("before"))
