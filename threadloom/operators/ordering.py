"""Order over whole frames and hot keys: ranks, earlier values and first rows without a key or a frame in one task.

A frame is range-sorted and staged; each partition's rows then need only what lies at the partition's edge, which is one
row a partition."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import stage


def first_per_key(frame: DataFrame, keys: list[str], order: list[Column], most: int, rank: str = "r") -> DataFrame:
    """The first `most` rows of each key, with their rank. The filter stands on the window, so Spark limits every map task's
    rows of a key before they are shuffled (WindowGroupLimit): a key brings at most `most` rows a map task to its window."""
    ranked = frame.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(rank) <= most)


def sorted_parts(frame: DataFrame, order: list[Column]) -> DataFrame:
    """frame range-sorted and staged, with _part (its range) and _at (its place in the whole order)."""
    at = stage(frame.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    return at.withColumn("_part", F.shiftright("_at", 33))


def numbered(frame: DataFrame, order: list[Column], name: str = "rank", first: int = 1) -> DataFrame:
    """frame with its rows' place in the order, from `first` on; no window over more than a range."""
    x = sorted_parts(frame, order)
    per = x.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a partition
    x = x.join(F.broadcast(per.select("_part", before.alias("_before"))), "_part")
    return x.select(*frame.columns, (F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + first).alias(name))


def numbered_within(frame: DataFrame, keys: list[str], order: list[Column], name: str = "rank", first: int = 1) -> DataFrame:
    """frame with its rows' place within their key, from `first` on, and _part, their range. A key of any size is many ranges;
    what a range adds is told by a row a range and key."""
    x = sorted_parts(frame, [*[F.col(k) for k in keys], *order]).withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    per = x.groupBy("_part", *keys).agg(F.count("*").alias("_n"), F.min("_at").alias("_from"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a range
    per = per.select("_part", *keys, (before - F.col("_from") + first).alias("_add"))
    return same_place(x, per, keys).select(*frame.columns, "_part", (F.col("_at") + F.col("_add")).alias(name))


def same_place(rows: DataFrame, per: DataFrame, keys: list[str]) -> DataFrame:
    """rows with what a frame of a row a range and key says of theirs; null keys are equal."""
    p = per.withColumnsRenamed({"_part": "_p"} | {k: f"_k_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys), F.col("_part") == F.col("_p"))
    return rows.join(p, on).drop("_p", *[f"_k_{k}" for k in keys])


def with_previous(frame: DataFrame, keys: list[str], order: list[Column], values: list[str]) -> DataFrame:
    """frame with previous_<value>: each row's values in the row before it of its key, null for the key's first.

    Rows are sorted by key and order into ranges, so a hot key is many of them; the first row of a range finds its
    predecessor in the last row of the last range before it that has rows, if that is of the same key."""
    x = sorted_parts(frame, [*[F.col(k) for k in keys], *order])
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys))
    inside = Window.partitionBy("_part").orderBy("_at")
    last = x.groupBy("_part").agg(F.max_by(F.struct(*keys, *values), "_at").alias("_row"))
    edge = last.select(F.lead("_part").over(Window.orderBy("_part")).alias("_part"), F.col("_row").alias("_edge")).where("_part is not null")  # a row a partition
    x = x.withColumn("_row", F.lag(F.struct(*keys, *values)).over(inside)).join(F.broadcast(edge), "_part", "left")
    x = x.withColumn("_row", F.coalesce("_row", "_edge"))
    x = x.withColumns({f"_k_{k}": F.col(f"_row.{k}") for k in keys} | {"_there": F.col("_row").isNotNull()})
    kept = F.col("_there") & same
    return x.select(*frame.columns, *[F.when(kept, F.col(f"_row.{v}")).alias(f"previous_{v}") for v in values])
