"""How much each provider's sessions yield, and which providers stand out."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def medians(frame: DataFrame, key: str, values: list[str]) -> DataFrame:
    """(key, <value>_median): exact medians of each key, null values left out.

    Values are counted first, map-side too; the median is then picked from the counts, so a key brings as many rows to its
    window as it has different values, never its rows."""
    long = F.explode(F.array(*[F.struct(F.lit(v).alias("name"), F.col(v).cast("double").alias("value")) for v in values])).alias("x")
    counts = frame.select(key, long).select(key, "x.name", "x.value").where("value is not null").groupBy(key, "name", "value").agg(F.count("*").alias("n"))
    by = Window.partitionBy(key, "name")
    upto = F.sum("n").over(by.orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    x = counts.withColumns({"upto": upto, "all": F.sum("n").over(by)})
    lower, upper = F.min(F.when(2 * F.col("upto") >= F.col("all"), F.col("value"))), F.min(F.when(2 * F.col("upto") > F.col("all"), F.col("value")))
    mid = x.groupBy(key, "name").agg(((lower + upper) / 2).alias("m"))
    return mid.groupBy(key).agg(*[F.max(F.when(F.col("name") == v, F.col("m"))).alias(f"{v}_median") for v in values])


def per_provider(sessions: DataFrame, counts: list[str], turns: str = "turns") -> DataFrame:
    """Of session rows (provider, turns, one column a kind of object): sessions, average turns, and per kind median, mean
    and total."""
    aggs = [F.count("*").alias("sessions"), F.round(F.avg(turns), 1).alias("avg_turns")]
    for c in counts:
        aggs += [F.round(F.avg(c), 2).alias(f"{c}_mean"), F.sum(c).alias(f"{c}_total")]
    per = sessions.groupBy("provider").agg(*aggs)
    mid = medians(sessions, "provider", counts).withColumnRenamed("provider", "_p")
    return per.join(mid, F.col("provider").eqNullSafe(F.col("_p")), "left").select("provider", "sessions", "avg_turns", *[f"{c}_{x}" for c in counts for x in ("median", "mean", "total")])


def skew(metrics: DataFrame, metric: str, over: float = 2.0, under: float = 0.5) -> DataFrame:
    """Each provider's value against the median of all providers' (the frame has a row a provider)."""
    mid = metrics.agg(F.median(metric).alias("mid"))
    x = metrics.select("provider", F.col(metric).alias("value")).crossJoin(F.broadcast(mid))  # one row by construction
    ratio = F.coalesce(F.try_divide("value", "mid"), F.lit(0.0))
    verdict = F.when(ratio >= over, "over-extracting (noise risk)").when((ratio <= under) & (F.col("value") > 0), "under-extracting (sparse)").otherwise("in-range")
    return x.select("provider", F.round("value", 2).alias("value"), F.round(ratio, 2).alias("ratio"), verdict.alias("verdict"))


def session_counts(events: DataFrame) -> DataFrame:
    """Session rows of a bare event log: a turn an event, and events of the kinds that stand for objects."""
    return events.groupBy("provider", "session_id").agg(F.count("*").alias("turns"), F.count("*").alias("mentions"), F.count_if(F.col("mention_type").startswith("concern")).alias("concerns"), F.count_if(F.col("target_type") == "Decision").alias("decisions"))
