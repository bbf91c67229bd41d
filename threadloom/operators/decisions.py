"""Queries over decisions: seq, ts_raw, ts, session_id, provider, status, proposition, related_entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordering import first_per_key

#: Statuses by meaning.
OPEN = ["tentative", "proposed", "pending", "queued", "trial", "assess", "hold", "planned", "initiated"]
RESOLVED = ["locked", "implemented", "executed", "completed", "accepted"]
REVERSED = ["reverted", "overturned"]


def per_entity(decisions: DataFrame) -> DataFrame:
    """A row a decision and entity it relates to, lower-case, blanks left out."""
    e = decisions.select("seq", "ts_raw", "session_id", "provider", F.lower("status").alias("status"), "proposition", F.explode("related_entities").alias("entity"))
    return e.withColumn("entity", F.lower("entity")).where("entity <> ''")


def load_bearing(decisions: DataFrame, least: int = 3, examples: int = 3) -> DataFrame:
    """Entities that anchor decisions: distinct sessions, anchors, providers, the first propositions, and whether they bear
    load (decisions in at least `least` sessions). Propositions come from a bounded number a map task."""
    e = per_entity(decisions)
    per = e.groupBy("entity").agg(F.count_distinct("session_id").alias("sessions"), F.count("*").alias("anchors"), F.array_join(F.array_sort(F.collect_set("provider")), ",").alias("providers"))
    few = first_per_key(e.select("entity", "seq", "proposition"), ["entity"], [F.col("seq")], examples).where("proposition <> ''")
    few = few.groupBy("entity").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "proposition"))), lambda x: x["proposition"]), "|").alias("sample_propositions"))
    per = per.join(few, "entity", "left")
    return per.select("entity", "sessions", "anchors", "providers", F.coalesce("sample_propositions", F.lit("")).alias("sample_propositions"), (F.col("sessions") >= least).alias("load_bearing"))


def newest_last(frame: DataFrame, limit: int) -> DataFrame:
    """The latest `limit` rows in time, in ascending order; 0 keeps all."""
    if not limit:
        return frame.orderBy("ts_raw", "seq")
    return frame.orderBy(F.col("ts_raw").desc(), F.col("seq").desc()).limit(limit).orderBy("ts_raw", "seq")


def open_items(decisions: DataFrame, limit: int = 30) -> DataFrame:
    return newest_last(decisions.where(F.lower("status").isin(OPEN)), limit)


def history(decisions: DataFrame, target: str, limit: int = 50) -> DataFrame:
    """Decisions that relate to the target or name it in their proposition."""
    t = target.lower()
    hit = F.exists("related_entities", lambda x: F.lower(x) == t) | F.lower("proposition").contains(t)
    return newest_last(decisions.where(hit), limit)


def supersession(decisions: DataFrame, least: int = 2) -> DataFrame:
    """Entities with at least two decisions of which one was reversed: links (all decisions, in time) and flips (reversals
    that directly follow a resolved one)."""
    e = per_entity(decisions)
    order = Window.partitionBy("entity").orderBy("ts_raw", "seq")
    e = e.withColumn("before", F.lag("status").over(order))
    reverse = F.col("status").isin(REVERSED)
    per = e.groupBy("entity").agg(F.count("*").alias("links"), F.count_if(reverse).alias("reversed"), F.count_if(reverse & F.col("before").isin(RESOLVED)).alias("flips"))
    return per.where((F.col("links") >= least) & (F.col("reversed") > 0))


def chain(decisions: DataFrame, entity: str) -> DataFrame:
    """The decisions of one entity in time, propositions cut at 160 characters."""
    e = per_entity(decisions).where(F.col("entity") == entity.lower())
    return e.select("ts_raw", "seq", "session_id", "provider", "status", F.substring("proposition", 1, 160).alias("proposition")).orderBy("ts_raw", "seq")
