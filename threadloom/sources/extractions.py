"""Per-session extraction documents as typed frames: events, decisions, and the other kinds of object."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import parse_time

#: Files that are no sessions, kinds of object and the fields read of each.
SKIPPED = ["global_profile.json", "manifest.json", "_meta.json", "state.json"]
FIELDS = {
    "decisions": ["proposition", "decision", "text", "status", "why", "decided_by", "target_id"], "drifts": ["proposed", "corrected_to", "trigger", "trigger_detail", "rule_generated"], "rules": ["rule_text", "applies_to", "level"],
    "mental_moves": ["move", "owner", "level", "evidence"], "stances": ["proposition", "stance", "target", "reason"], "affect": ["marker", "valence", "owner", "trigger", "implication"],
    "meta_moments": ["observation"], "artifacts": ["path", "purpose", "status", "target_id"], "unresolved": ["text", "target_id", "status"],
}


def scan(spark: SparkSession, paths: list[str], providers: list[str] | None = None) -> DataFrame:
    """(file_ord, path, session_id, provider, v): each session document once: files by name of the session, the first path
    wins; files that are no JSON objects, profiles, logs and hidden folders are skipped. Providers prune by folder.

    Spark's driver lists the files and holds the list; millions of documents belong in bundles (scan_bundles)."""
    t = spark.read.option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true").text(paths, wholetext=True)
    return _sessions(t.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("mtime"), "value"), providers)


def scan_bundles(spark: SparkSession, paths: list[str], providers: list[str] | None = None) -> DataFrame:
    """scan() of documents that lie in bundles (writing.write_bundle), each under the path that it would have as a file."""
    t = spark.read.schema("path string, text string").parquet(*paths).where("path like '%.json'")
    path = F.concat(F.regexp_extract(F.col("_metadata.file_path"), r"^(.*/)[^/]+$", 1), "path")
    return _sessions(t.select(path.alias("path"), F.col("_metadata.file_modification_time").alias("mtime"), F.col("text").alias("value")), providers)


def _sessions(t: DataFrame, providers: list[str] | None) -> DataFrame:
    """scan() of texts (path, mtime, value)."""
    name, folder = F.regexp_extract("path", r"([^/]+)$", 1), F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    t = t.where(~name.isin(SKIPPED) & ~F.col("path").rlike(r"/[_.][^/]*/[^/]+$") & ~name.startswith("_"))
    if providers is not None:
        t = t.where(folder.isin(providers))
    t = t.withColumn("v", F.try_parse_json("value")).where(F.schema_of_variant("v").startswith("OBJECT")).drop("value")
    first = F.row_number().over(Window.partitionBy(name).orderBy("path"))
    t = t.withColumn("_r", first).where("_r = 1").drop("_r")
    sid = F.coalesce(F.nullif(F.try_variant_get("v", "$.session_id", "string"), F.lit("")), F.regexp_replace(name, r"\.json$", ""))
    return t.select("path", "mtime", sid.alias("session_id"), F.coalesce(F.nullif(F.try_variant_get("v", "$.provider", "string"), F.lit("")), folder).alias("provider"), "v")


def _objects(docs: DataFrame, kind: str) -> DataFrame:
    a = F.try_variant_get("v", f"$.{kind}", "array<variant>")
    return docs.select("path", "mtime", "session_id", "provider", F.col("v").alias("doc"), F.posexplode(a).alias("pos", "e")).where(F.schema_of_variant("e").startswith("OBJECT"))


def _order() -> Column:
    """A total order by path and place, as one string."""
    return F.concat("path", F.lit("#"), F.lpad(F.col("pos").cast("string"), 8, "0"))


def fallback_time(raw: Column) -> Column:
    """The event's time, else the session's start or end, else an id that is epoch milliseconds, else the file's time."""
    meta = [F.nullif(F.try_variant_get("doc", f"$.session_meta.{k}", "string"), F.lit("")) for k in ("timestamp_start", "started_at", "ts", "timestamp_end")]
    epoch = F.when(F.col("session_id").rlike(r"^\d{13,}$"), F.date_format(F.timestamp_millis(F.substring("session_id", 1, 13).try_cast("long")), "yyyy-MM-dd'T'HH:mm:ss"))
    return F.coalesce(F.nullif(raw, F.lit("")), *meta, epoch, F.date_format("mtime", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(""))


def mention_events(docs: DataFrame) -> DataFrame:
    """The log of mention events, in the model's columns; seq orders by file and place."""
    e = _objects(docs, "mention_events")
    s = lambda k: F.try_variant_get("e", f"$.{k}", "string")
    raw = fallback_time(s("timestamp"))
    return e.select(
        _order().alias("seq"), raw.alias("ts_raw"), parse_time(raw).alias("ts"), "session_id", "provider", s("target_id").alias("target_id"), F.coalesce(F.nullif(s("target_type"), F.lit("")), F.lit("?")).alias("target_type"),
        F.coalesce(s("mention_type"), F.lit("?")).alias("mention_type"), F.coalesce(s("valence"), F.lit("?")).alias("valence"), F.coalesce(s("authorship"), F.lit("?")).alias("authorship"), F.substring(s("evidence_quote"), 1, 200).alias("evidence_quote"), s("mentioned_as").alias("mentioned_as"),
    ).where("target_id <> ''")


def objects(docs: DataFrame, kind: str) -> DataFrame:
    """A row an object of a kind, its fields as strings."""
    e = _objects(docs, kind)
    return e.select(_order().alias("seq"), fallback_time(F.lit("")).alias("ts_raw"), "session_id", "provider", *[F.try_variant_get("e", f"$.{f}", "string").alias(f) for f in FIELDS[kind]])


def decisions(docs: DataFrame) -> DataFrame:
    e = _objects(docs, "decisions")
    s = lambda k: F.try_variant_get("e", f"$.{k}", "string")
    raw = fallback_time(F.lit(""))
    related = F.filter(F.transform(F.try_variant_get("e", "$.related_entities", "array<variant>"), lambda v: v.try_cast("string")), lambda x: x.isNotNull() & (x != ""))
    return e.select(_order().alias("seq"), raw.alias("ts_raw"), parse_time(raw).alias("ts"), "session_id", "provider", s("status").alias("status"), F.coalesce(s("proposition"), s("decision"), s("text"), F.lit("")).alias("proposition"), s("why").alias("why"), s("target_id").alias("target_id"), F.coalesce(related, F.array().cast("array<string>")).alias("related_entities"))


def session_time() -> Column:
    """A session's time: the least `ts` of its events, else when its meta says it started, else empty. Of rows with doc."""
    events = F.transform(F.try_variant_get("doc", "$.mention_events", "array<variant>"), lambda e: F.nullif(F.try_variant_get(e, "$.ts", "string"), F.lit("")))
    meta = [F.nullif(F.try_variant_get("doc", f"$.session_meta.{k}", "string"), F.lit("")) for k in ("started_at", "ts")]
    return F.coalesce(F.array_min(events), *meta, F.lit(""))


def unresolved(docs: DataFrame, limit: int | None = None) -> DataFrame:
    """(ts, seq, session_id, provider, text, target_id, status, concern): concerns that sessions left open, in the order of
    their sessions' times; items that are no objects are dropped, concern is the whole item as JSON."""
    e = _objects(docs, "unresolved")
    out = e.select(session_time().alias("ts"), _order().alias("seq"), "session_id", "provider", *[F.try_variant_get("e", f"$.{f}", "string").alias(f) for f in FIELDS["unresolved"]], F.to_json("e").alias("concern"))
    out = out.orderBy("ts", "seq")
    return out if limit is None else out.limit(limit)


def session_counts(docs: DataFrame) -> DataFrame:
    """(provider, session_id, turns, one column a kind): how much each extraction holds."""
    size = lambda k: F.coalesce(F.size(F.try_variant_get("v", f"$.{k}", "array<variant>")), F.lit(0))
    turns = F.coalesce(F.nullif(F.try_variant_get("v", "$.session_meta.turn_count", "int"), F.lit(0)), F.greatest(size("mention_events"), F.lit(0)))
    return docs.select("provider", "session_id", turns.alias("turns"), *[F.greatest(size(k), F.lit(0)).alias(k) for k in ("mention_events", "decisions", "drifts", "rules", "mental_moves", "stances", "unresolved")])
