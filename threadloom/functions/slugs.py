"""Canonical names: normalisation as one expression, aliases as a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import strip

#: Endings that say nothing about the name, and the form of a trailing version.
FILLERS = ["-bridge", "-core", "-mcp", "-service", "-svc", "-daemon", "-server"]
VERSION = r"[-_ ]v?\d+(?:[._-]\d+)*"


def normalise(name: Column, fillers: list[str] = FILLERS) -> Column:
    """Trimmed, lower case, blanks as hyphens; trailing versions and fillers go while two characters stay before them, then
    the word "the", doubled separators and separators at the ends. One pattern takes all endings of a name, however many."""
    s = F.regexp_replace(F.lower(strip(name)), r"(?U)\s+", "-")
    s = F.regexp_replace(s, rf"(?:{VERSION}|(?<=..)(?:{'|'.join(fillers)}))++$", "")
    s = F.regexp_replace(s, r"(^|[-_ ])the([-_ ]|$)", "$1$2")
    s = F.regexp_replace(s, r"[-_]{2,}", "-")
    return F.regexp_replace(s, r"^[-_]+|[-_]+$", "")


def alias_table(spark: SparkSession, aliases: dict[str, str | list[str] | None]) -> DataFrame:
    """(alias, canonical) of a mapping canonical -> alias or aliases, both sides normalised; a canonical name stands for itself.
    Where a name is told twice the later line holds; empty names are left out."""
    rows = [(str(a), str(c)) for c, given in aliases.items() for a in [c, *([given] if isinstance(given, str) else given or [])]]
    t = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "at long, alias string, canonical string")
    t = t.select("at", normalise(F.col("alias")).alias("alias"), normalise(F.col("canonical")).alias("canonical")).where("alias <> '' and canonical <> ''")
    return t.groupBy("alias").agg(F.max_by("canonical", "at").alias("canonical"))


def load_aliases(spark: SparkSession, path: str) -> DataFrame:
    """The alias table of a YAML file (canonical: alias or list of aliases)."""
    import yaml

    text = "\n".join(r["value"] for r in spark.read.text(path).collect())  # a settings file
    return alias_table(spark, yaml.safe_load(text) or {})


def canonical(frame: DataFrame, column: str, aliases: DataFrame | None = None, out: str = "canonical") -> DataFrame:
    """frame with the canonical name of a column: normalised, then looked up. Catalyst broadcasts aliases if they are small."""
    x = frame.withColumn("_norm", normalise(F.col(column)))
    if aliases is None:
        return x.withColumnRenamed("_norm", out)
    a = aliases.select(F.col("alias").alias("_alias"), F.col("canonical").alias("_canonical"))
    return x.join(a, F.col("_norm") == F.col("_alias"), "left").withColumn(out, F.coalesce("_canonical", "_norm")).drop("_alias", "_canonical", "_norm")


def canonical_events(events: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Events with target_id made canonical; the name as written goes to mentioned_as where it changes and none is set."""
    x = canonical(events, "target_id", aliases, "_new")
    kept = F.coalesce("mentioned_as", F.when(F.col("_new") != F.col("target_id"), F.col("target_id"))) if "mentioned_as" in events.columns else F.when(F.col("_new") != F.col("target_id"), F.col("target_id"))
    return x.withColumn("mentioned_as", kept).withColumn("target_id", F.coalesce("_new", "target_id")).drop("_new")


def canonical_objects(frame: DataFrame, aliases: DataFrame | None = None, key: str = "seq") -> DataFrame:
    """Decisions, artifacts or open items of sessions with target_id and related_entities made canonical, where they have
    them; the name as written goes to mentioned_as where it changes. Lists keep their order. `key` tells rows apart."""
    x = canonical_events(frame, aliases) if "target_id" in frame.columns else frame
    if "related_entities" not in frame.columns:
        return x
    each = canonical(frame.select(F.col(key).alias("_key"), F.posexplode("related_entities").alias("_pos", "_name")), "_name", aliases, "_new")
    lists = each.groupBy("_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("_pos", F.coalesce("_new", "_name").alias("n")))), lambda e: e["n"]).alias("_list"))
    x = x.join(lists, F.col(key) == F.col("_key"), "left")
    return x.withColumn("related_entities", F.coalesce("_list", "related_entities")).drop("_key", "_list")
