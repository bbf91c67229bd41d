"""Names made canonical in files as they lie: extraction documents and the nodes of a canvas."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.slugs import canonical
from .extractions import SKIPPED

#: Kinds of object whose names are rewritten.
NAMED = ["mention_events", "decisions", "artifacts", "unresolved"]


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, text, v) of the JSON objects under a folder; other files are left out."""
    t = spark.read.option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true").text(folder, wholetext=True)
    t = t.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")).withColumn("v", F.try_parse_json("text"))
    return t.where(F.schema_of_variant("v").startswith("OBJECT"))


def _names(v: Column) -> Column:
    """The distinct names in a document: target_id of its objects and their related_entities."""
    parts = []
    for kind in NAMED:
        a = F.coalesce(F.try_variant_get(v, f"$.{kind}", "array<variant>"), F.array().cast("array<variant>"))
        parts.append(F.transform(a, lambda e: F.try_variant_get(e, "$.target_id", "string")))
        if kind != "mention_events":
            listed = F.transform(a, lambda e: F.coalesce(F.try_variant_get(e, "$.related_entities", "array<variant>"), F.array().cast("array<variant>")))
            parts.append(F.transform(F.flatten(listed), lambda n: F.try_variant_get(n, "$", "string")))
    return F.array_distinct(F.filter(F.concat(*parts), lambda n: n.isNotNull() & (n != "")))


@F.pandas_udf(StringType())
def _renamed(text: pd.Series, names: pd.Series) -> pd.Series:
    """Documents with names replaced (names is a JSON object, old to new) and the old ones kept as mentioned_as."""

    def one(t: str, m: str) -> str:
        doc, new = json.loads(t), json.loads(m)
        for kind in NAMED:
            for o in doc[kind] if isinstance(doc.get(kind), list) else []:
                if not isinstance(o, dict):
                    continue
                old = o.get("target_id")
                if isinstance(old, str) and new.get(old, old) != old:
                    o.setdefault("mentioned_as", old)
                    o["target_id"] = new[old]
                if kind != "mention_events" and isinstance(o.get("related_entities"), list):
                    o["related_entities"] = [new.get(n, n) if isinstance(n, str) else n for n in o["related_entities"]]
        return json.dumps(doc, indent=2, ensure_ascii=False)

    return pd.Series([one(t, m) for t, m in zip(text, names, strict=True)], dtype="object")


def canonical_documents(spark: SparkSession, folder: str, aliases: DataFrame | None = None) -> DataFrame:
    """(path, text): the extraction documents under a folder that change when their names are made canonical, rewritten;
    writing.write_texts puts them in place. Running it again on the result gives nothing. Names go through the same
    expression and join as those of events; a document's own names alone travel with it."""
    d = _files(spark, folder).where(~F.regexp_extract("path", r"([^/]+)$", 1).isin(SKIPPED) & ~F.col("path").contains("_logs") & ~F.col("path").contains("_run_summary"))
    each = canonical(d.select("path", F.explode(_names(F.col("v"))).alias("name")), "name", aliases, "new").where("new <> '' and new <> name")
    changed = each.groupBy("path").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("name", "new")))).alias("names"))
    return d.join(changed, "path").select("path", _renamed("text", "names").alias("text"))


@F.pandas_udf(StringType())
def _with_slug(text: pd.Series, slug: pd.Series, at: pd.Series) -> pd.Series:
    return pd.Series([json.dumps({**json.loads(t), "slug_canonical": s, "canonicalized_at": a}, indent=2, ensure_ascii=False) for t, s, a in zip(text, slug, at, strict=True)], dtype="object")


def canvas_slugs(spark: SparkSession, folder: str, aliases: DataFrame | None = None, force: bool = False, at: Column | None = None) -> DataFrame:
    """(path, node_id, raw_title, old_slug, new_slug, outcome, text): each node of a canvas with the canonical name of its
    raw_title, title or label. outcome is rewritten or skipped: a node without a title, one that has a name already (force
    looks again), or one whose name stays. text is the new node where it is rewritten. Reading is all it does: a dry run."""
    v = F.col("v")
    field = lambda f: F.nullif(F.when(F.schema_of_variant(F.try_variant_get(v, f"$.{f}", "variant")).startswith("STRING"), F.try_variant_get(v, f"$.{f}", "string")), F.lit(""))
    n = _files(spark, folder).select("path", "text", F.coalesce(field("raw_title"), field("title"), field("label")).alias("raw_title"), field("slug_canonical").alias("old_slug"), F.coalesce(field("id"), F.regexp_extract("path", r"([^/]+)\.json$", 1)).alias("node_id"))
    n = canonical(n, "raw_title", aliases, "new_slug")
    due = (F.col("new_slug") != "") & (F.col("old_slug").isNull() | (F.lit(force) & (F.col("old_slug") != F.col("new_slug"))))
    n = n.withColumn("outcome", F.when(F.coalesce(due, F.lit(False)), "rewritten").otherwise("skipped"))
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'") if at is None else at
    put = n.where("outcome = 'rewritten'").withColumn("text", _with_slug("text", "new_slug", now))
    cols = ["path", "node_id", "raw_title", "old_slug", "new_slug", "outcome", "text"]
    return put.select(cols).unionByName(n.where("outcome = 'skipped'").withColumn("text", F.lit(None).cast("string")).select(cols))
