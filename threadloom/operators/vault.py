"""Entity pages: what is known of a target, its decisions, concerns, rules and mention log, and their rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import activity, strip
from .containment import containing
from .graph import co_mentions
from .profile import when_key


def entities(events: DataFrame, now: Column, top: int = 6, most_targets: int | None = None) -> DataFrame:
    """A row a target: dominant type and valence (the most frequent, ties by first seen), first and last seen, count,
    providers, aliases, the targets most often in the same session, and status by age at `now`.

    Sessions of any size make pairs, as in the reference; where most_targets is given, longer ones make none."""
    e = events.where("target_id <> ''")

    def dominant(c: str) -> DataFrame:
        v = e.where(F.col(c).isNotNull() & (F.col(c) != "")).groupBy("target_id", c).agg(F.count("*").alias("n"), F.min(when_key()).alias("f"))
        by = Window.partitionBy("target_id").orderBy(F.col("n").desc(), "f")
        return v.withColumn("r", F.row_number().over(by)).where("r = 1").select("target_id", c)

    alias = F.col("mentioned_as") if "mentioned_as" in e.columns else F.lit(None).cast("string")
    per = e.groupBy("target_id").agg(
        F.min_by("ts", when_key()).alias("first_seen"), F.max_by("ts", when_key()).alias("last_seen"), F.count("*").alias("mention_count"),
        F.array_join(F.array_sort(F.collect_set("provider")), ",").alias("providers"), F.array_join(F.array_sort(F.collect_set(F.when(alias != F.col("target_id"), alias))), ",").alias("aliases"),
    )
    by = Window.partitionBy("src").orderBy(F.col("weight").desc(), "dst")
    near = co_mentions(e, most_targets).withColumn("r", F.row_number().over(by)).where(F.col("r") <= top)
    near = near.groupBy("src").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "dst"))), lambda x: x["dst"]), ",").alias("co_mentioned"))
    out = per.join(dominant("target_type"), "target_id", "left").join(dominant("valence"), "target_id", "left").join(near, F.col("target_id") == F.col("src"), "left").drop("src")
    return out.withColumn("co_mentioned", F.coalesce("co_mentioned", F.lit(""))).withColumn("status", activity(F.col("last_seen"), now))


def decisions_of(events: DataFrame, decisions: DataFrame, most: int = 15) -> DataFrame:
    """(target_id, session_id, line, place): decisions of the sessions that mention a target and relate to it or are about it
    (their own target_id); equal lines once, in the order of the mentions, at most `most` a target, with the first 100
    characters of why where it is told. Equi-joins on session and target; no pair of all with all."""
    line = F.substring("proposition", 1, 180)
    if "why" in decisions.columns:
        line = F.when(F.col("why") != "", F.concat(line, F.lit(" _(why: "), F.substring("why", 1, 100), F.lit(")_"))).otherwise(line)
    whom = F.array_union("related_entities", F.array("target_id")) if "target_id" in decisions.columns else F.col("related_entities")
    about = decisions.select("session_id", F.col("seq").alias("d"), line.alias("line"), F.explode(whom).alias("target_id"))
    e = events.groupBy("session_id", "target_id").agg(F.min(when_key()).alias("at"))
    met = e.join(about.distinct(), ["session_id", "target_id"]).groupBy("target_id", "session_id", "line").agg(F.min(F.struct("at", "d")).alias("at"))
    by = Window.partitionBy("target_id").orderBy("at", "session_id", "line")
    return met.withColumn("place", F.row_number().over(by)).where(F.col("place") <= most).drop("at")


def rules_of(events: DataFrame, rules: DataFrame, most: int = 15) -> DataFrame:
    """(target_id, session_id, line, place): rules of a mentioning session whose text or scope holds the target's name. Rules
    and names meet by a piece of the name and the session, not every rule of a session with all its targets."""
    e = events.groupBy("session_id", "target_id").agg(F.min(when_key()).alias("at"))
    r = rules.select("session_id", F.col("seq").alias("d"), "rule_text", F.concat(F.coalesce("applies_to", F.lit("")), F.lit("\n\x00\n"), F.coalesce("rule_text", F.lit(""))).alias("both"))
    found = containing(r, e.where("target_id <> ''"), "d", "both", "target_id", ["session_id"], any_case=False)
    met = found.join(r.select("session_id", "d", "rule_text"), ["session_id", "d"]).join(e, ["session_id", "target_id"])
    met = met.groupBy("target_id", "session_id", F.substring("rule_text", 1, 180).alias("line")).agg(F.min(F.struct("at", "d")).alias("at"))
    by = Window.partitionBy("target_id").orderBy("at", "session_id", "line")
    return met.withColumn("place", F.row_number().over(by)).where(F.col("place") <= most).drop("at")


def diverse(events: DataFrame, most: int = 12) -> DataFrame:
    """At most `most` events a target, taken in turn from its (provider, valence) groups, the group first seen first; all
    events of a target that has no more."""
    group = Window.partitionBy("target_id", "provider", "valence")
    e = events.withColumn("turn", F.row_number().over(group.orderBy(F.coalesce("ts_raw", F.lit("")), "seq"))).withColumn("first", F.min(when_key()).over(group))
    by = Window.partitionBy("target_id").orderBy("turn", "first", "seq")
    return e.withColumn("place", F.row_number().over(by)).where(F.col("place") <= most).drop("turn", "first")


#: Fixed value: characters that a YAML scalar may not hold unquoted.
QUOTED = r"[:#\[\]{}&*!|>'\"%@`\n]"


def yaml_scalar(value: Column) -> Column:
    """A string as a YAML scalar: in JSON quotes only where it must be, null where it is none."""
    quoted = F.regexp_replace(F.to_json(F.struct(value.alias("v"))), r'(?s)^\{"v":(.*)\}$', "$1")
    return F.when(value.isNull(), "null").when(value.rlike(QUOTED), quoted).otherwise(value)


def yaml_list(values: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(values, yaml_scalar), ", "), F.lit("]"))


def file_names(targets: DataFrame) -> DataFrame:
    """(target_id, name): a file's name for each target, other characters than letters, digits, dot, underscore and hyphen as
    hyphens. Targets that would share a name (in any case) get a digest of their own behind it, all but the first by id."""
    name = F.regexp_replace(F.regexp_replace("target_id", r"[^A-Za-z0-9._-]+", "-"), r"^-+|-+$", "")
    t = targets.select("target_id").distinct().withColumn("name", F.substring(F.when(name == "", "unnamed").otherwise(name), 1, 120))
    n = F.row_number().over(Window.partitionBy(F.lower("name")).orderBy("target_id"))
    return t.withColumn("n", n).select("target_id", F.when(F.col("n") == 1, F.col("name")).otherwise(F.concat("name", F.lit("-"), F.substring(F.sha2("target_id", 256), 1, 8))).alias("name"))


def _lines(frame: DataFrame, order: Column, line: Column, name: str, most: int | None = None) -> DataFrame:
    """(target_id, name): each target's lines in order as one text, at most `most` of them."""
    if most is not None:
        frame = frame.withColumn("_r", F.row_number().over(Window.partitionBy("target_id").orderBy(order))).where(F.col("_r") <= most)
    listed = F.array_sort(F.collect_list(F.struct(order.alias("o"), line.alias("l"))))
    return frame.groupBy("target_id").agg(F.array_join(F.transform(listed, lambda x: x["l"]), "\n").alias(name))


def pages(events: DataFrame, now: Column, decisions: DataFrame | None = None, rules: DataFrame | None = None) -> DataFrame:
    """(target_id, name, page): each target's page as Markdown with front matter, under a file name of its own. A page holds
    the whole mention log of its target; concerns stop at twenty, decisions and rules at fifteen."""
    e = events.where("target_id <> ''")
    dash, session = F.lit(" \u2014 "), F.concat(F.lit("- [[session_"), F.col("session_id"), F.lit("]]"))
    day = F.coalesce(F.nullif(F.substring("ts_raw", 1, 10), F.lit("")), F.lit("\u2014"))
    kind = F.coalesce(F.nullif(F.col("mention_type"), F.lit("")), F.lit("reference"))
    quote = F.col("evidence_quote") if "evidence_quote" in e.columns else F.lit(None).cast("string")
    quote = F.substring(F.regexp_replace(strip(F.coalesce(quote, F.lit(""))), "\n", " "), 1, 180)
    out = entities(e, now).join(file_names(e), "target_id")
    out = out.join(e.groupBy("target_id").agg(F.min_by("ts_raw", when_key()).alias("_from"), F.max_by("ts_raw", when_key()).alias("_to")), "target_id")
    out = out.join(_lines(e, when_key(), F.concat(F.lit("- "), day, dash, F.lit("[[session_"), "session_id", F.lit("]]"), dash, kind, F.lit(" ("), F.coalesce("authorship", F.lit("?")), F.lit(")")), "_log"), "target_id")
    out = out.join(_lines(e.where("mention_type like 'concern%'"), when_key(), F.concat(session, dash, F.lit("**"), kind, F.lit("**"), dash, quote), "_concerns", 20), "target_id", "left")
    for name, frame, of in (("_decisions", decisions, decisions_of), ("_rules", rules, rules_of)):
        own = e.limit(0).select("target_id", F.lit("").alias(name)) if frame is None else _lines(of(e, frame), F.col("place"), F.concat(session, dash, "line"), name)
        out = out.join(own, "target_id", "left")
    blank = F.lit("")
    split = lambda c: F.filter(F.split(F.coalesce(c, blank), ","), lambda x: x != "")
    front = {
        "target_id": yaml_scalar(F.col("target_id")), "target_type": yaml_scalar(F.coalesce("target_type", F.lit("Unknown"))), "aliases": yaml_list(split("aliases")), "first_seen": yaml_scalar(F.coalesce("_from", blank)), "last_seen": yaml_scalar(F.coalesce("_to", blank)),
        "mention_count": F.col("mention_count").cast("string"), "providers": yaml_list(split("providers")), "co_mentioned_top": yaml_list(split("co_mentioned")), "status": F.col("status"),
    }
    head = F.concat(F.lit("---\n"), *[x for k, v in front.items() for x in (F.lit(f"{k}: "), v, F.lit("\n"))], F.lit("---\n\n# "), "target_id", F.lit("\n"))
    said = F.concat(F.lit("## Summary\nDominant valence: **"), F.coalesce("valence", F.lit("\u2014")), F.lit("**. Seen across providers: "), F.coalesce(F.nullif(F.array_join(split("providers"), ", "), blank), F.lit("\u2014")), F.lit(". Status: **"), "status", F.lit("** (last seen "), F.coalesce(F.nullif("_to", blank), F.lit("\u2014")), F.lit(").\n\n"))
    section = lambda title, body: F.when(F.col(body) != "", F.concat(F.lit(f"## {title}\n"), body, F.lit("\n\n"))).otherwise("")
    parts = [section("Load-bearing decisions", "_decisions"), section("Concerns", "_concerns"), section("Rules touching this entity", "_rules"), section("Mention log", "_log")]
    return out.select("target_id", "name", F.concat(head, said, *parts).alias("page"))


def index_page(names: DataFrame) -> DataFrame:
    """(name, page): one row, the index of all pages in order of their targets, whatever their case; it grows with the
    targets, and its lines are put together in one task."""
    line = F.concat(F.lit("- [["), "name", F.lit("]] \u2014 `"), "target_id", F.lit("`\n"))
    listed = F.array_sort(F.collect_list(F.struct(F.lower("target_id").alias("k"), "target_id", line.alias("l"))))
    one = names.agg(F.count("*").alias("n"), F.array_join(F.transform(listed, lambda x: x["l"]), "").alias("all"))
    return one.select(F.lit("INDEX").alias("name"), F.concat(F.lit("# Vault index\n_"), F.col("n").cast("string"), F.lit(" entities_\n\n"), "all").alias("page"))
