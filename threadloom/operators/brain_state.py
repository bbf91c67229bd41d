"""The state of a profile as a brain: regions by logarithmic density, fibers, ten hypotheses, and the last sessions.

Everything starts from frames of a profile (profile.full_profile). They are counted in Spark into a handful of rows, from
which regions, fibers and hypotheses follow as expressions.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The region of each type, the regions, and the fibers between them.
REGION_OF = {
    "Decisions": "prefrontal", "Plans": "prefrontal", "Stances": "prefrontal", "Project": "prefrontal", "Actions": "motor", "Commits": "motor", "MentionEvent": "sensory", "MentalMove": "sensory", "Concept": "anterior_cingulate",
    "Concern": "anterior_cingulate", "Rule": "anterior_cingulate", "Drift": "amygdala", "Affect": "amygdala", "ToolCall": "brainstem", "MCPInvocation": "brainstem", "Tool": "brainstem", "CrossProject": "corpus_callosum",
    "CrossProvider": "corpus_callosum", "Resurrection": "hippocampus", "Language": "sensory", "Product": "sensory", "Artifact": "sensory", "Agent": "sensory",
}
REGIONS = ["prefrontal", "motor", "hippocampus", "amygdala", "brainstem", "sensory", "anterior_cingulate", "corpus_callosum"]
FIBERS = [
    ("prefrontal", "motor"), ("prefrontal", "anterior_cingulate"), ("prefrontal", "corpus_callosum"), ("prefrontal", "hippocampus"), ("motor", "brainstem"), ("motor", "anterior_cingulate"), ("sensory", "prefrontal"),
    ("sensory", "motor"), ("hippocampus", "amygdala"), ("hippocampus", "prefrontal"), ("amygdala", "anterior_cingulate"), ("amygdala", "prefrontal"), ("brainstem", "motor"), ("corpus_callosum", "prefrontal"),
    ("corpus_callosum", "hippocampus"), ("anterior_cingulate", "prefrontal"), ("anterior_cingulate", "amygdala"), ("sensory", "hippocampus"), ("brainstem", "corpus_callosum"), ("prefrontal", "sensory"),
]
WARM, COOL = ["Concern", "Affect"], ["Plans", "ToolCall"]


def region_of(kind: Column) -> Column:
    """The region of a target's type; types of none are sensory."""
    table = F.create_map(*[F.lit(x) for kv in REGION_OF.items() for x in kv])
    return F.coalesce(table[F.coalesce(kind, F.lit("Concept"))], F.lit("sensory"))


def _evidence(profile: dict[str, DataFrame]) -> list[DataFrame]:
    """(region, kind, n) of what each frame of the profile says, some rows a frame."""
    top = profile["top_entities"]
    out = [top.groupBy(region_of(F.col("target_type")).alias("region"), F.coalesce("target_type", F.lit("Concept")).alias("kind")).agg(F.sum("event_count").alias("n"))]

    def add(name: str, region: str, kind: str, where: Column | None = None) -> None:
        if name in profile:
            f = profile[name] if where is None else profile[name].where(where)
            out.append(f.agg(F.count("*").alias("n")).select(F.lit(region).alias("region"), F.lit(kind).alias("kind"), "n"))

    add("convergence", "amygdala", "Affect", F.col("status") == "abandoned")
    add("convergence", "prefrontal", "Decisions", F.col("status") == "active")
    add("load_bearing", "prefrontal", "Decisions", F.col("load_bearing"))
    add("concern_lifecycle", "anterior_cingulate", "Concern")
    if "affect" in profile and "marker" in profile["affect"].columns:
        add("affect", "amygdala", "Affect", F.col("marker") == "frustration")
        add("affect", "anterior_cingulate", "Concern", F.coalesce("marker", F.lit("concern")) == "concern")
    add("moves", "sensory", "MentalMove", F.col("state") == "confirmed")
    add("rules", "anterior_cingulate", "Rule")
    add("stances", "prefrontal", "Decisions")
    return out


def regions(profile: dict[str, DataFrame]) -> DataFrame:
    """(region, density, color_temp): density is the logarithm of what stands for the region against half the sessions, at
    most 1 (0.05 without anything); the temperature weighs concerns and affect against plans and tool calls."""
    parts = _evidence(profile)
    seen = parts[0]
    for p in parts[1:]:
        seen = seen.unionByName(p)
    spark = seen.sparkSession
    kind = F.col("kind")
    per = seen.groupBy("region").agg(F.sum("n").alias("total"), F.sum(F.when(kind.isin(WARM), F.col("n")).otherwise(0)).alias("warm"), F.sum(F.when(kind.isin(COOL), F.col("n")).otherwise(0)).alias("cool"))
    all_of = spark.createDataFrame([(r,) for r in REGIONS], "region string").join(per, "region", "left").fillna(0, ["total", "warm", "cool"])
    all_of = all_of.crossJoin(F.broadcast(profile["scale"].select("sessions")))  # one row by construction
    density = F.when(F.col("total") > 0, F.least(F.lit(1.0), F.log1p("total") / F.log1p(F.greatest(F.col("sessions") * 0.5, F.lit(1.0))))).otherwise(0.05)
    temp = (F.col("warm") - F.col("cool")) / F.greatest(F.col("warm") + F.col("cool"), F.lit(1))
    return all_of.select("region", F.round(density, 3).alias("density"), F.round(temp, 3).alias("color_temp"))


def fibers(areas: DataFrame) -> DataFrame:
    """(from_region, to_region, weight, active): the geometric mean of the densities at both ends; active over 0.15."""
    d = areas.select("region", "density")
    f = areas.sparkSession.createDataFrame(FIBERS, "from_region string, to_region string")
    f = f.join(d.withColumnsRenamed({"region": "from_region", "density": "a"}), "from_region").join(d.withColumnsRenamed({"region": "to_region", "density": "b"}), "to_region")
    weight = F.sqrt(F.col("a") * F.col("b"))
    return f.select("from_region", "to_region", F.round(weight, 3).alias("weight"), (weight > 0.15).alias("active"))


def _numbers(profile: dict[str, DataFrame]) -> DataFrame:
    """One row of the counts that the hypotheses look at; 0 where the profile lacks a frame."""
    spark = profile["scale"].sparkSession
    out = profile["scale"].select("sessions")

    def add(name: str, frame: str, value: Column) -> None:
        nonlocal out
        one = profile[frame].agg(F.coalesce(value, F.lit(0)).cast("long").alias(name)) if frame in profile else spark.createDataFrame([(0,)], f"{name} long")
        out = out.crossJoin(F.broadcast(one))  # one row by construction

    status, trigger = F.col("status"), F.col("trigger")
    of_type = lambda *t: F.sum(F.when(F.coalesce("target_type", F.lit("Concept")).isin(*t), F.col("event_count")))
    add("decisions", "decision_half_life", F.count("*"))
    add("concerns", "concern_lifecycle", F.count("*"))
    add("latent", "concern_lifecycle", F.count_if(status == "latent_unresolved"))
    add("abandoned", "convergence", F.count_if(status == "abandoned"))
    add("projects", "top_entities", F.count_if(F.col("target_type") == "Project"))
    add("tools", "top_entities", of_type("Tool", "ToolCall"))
    add("shared", "cross_provider", F.count("*"))
    add("providers", "provider_cognition", F.count("*"))
    add("rules", "rules", F.count("*"))
    add("moves", "moves", F.count_if(F.col("state") == "confirmed"))
    # a session counts as short where the profile tells half-lives in sessions; those in days never do
    short = F.count_if(F.col("half_life_sessions") <= 2) if "decision_half_life" in profile and "half_life_sessions" in profile["decision_half_life"].columns else F.lit(0)
    add("revised", "decision_half_life", short)
    by_trigger = "drifts" if "drifts" in profile and "trigger" in profile["drifts"].columns else ""
    add("self_catch", by_trigger, F.max(F.when(trigger == "self_catch", F.col("count"))))
    add("tool_failure", by_trigger, F.max(F.when(trigger == "tool_failure", F.col("count"))))
    return out


def hypotheses(profile: dict[str, DataFrame]) -> DataFrame:
    """(id, grp, firing, verdict, evidence, sufficient_data): ten diagnoses of a profile. firing names the regions with their
    intensity (0 to 1 but for drift, which may be negative), evidence the figures behind it."""
    n = {c: F.col(c) for c in ("sessions", "decisions", "concerns", "latent", "abandoned", "projects", "tools", "shared", "providers", "rules", "moves", "revised", "self_catch", "tool_failure")}
    part = lambda x, of: F.least(F.lit(1.0), x / F.lit(float(of)))
    share = n["revised"] / F.greatest(n["decisions"], F.lit(1)) * 100
    ratio = n["self_catch"] / F.greatest(n["tool_failure"], F.lit(1))
    known = n["rules"] + n["moves"]
    graded = lambda x, over, high, low: F.when(x > over, high).otherwise(low)
    spec = [
        ("rehearsal_vs_commitment", "collab", [("prefrontal", part(share, 50))], F.when(share > 30, "reopened").when(share < 15, "committed").otherwise("mixed"), [("revised", n["revised"])], n["decisions"] > 3),
        ("concern_debt", "collab", [("anterior_cingulate", part(n["concerns"], 10))], F.when(n["concerns"] > 5, "in debt").when(n["concerns"] > 0, "manageable").otherwise("none"), [("concerns", n["concerns"])], n["concerns"] > 2),
        ("affect_before_abandonment", "collab", [("amygdala", part(n["abandoned"], 3))], graded(n["abandoned"], 0, "matches", "none"), [("abandoned", n["abandoned"])], n["sessions"] > 10),
        ("drift_by_session_time", "cogload", [("prefrontal", part(ratio, 3)), ("motor", part(n["self_catch"], 50))], graded(ratio, 1.2, "self-catch prevails", "balanced"), [("self_catch", n["self_catch"]), ("tool_failure", n["tool_failure"])], n["sessions"] > 5),
        ("concurrent_project_pressure", "cogload", [("prefrontal", part(n["projects"], 5))], graded(n["projects"], 3, "pressure", "healthy"), [("projects", n["projects"])], n["projects"] > 0),
        ("tool_storm", "cogload", [("brainstem", part(n["tools"], 100))], graded(n["tools"], 50, "storm", "normal"), [("tools", n["tools"])], n["sessions"] > 3),
        ("cross_pollination_vs_bleed", "cross", [("corpus_callosum", part(n["shared"], 20))], graded(n["shared"], 5, "to be checked", "low"), [("shared", n["shared"])], n["shared"] > 0),
        ("provider_specific_cognition", "cross", [("sensory", part(n["providers"], 5))], graded(n["providers"], 1, "several providers", "one provider"), [("providers", n["providers"])], n["providers"] > 0),
        ("rule_firing_under_pressure", "toolfit", [("prefrontal", part(known, 50)), ("anterior_cingulate", part(known, 50) * 0.7)], graded(known, 5, "tracked", "too few"), [("rules", n["rules"]), ("moves", n["moves"])], known > 3),
        ("silent_failure", "toolfit", [("prefrontal", part(n["latent"], 5))], graded(n["latent"], 0, "possible", "none"), [("latent", n["latent"])], n["decisions"] > 2),
    ]
    listed = lambda pairs, show: F.array_join(F.array(*[F.concat(F.lit(f"{k}="), show(v).cast("string")) for k, v in pairs]), ",")
    rows = [
        F.struct(F.lit(i).alias("id"), F.lit(g).alias("grp"), listed(fire, lambda v: F.format_number(v, 3)).alias("firing"), verdict.alias("verdict"), listed(facts, lambda v: v).alias("evidence"), enough.alias("sufficient_data"))
        for i, g, fire, verdict, facts, enough in spec
    ]
    return _numbers(profile).select(F.explode(F.array(*rows)).alias("h")).select("h.*")


def timeline(events: DataFrame, last: int = 50) -> DataFrame:
    """(session_id, ts_raw, fired): the last sessions by their first event's time, with the regions of the types they touch
    in order of first touch. Sessions are ranked before their regions are gathered."""
    e = events.where("ts_raw <> ''")
    first = e.groupBy("session_id").agg(F.min("ts_raw").alias("ts_raw")).orderBy(F.col("ts_raw").desc(), F.col("session_id").desc()).limit(last)
    at = F.struct(F.col("e.ts_raw").alias("t"), F.col("e.seq").alias("s"))
    touched = e.alias("e").join(F.broadcast(first).alias("f"), "session_id").groupBy("session_id", F.col("f.ts_raw").alias("ts_raw"), region_of(F.col("target_type")).alias("region")).agg(F.min(at).alias("at"))  # `last` rows
    return touched.groupBy("session_id", "ts_raw").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "region"))), lambda x: x["region"]), ",").alias("fired"))


def state_json(profile: dict[str, DataFrame], events: DataFrame | None = None) -> str:
    """The whole state as one JSON text: 8 regions, 20 fibers, 10 hypotheses, at most 50 sessions."""
    areas = regions(profile)
    rows = lambda f: [r.asDict() for r in f.collect()]  # noqa: E731  as many as the docstring says
    times = [] if events is None else [{"ts": r["ts_raw"], "fired_regions": r["fired"].split(",")} for r in timeline(events).orderBy("ts_raw", "session_id").collect()]
    meta = {"sessions": profile["scale"].first()["sessions"], "entities": profile["top_entities"].count()}
    return json.dumps({"regions": rows(areas), "fibers": rows(fibers(areas)), "hypotheses": {r["id"]: r for r in rows(hypotheses(profile))}, "timeline": times, "meta": meta}, indent=2, ensure_ascii=False, default=str)
