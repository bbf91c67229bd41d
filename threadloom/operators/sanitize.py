"""Levels of disclosure of a profile: as it is, pseudonyms for names, names left out, counts alone."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

LEVELS = ["none", "named_stripped", "entities_removed", "aggregated"]
#: Frames of a profile that name targets.
NAMED = ["convergence", "load_bearing", "concern_lifecycle", "cross_provider", "top_entities", "idea_resurrection", "decision_half_life", "concern_lifetime"]


@F.pandas_udf(StringType())
def short_digest(names: pd.Series) -> pd.Series:
    """Six hex digits of BLAKE2s, which Spark lacks."""
    return names.map(lambda n: None if n is None else hashlib.blake2s(n.encode(), digest_size=3).hexdigest())


def pseudonyms(profile: dict[str, DataFrame]) -> DataFrame:
    """(target_id, alias) of every name in the profile: the start of its type and a digest."""
    names = None
    for n in NAMED:
        if n in profile:
            own = profile[n].select(F.col("entity" if n == "load_bearing" else "target_id").alias("target_id"))
            names = own if names is None else names.unionByName(own)
    types = profile["top_entities"]
    kinds = types.select("target_id", F.substring(F.lower("target_type"), 1, 4).alias("kind")) if "target_type" in types.columns else types.select("target_id", F.lit("enti").alias("kind"))
    out = names.where("target_id is not null").distinct().join(kinds, "target_id", "left")
    return out.select("target_id", F.concat(F.coalesce("kind", F.lit("enti")), F.lit("-"), short_digest("target_id")).alias("alias"))


def rewrite(frame: DataFrame, aliases: DataFrame, column: str = "target_id") -> DataFrame:
    """frame with names replaced; unknown ones are entity-unknown."""
    a = aliases.select(F.col("target_id").alias("_t"), "alias")
    x = frame.join(a, F.col(column) == F.col("_t"), "left")
    return x.select(*[F.coalesce("alias", F.lit("entity-unknown")).alias(c) if c == column else F.col(c) for c in frame.columns])


def counts(profile: dict[str, DataFrame]) -> DataFrame:
    """One row of population counts: what the aggregated level gives."""
    empty = F.lit(0).cast("long")

    def n(name: str, where: Column | None = None) -> DataFrame:
        f = profile.get(name)
        if f is None:
            return None
        return f.agg((F.count("*") if where is None else F.count_if(where)).alias("n"))

    parts = {
        "confirmed_moves": n("moves", F.col("state") == "confirmed") if "moves" in profile else None, "rules": n("rules"), "latent_concerns": n("concern_lifecycle", F.col("status") == "latent_unresolved"),
        "load_bearing_decisions": n("load_bearing", F.col("load_bearing")) if "load_bearing" in profile else None, "cross_provider_entities": n("cross_provider"), "resurrected_ideas": n("idea_resurrection"), "recurring_drifts": n("drifts", F.col("count") >= 2),
    }
    out = None
    for name, f in parts.items():
        if f is None:
            continue
        f = f.withColumnRenamed("n", name)
        out = f if out is None else out.crossJoin(F.broadcast(f))  # one row by construction
    for name, f in parts.items():
        if f is None:
            out = out.withColumn(name, empty)
    return out.select(*parts)


def sanitise(profile: dict[str, DataFrame], level: str) -> dict[str, DataFrame]:
    """The profile at a level. named_stripped changes ids alone: texts of propositions and rules stay, so it isn't private."""
    if level not in LEVELS:
        raise ValueError(f"unknown level {level!r}; there are {LEVELS}")
    if level == "none":
        return dict(profile)
    if level == "named_stripped":
        a = pseudonyms(profile)
        return {n: rewrite(f, a, "entity" if n == "load_bearing" else "target_id") if n in NAMED else f for n, f in profile.items()}
    if level == "entities_removed":
        out = {n: f for n, f in profile.items() if n in ("scale", "moves", "rules", "drifts", "provider_cognition")}
        if "rules" in out and "applies_to" in out["rules"].columns:
            out["rules"] = out["rules"].withColumn("applies_to", F.lit("-"))
        return out
    return {"scale": profile["scale"], "counts": counts(profile)}
