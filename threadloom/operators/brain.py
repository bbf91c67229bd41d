"""A profile as eight regions and the fibers between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Regions with whom they are attributed to, and fibers (from, to, kind, backing).
REGIONS = {"prefrontal": "shared", "motor": "ai", "sensory": "shared", "anterior_cingulate": "shared", "hippocampus": "founder", "amygdala": "founder", "brainstem": "ai", "corpus_callosum": "shared"}
FIBERS = [
    ("corpus_callosum", "prefrontal", "bridge", "real"), ("corpus_callosum", "motor", "bridge", "real"), ("corpus_callosum", "sensory", "bridge", "real"), ("corpus_callosum", "hippocampus", "bridge", "real"),
    ("corpus_callosum", "amygdala", "bridge", "real"), ("corpus_callosum", "anterior_cingulate", "bridge", "real"), ("sensory", "prefrontal", "input", "real"), ("sensory", "hippocampus", "input", "real"),
    ("sensory", "amygdala", "input", "real"), ("hippocampus", "prefrontal", "consolidation", "real"), ("hippocampus", "motor", "consolidation", "real"), ("amygdala", "prefrontal", "gating", "real"),
    ("amygdala", "anterior_cingulate", "gating", "real"), ("prefrontal", "anterior_cingulate", "monitor", "synthetic"), ("motor", "anterior_cingulate", "monitor", "synthetic"), ("brainstem", "anterior_cingulate", "monitor", "synthetic"),
    ("motor", "brainstem", "output", "synthetic"), ("motor", "corpus_callosum", "output", "synthetic"), ("motor", "sensory", "reafference", "synthetic"), ("sensory", "anterior_cingulate", "input", "real"),
    ("brainstem", "prefrontal", "input", "real"), ("brainstem", "sensory", "input", "real"),
]
WARM, COOL = ["positive", "confident", "excited"], ["frustrated", "negative", "concerned", "urgent"]


def regions(profile: dict[str, DataFrame]) -> DataFrame:
    """(region, count, density, color_temp, attribution): counts of what stands for each region over the largest; the
    amygdala's temperature is the mean of warm against cool valences."""
    spark = profile["scale"].sparkSession

    def total(region: str, frame: DataFrame | None, value) -> DataFrame:
        if frame is None:
            return spark.createDataFrame([(region, 0)], "region string, count long")
        return frame.agg(F.coalesce(value, F.lit(0)).cast("long").alias("count")).select(F.lit(region).alias("region"), "count")

    top = profile["top_entities"]
    top10 = top.orderBy(F.col("event_count").desc(), "target_id").limit(10)
    rules = profile.get("rules")
    memory = profile["idea_resurrection"].select(F.lit(3).alias("w"))
    memory = memory if rules is None else memory.unionByName(rules.select(F.lit(1).alias("w")))
    parts = [
        total("prefrontal", profile.get("load_bearing"), F.sum("sessions") if "load_bearing" in profile else None), total("motor", top, F.floor(F.count("*") / 3)), total("sensory", top10, F.sum("event_count")),
        total("anterior_cingulate", profile["concern_lifecycle"], F.sum(F.col("raised") + F.col("resolved"))), total("hippocampus", memory, F.sum("w")), total("amygdala", profile.get("affect"), F.count("*")),
        total("brainstem", profile.get("drifts"), F.count("*")), total("corpus_callosum", profile["cross_provider"], F.sum("provider_count")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if "affect" in profile:
        v = F.lower("valence")
        heat = F.when(v.isin(WARM), 1).when(v.isin(COOL), -1).otherwise(0)
        temp = profile["affect"].agg(F.coalesce(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.avg(heat))), F.lit(0.0)).alias("temp"))
    else:
        temp = spark.createDataFrame([(0.0,)], "temp double")
    most = F.greatest(F.max("count").over(Window.partitionBy()), F.lit(1))  # eight rows
    attributed = F.create_map(*[F.lit(x) for kv in REGIONS.items() for x in kv])
    out = out.crossJoin(F.broadcast(temp))  # one row by construction
    return out.select("region", "count", F.round(F.col("count") / most, 3).alias("density"), F.round(F.when(F.col("region") == "amygdala", F.col("temp")).otherwise(0.0), 3).alias("color_temp"), attributed[F.col("region")].alias("attribution"))


def fibers(spark: SparkSession, areas: DataFrame, active: float = 0.4, baseline: float = 0.2) -> DataFrame:
    """(from_region, to_region, kind, weight, active, backing): real fibers weigh the geometric mean of their ends."""
    f = spark.createDataFrame(FIBERS, "from_region string, to_region string, kind string, backing string")
    d = areas.select("region", "density")
    x = f.join(d.withColumnsRenamed({"region": "from_region", "density": "a"}), "from_region").join(d.withColumnsRenamed({"region": "to_region", "density": "b"}), "to_region")
    weight = F.when(F.col("backing") == "real", F.round(F.sqrt(F.col("a") * F.col("b")), 3)).otherwise(baseline)
    return x.select("from_region", "to_region", "kind", weight.alias("weight"), ((F.col("backing") == "real") & (weight > active)).alias("active"), "backing")


def hypotheses(profile: dict[str, DataFrame], shown: int = 3) -> DataFrame:
    """(pill, count, top): six signals of a profile with how many rows support each and its first names."""
    spec = [
        ("cross_provider_bleed", profile["cross_provider"], F.lit(True), "target_id", F.col("provider_count").desc()),
        ("concern_debt", profile["concern_lifecycle"], F.col("status") == "latent_unresolved", "target_id", F.col("raised").desc()),
        ("decision_half_life", profile["decision_half_life"], F.col("thrashing"), "target_id", F.col("half_life_days").asc()),
        ("idea_resurrection", profile["idea_resurrection"], F.lit(True), "target_id", F.col("gap_days").desc()),
        ("provider_cognition", profile["provider_cognition"], F.lit(True), "provider", F.col("raised_per_session").desc()),
    ]
    if "moves" in profile:
        spec.append(("confirmed_moves", profile["moves"], F.col("state") == "confirmed", "move", F.col("occurrences").desc()))
    out = None
    for pill, frame, where, name, order in spec:
        own = frame.where(where)
        top = own.orderBy(order, name).limit(shown).withColumn("_r", F.monotonically_increasing_id()).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", F.col(name).alias("n")))), lambda x: x["n"]), ",").alias("top"))
        row = own.agg(F.count("*").alias("count")).crossJoin(F.broadcast(top)).select(F.lit(pill).alias("pill"), "count", "top")  # one row by construction
        out = row if out is None else out.unionByName(row)
    return out


def timeline(events: DataFrame, days: int = 30) -> DataFrame:
    """(day, events, sessions) of the last days up to the newest event, empty days included."""
    end = events.agg(F.to_date(F.max("ts")).alias("end"))
    span = end.select(F.explode(F.sequence(F.date_sub("end", days - 1), "end")).alias("day"))
    per = events.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("events"), F.count_distinct("session_id").alias("sessions"))
    return span.join(per, "day", "left").select("day", F.coalesce("events", F.lit(0)).alias("events"), F.coalesce("sessions", F.lit(0)).alias("sessions"))
