"""Profiles and classified rules as tables on disk, written once and read by every compile."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Frames that a profile may have.
FRAMES = ["convergence", "concern_lifecycle", "cross_provider", "top_entities", "idea_resurrection", "decision_half_life", "concern_lifetime", "provider_cognition", "scale", "load_bearing", "moves", "rules", "affect", "stances", "drifts", "counts"]
#: Signs of a folder that is not there, holds nothing, or holds what is no Parquet; any other failure is raised.
ABSENT = ["PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "CANNOT_READ_FILE_FOOTER"]
RULES = "seq long, rule_text string, applies_to string, level string, session_id string, provider string, bucket string, scope string"


def save(frames: dict[str, DataFrame], path: str) -> None:
    """Each frame as Parquet in a folder of its name."""
    for name, frame in frames.items():
        frame.write.mode("overwrite").parquet(f"{path}/{name}")


def load(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The frames found under a path; a frame that is missing or cannot be read is left out, so nothing there is {}."""
    out = {}
    for name in FRAMES:
        try:
            out[name] = spark.read.parquet(f"{path}/{name}")
        except Exception as e:
            if not any(sign in str(e) for sign in ABSENT):
                raise
    return out


def classified_rules(spark: SparkSession, *paths: str) -> DataFrame:
    """The rules of the first path that exists, a JSON file {"rules": [{rule_text, ..., classification: {bucket, scope}}]};
    empty where there is none or it is no such file."""
    for path in paths:
        try:
            t = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
        except AnalysisException:
            continue
        e = t.select(F.posexplode(F.try_variant_get("v", "$.rules", "array<variant>")).alias("pos", "e"))
        s = lambda k: F.try_variant_get("e", f"$.{k}", "string")
        return e.select(F.col("pos").cast("long").alias("seq"), s("rule_text").alias("rule_text"), s("applies_to").alias("applies_to"), s("level").alias("level"), s("session").alias("session_id"), s("provider").alias("provider"), s("classification.bucket").alias("bucket"), s("classification.scope").alias("scope"))
    return spark.createDataFrame([], RULES)
