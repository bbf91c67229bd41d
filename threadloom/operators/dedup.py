"""Merging rows of one canonical name, and fuzzy merging of moves."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import scratch, stage
from .containment import pieces

MOVE = "move string, owner string, level string, occurrences long, merged int"


def merge_by_name(frame: DataFrame, name: Column, counts: list[str], sets: list[str], keep: list[str], order: str = "seq") -> DataFrame:
    """A row a canonical name: counts summed, sets united and sorted, other fields of the first row by order. One aggregate."""
    aggs = [F.sum(c).alias(c) for c in counts] + [F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in sets] + [F.min_by(c, order).alias(c) for c in keep]
    return frame.withColumn("_name", name).groupBy(F.col("_name").alias("name")).agg(*aggs, F.min(order).alias(order), F.count("*").alias("merged"))


def move_links(keys: DataFrame, least: int = 20, prefix: int = 40) -> DataFrame:
    """(src, dst): links, by id, enough to connect all keys (id, key; distinct, of at least `least` characters of a-z, 0-9 and
    blank) of which one holds the other or which share a prefix of `prefix`: each prefix a star, and each holder to what it
    holds.

    A key is looked up by the rarest of its pieces of `least` characters among the pieces of all keys, then compared. Pieces
    carry ids alone, so their rows take no more than the keys' lengths in all."""
    block = F.substring("key", 1, prefix)
    stars = keys.where(F.length("key") >= prefix).select("id", block.alias("b"))
    stars = stars.join(stars.groupBy("b").agg(F.min("id").alias("src"), F.count("*").alias("n")).where("n > 1"), "b")
    stars = stars.where("id <> src").select("src", F.col("id").alias("dst"))
    index = stage(pieces(keys, "key", [least], ["id"]))
    counts = index.groupBy("_piece").agg(F.count("*").alias("n"))
    rare = index.join(counts, "_piece").groupBy("id").agg(F.min_by(F.struct("_piece", "n"), F.struct("n", "_piece")).alias("x")).where("x.n > 1")
    met = rare.select(F.col("id").alias("dst"), F.col("x._piece").alias("_piece")).join(index.withColumnRenamed("id", "src"), "_piece").where("src <> dst").select("src", "dst")
    held = met.join(keys.select(F.col("id").alias("src"), F.col("key").alias("whole")), "src").join(keys.select(F.col("id").alias("dst"), F.col("key").alias("part")), "dst")
    return stars.unionByName(held.where(F.col("whole").contains(F.col("part"))).select("src", "dst"))


def _scan(pdf: pd.DataFrame, least: int, prefix: int) -> pd.DataFrame:
    """One component's moves, most frequent first: each goes to the first kept move that it fits."""
    kept: list[dict] = []
    for r in pdf.sort_values(["occurrences", "id"], ascending=[False, True]).to_dict("records"):
        for k in kept:
            short, long = sorted((k["key"], r["key"]), key=len)
            if len(short) >= least and short in long or len(short) >= prefix and k["key"][:prefix] == r["key"][:prefix]:
                k["occurrences"] += r["occurrences"]
                k["merged"] += 1
                if len(r["move"]) > len(k["move"]):
                    k["move"], k["key"] = r["move"], r["key"]
                break
        else:
            kept.append(r | {"merged": 1})
    return pd.DataFrame(kept, columns=["move", "owner", "level", "occurrences", "merged"])


def merge_moves(moves: DataFrame, least: int = 20, prefix: int = 40, order: list[str] | None = None) -> DataFrame:
    """Moves (move, owner, level, occurrences) merged greedily, most frequent first, ties by `order` (by default move, owner,
    level): into one whose key holds or is held by theirs (the shorter of at least `least` characters) or shares a prefix of
    `prefix`; the longer text stays, the rest is the first one's. Moves of shorter keys, and of none, stay alone.

    The scan depends on its own earlier merges, but a move can only meet moves that it is linked to by way of others, so
    each component of the links is scanned alone, and the result is that of one scan over all."""
    from ..functions.text import move_key
    from .graph import components

    scratch(moves.sparkSession)
    m = moves.select("move", "owner", "level", F.col("occurrences").cast("long").alias("occurrences"), move_key(F.col("move")).alias("key"), F.struct(*(order or ["move", "owner", "level"])).alias("rank"))
    m = m.withColumn("id", F.monotonically_increasing_id()).checkpoint()  # the keys are read several times
    alone = m.where(F.length("key") < least).select("move", "owner", "level", "occurrences", F.lit(1).alias("merged"))
    m = m.where(F.length("key") >= least)
    keys = m.groupBy("key").agg(F.min("id").alias("id")).checkpoint()
    nodes = components(move_links(keys, least, prefix))
    nodes = keys.join(nodes, F.col("id") == F.col("node"), "left").select("key", F.coalesce("component", "id").alias("component"))
    m = m.drop("id").join(nodes, "key")
    m = m.withColumn("id", F.row_number().over(Window.partitionBy("component").orderBy("rank"))).drop("rank")
    scan = lambda pdf: _scan(pdf, least, prefix)
    return m.groupBy("component").applyInPandas(scan, MOVE).unionByName(alone)
