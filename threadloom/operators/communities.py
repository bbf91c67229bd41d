"""Modularity communities of a weighted graph, as Spark jobs: synchronous local moving over staged edge tables.

A level is a table of edges (both directions, self-loops for what an earlier level contracted) and one of nodes with their
home and degree. In each step the nodes of one colour may move to the neighbouring community of largest modularity gain;
colours are drawn anew each time round, so no two nodes swap for ever, and of two nodes alone only the one with the larger
name joins the other. When a level gains no more, communities become the nodes of the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..staging import stage, unstage
from .ordering import numbered


def louvain(edges: DataFrame, resolution: float = 1.0, colours: int = 2, rounds: int = 12, least: float = 1e-6) -> DataFrame:
    """(node, community): communities of the edges (src, dst, weight), both directions' weights added; numbered from 0 by
    their first node. Nodes without an edge are none of the graph's.

    A step is one job: edges meet the homes of their far ends (an equi-join that AQE splits at hubs), weights are summed by
    node and community, and each node keeps its best. A level takes at most `rounds` times `colours` steps and stops when
    one round gains less than `least`; the best step's homes are kept, so no step makes a result worse."""
    e = edges.select(F.col("src").cast("string").alias("s"), F.col("dst").cast("string").alias("d"), F.col("weight").cast("double").alias("w")).where("s is not null and d is not null")
    e = stage(e)
    names = e.select(F.col("s").alias("node")).unionByName(e.select(F.col("d").alias("node"))).distinct()
    names = stage(numbered(names, [F.col("node")], "id", 0))
    ids = lambda c: names.select(F.col("node").alias(c), F.col("id").alias(f"{c}_id"))
    half = e.join(ids("s"), "s").join(ids("d"), "d").select(F.col("s_id").alias("a"), F.col("d_id").alias("b"), "w")
    graph = stage(half.unionByName(half.select(F.col("b").alias("a"), F.col("a").alias("b"), "w")).groupBy("a", "b").agg(F.sum("w").alias("w")))
    unstage(e)
    member = names.select("node", F.col("id").alias("home"))
    total = graph.agg(F.sum("w")).first()[0]
    level, best = 0, None
    while total:
        homes, quality, moved = _moved(graph, total, resolution, colours, rounds, least, level)
        if best is not None and quality < best + least or not moved:
            unstage(homes)
            break
        best, level = quality, level + 1
        at = homes.select(F.col("node").alias("home"), F.col("home").alias("up"))
        before, member = member, stage(member.join(at, "home").select("node", F.col("up").alias("home")))
        ends = lambda c: homes.select(F.col("node").alias(c), F.col("home").alias(f"{c}_home"))
        smaller = stage(graph.join(ends("a"), "a").join(ends("b"), "b").groupBy(F.col("a_home").alias("a"), F.col("b_home").alias("b")).agg(F.sum("w").alias("w")))
        unstage(graph, homes, *([before] if level > 1 else []))
        graph = smaller
    first = member.groupBy("home").agg(F.min("node").alias("first"))
    return member.join(numbered(first, [F.col("first")], "community", 0), "home").select("node", F.col("community").cast("int").alias("community"))


def _moved(graph: DataFrame, total: float, resolution: float, colours: int, rounds: int, least: float, level: int) -> tuple[DataFrame, float, bool]:
    """The homes of a level's nodes after local moving, staged, their modularity, and whether any node moved."""
    degrees = graph.groupBy(F.col("a").alias("node")).agg(F.sum("w").alias("k"), F.sum(F.when(F.col("a") == F.col("b"), F.col("w")).otherwise(0.0)).alias("loop"))
    now = stage(degrees.select("node", F.col("node").alias("home"), "k", "loop"))
    best, quality, still, began, any_move = now, None, 0, None, False
    share = resolution / total
    for step in range(colours * rounds + 1):
        far = now.select(F.col("node").alias("b"), F.col("home").alias("to"))
        near = graph.where("a <> b").join(far, "b").groupBy(F.col("a").alias("node"), "to").agg(F.sum("w").alias("w"))
        sums = now.groupBy(F.col("home").alias("to")).agg(F.sum("k").alias("sum"), F.count("*").alias("size"))
        mine = now.join(sums.withColumnsRenamed({"to": "home", "sum": "home_sum", "size": "home_size"}), "home")
        gain = F.col("w") - F.lit(share) * F.col("k") * F.col("sum")
        alone = (F.col("home_size") == 1) & (F.col("size") == 1) & (F.col("to") > F.col("home"))
        seen = near.join(sums, "to").join(mine.select("node", "home", "k", "home_size"), "node")
        offers = seen.groupBy("node").agg(F.max(F.when(F.col("to") == F.col("home"), F.col("w"))).alias("own"), F.max(F.when((F.col("to") != F.col("home")) & ~alone, F.struct(gain.alias("gain"), (-F.col("to")).alias("to")))).alias("offer"))
        asked = mine.join(offers, "node", "left").withColumn("own", F.coalesce("own", F.lit(0.0)))
        turn = F.pmod(F.xxhash64("node", F.lit(level), F.lit(step // colours)), F.lit(colours)) == step % colours
        stays = F.col("own") - F.lit(share) * F.col("k") * (F.col("home_sum") - F.col("k"))
        goes = F.coalesce(turn & (F.col("offer.gain") > stays + 1e-12 * total), F.lit(False))
        seen_by = Observation()
        asked = asked.withColumn("goes", goes).observe(seen_by, F.sum(F.col("own") + F.col("loop")).alias("inside"), F.sum(F.col("k") * F.col("home_sum")).alias("square"), F.count_if("goes").alias("moves"))
        after = stage(asked.select("node", F.when(F.col("goes"), -F.col("offer.to")).otherwise(F.col("home")).alias("home"), "k", "loop"))
        got = seen_by.get
        value = got["inside"] / total - resolution * got["square"] / total**2  # of the homes before this step
        if quality is None or value > quality:
            if best is not now:
                unstage(best)
            best, quality = now, value
            any_move = step > 0
        elif best is not now:
            unstage(now)
        still = 0 if got["moves"] else still + 1
        if step % colours == 0:
            if began is not None and value - began < least:
                unstage(after)
                return best, quality, any_move
            began = value
        if still >= colours:
            unstage(after)
            return best, quality, any_move
        now = after
    if now is not best:
        unstage(now)
    return best, quality, any_move
