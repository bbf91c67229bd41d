"""Graph operators beyond the sizes of the test tables."""

import random
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from threadloom.operators import graph, vault

LONG, SHORT = [f"t{i:03}" for i in range(90)], ["t000", "t001", "x"]


def log(spark):
    rows = [("long", t) for t in LONG] * 2 + [("short", t) for t in SHORT] + [("one", "alone"), ("one", "")]
    return spark.createDataFrame([(s, t, i) for i, (s, t) in enumerate(rows)], "session_id string, target_id string, seq long")


def test_long_sessions_make_all_pairs(spark):
    want = {p: 1 for s in (LONG, SHORT) for p in permutations(s, 2)} | {("t000", "t001"): 2, ("t001", "t000"): 2}
    for block in (graph.BLOCK, 7):
        rows = graph.co_mentions(log(spark), block=block).collect()
        assert len(rows) == len(want) and {(r["src"], r["dst"]): r["weight"] for r in rows} == want
    capped = graph.cochange(log(spark), min_weight=1).collect()
    assert {(r["src"], r["dst"]) for r in capped} == set(permutations(SHORT, 2))


def test_vault_lists_partners_of_long_sessions(spark):
    e = log(spark).withColumns({"ts": F.timestamp_seconds("seq"), "ts_raw": F.col("seq").cast("string"), "provider": F.lit("p"), "target_type": F.lit("File"), "valence": F.lit("neutral")})
    got = {r["target_id"]: r["co_mentioned"] for r in vault.entities(e, F.lit("2024-03-01").cast("timestamp")).collect()}
    assert got["t050"] == "t000,t001,t002,t003,t004,t005" and got["t000"] == "t001,t002,t003,t004,t005,t006" and got["alone"] == ""


def sequential(edges, resolution=1.0):
    """Louvain node by node, in the order of names: the plain version."""
    graph = {}
    for s, d, w in sorted(edges):
        for a, b in ((s, d), (d, s)):
            graph.setdefault(a, {})[b] = graph.setdefault(a, {}).get(b, 0.0) + w
    member = {v: v for v in graph}
    while True:
        degree = {v: sum(near.values()) for v, near in graph.items()}
        total, home, weight = sum(degree.values()), {v: v for v in graph}, dict(degree)
        changed = moved = True
        while moved:
            moved = False
            for v in sorted(graph):
                near = {}
                for u, w in graph[v].items():
                    if u != v:
                        near[home[u]] = near.get(home[u], 0.0) + w
                own = home[v]
                weight[own] -= degree[v]
                value = lambda c: near.get(c, 0.0) - resolution * weight[c] * degree[v] / total  # noqa: B023, E731
                best = max(sorted(near), key=value, default=own)
                if best == own or value(best) <= value(own) + 1e-12:
                    best = own
                weight[best] += degree[v]
                if best != own:
                    home[v], moved = best, True
        member = {v: home[c] for v, c in member.items()}
        changed = len(set(home.values())) < len(graph)
        if not changed:
            return member
        merged = {}
        for v, near in graph.items():
            for u, w in near.items():
                row = merged.setdefault(home[v], {})
                row[home[u]] = row.get(home[u], 0.0) + w
        graph = merged


def planted(rng, n, groups, inside, across):
    p = lambda i, j: inside if i % groups == j % groups else across
    return [(f"{i:04}", f"{j:04}", float(rng.randint(1, 5))) for i in range(n) for j in range(i + 1, n) if rng.random() < p(i, j)]


def grown(rng, n):
    """Each node links to two earlier ones, the more the more links these have."""
    ends, out = [0], []
    for i in range(1, n):
        for j in {rng.choice(ends), rng.choice(ends)}:
            out.append((f"{i:04}", f"{j:04}", 1.0))
            ends += [i, j]
    return out


@pytest.mark.parametrize("kind", ["planted", "grown", "ring"])
def test_communities_are_as_good_as_one_by_one(spark, kind):
    rng = random.Random(5)
    edges = {"planted": lambda: planted(rng, 300, 8, 0.25, 0.02), "grown": lambda: grown(rng, 600), "ring": lambda: [(f"{i:03}", f"{j:03}", 5.0) for g in range(0, 180, 6) for i in range(g, g + 6) for j in range(i + 1, g + 6)] + [(f"{g:03}", f"{(g + 6) % 180:03}", 1.0) for g in range(0, 180, 6)]}[kind]()
    frame = spark.createDataFrame(edges, "src string, dst string, weight double")
    found = graph.louvain(frame).cache()
    plain = spark.createDataFrame(list(sequential(edges).items()), "node string, community string")
    assert {r["node"] for r in found.collect()} == {x for s, d, _ in edges for x in (s, d)}
    assert {r["community"] for r in found.collect()} == set(range(found.select("community").distinct().count()))
    assert graph.modularity(frame, found).first()[0] >= 0.98 * graph.modularity(frame, plain).first()[0]
    assert "Pandas" not in found._jdf.queryExecution().toString()


def test_communities_of_no_edges(spark):
    assert graph.louvain(spark.createDataFrame([], "src string, dst string, weight double")).count() == 0


def test_large_graphs_get_modularity_communities(spark):
    # a ring of 5,000 groups of six: one connected component of 30,000 targets
    groups = 5000
    i, n = F.col("id"), 6 * groups
    inside = spark.range(n).select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(5)), lambda j: F.struct(i.alias("s"), (i - i % 6 + j).alias("d")))).alias("e")).where("e.s <> e.d").select("e.s", "e.d", F.lit(5).alias("weight"))
    ring = spark.range(groups).select((i * 6).alias("s"), ((i * 6 + 6) % n).alias("d"), F.lit(1).alias("weight"))
    ring = ring.unionByName(ring.select(F.col("d").alias("s"), F.col("s").alias("d"), "weight"))
    edges = inside.unionByName(ring).select(F.lpad(F.col("s").cast("string"), 6, "0").alias("src"), F.lpad(F.col("d").cast("string"), 6, "0").alias("dst"), "weight")
    found = graph.louvain(edges).cache()
    assert found.count() == n and found.select("community").distinct().count() > 100
    together = found.groupBy((F.col("node").cast("long") / 6).cast("long").alias("g")).agg(F.count_distinct("community").alias("n"))
    assert together.where("n <> 1").count() == 0
