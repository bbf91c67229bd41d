"""Sharding against a plain search, with hot groups, null and empty texts, ties, repeated rows and clashing columns."""

import hashlib
import random
import zlib
from collections import defaultdict
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from threadloom.llm import sharding


def plain(groups, shards):
    """Shard of each group, in order: the least level is tried from the total downwards by halves."""

    def deal(level):
        out, held = [], None
        for size in groups:
            if held is None or held + size > level:
                out.append((out[-1] if out else -1) + 1)
                held = size
            else:
                out.append(out[-1])
                held += size
        return out

    lo, hi = 0, sum(groups)
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if not groups or deal(mid)[-1] < shards else (mid + 1, hi)
    return deal(lo)


def rows_of(texts, rng):
    return [(rng.choice([None, i, i, 7]), t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("shards", [1, 3, 24])
@pytest.mark.parametrize("digits", [1, 4])
def test_against_plain(spark, monkeypatch, shards, digits):
    rng = random.Random(shards)
    texts = [None, "", "", "é" * 500, "x" * 40_000] + ["copy " * 40] * 120 + ["".join(rng.choices("ab ", k=rng.randint(0, 300))) for _ in range(180)]
    monkeypatch.setattr(sharding.plan, "__defaults__", (digits,))
    docs = spark.createDataFrame(rows_of(texts, rng), "doc_id long, text string").withColumn("size", F.lit("mine")).withColumn("digest", F.lit(0)).repartition(5)
    got = sharding.shard(docs, shards).collect()
    groups = defaultdict(list)
    for t in texts:
        groups[hashlib.sha256((t or "").encode()).hexdigest()].append(len((t or "").encode()) + 8)
    names = sorted(groups)
    place = dict(zip(names, plain([sum(groups[d]) for d in names], shards), strict=True))
    want = sorted((len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), place[hashlib.sha256((t or "").encode()).hexdigest()]) for t in texts)
    assert sorted((r["size"], r["text_crc32"], r["shard"]) for r in got) == want
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sorted(map(str, got)) == sorted(map(str, sharding.shard(docs.repartition(2), shards).collect()))


@pytest.mark.parametrize("seed", range(40))
def test_levels(monkeypatch, seed):
    """The search over prefixes, whatever their first length, against one over all groups."""
    rng = random.Random(seed)
    names = sorted(hashlib.sha256(f"{seed}{i}".encode()).hexdigest() for i in range(rng.choice([1, 9, 200, 2000])))
    sizes = [rng.randint(8, 4000) for _ in names]
    if seed % 2:
        sizes[rng.randrange(len(sizes))] += sum(sizes) // rng.choice([1, 3])
    shards = rng.choice([1, 2, 5, 24])

    def prefixes(base, into, width):
        found = defaultdict(list)
        for d, s in zip(names, sizes, strict=True):
            if into is None or d[: len(into[0])] in into:
                found[d[:width]].append(s)
        return {p: (sum(s), len(s) == 1) for p, s in found.items()}

    monkeypatch.setattr(sharding, "prefixes", prefixes)
    level, cuts = sharding.plan(None, shards, rng.choice([1, 2, 4]))
    place = plain(sizes, shards)
    starts = [names[i] for i in range(1, len(names)) if place[i] != place[i - 1]]
    assert [next(d for d in names if d >= c) for c in cuts] == starts
    per = defaultdict(int)
    for s, p in zip(sizes, place, strict=True):
        per[p] += s
    assert max(per.values()) == max(level, max(sizes))
    sums = [0, *accumulate(sizes)]
    if len(names) <= 200:  # no cut has a smaller largest shard
        best = [0.0] + [float("inf")] * len(names)
        for _ in range(shards):
            best = [0.0] + [min(best[j], *(max(best[i], sums[j] - sums[i]) for i in range(j))) for j in range(1, len(names) + 1)]
        assert best[-1] == max(per.values())


def test_empty_and_files(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.shard(none).count() == 0
    docs = spark.createDataFrame([(i, None if i == 4 else f"text {i % 30}", i) for i in range(90)], "doc_id long, text string, shard int")
    cuts = sharding.write_shards(docs, str(tmp_path / "out"), 5)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 90 and set(docs.columns) < set(back.columns) and len(cuts) == 4
    assert back.groupBy("text").agg(F.countDistinct("_shard").alias("n")).where("n > 1").isEmpty()
    want = {r["doc_id"]: r["shard"] for r in sharding.shard(docs, 5).collect()}
    assert {r["doc_id"]: r["_shard"] for r in back.collect()} == want


def test_no_python_in_plan(spark):
    plan = sharding.shard(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))
