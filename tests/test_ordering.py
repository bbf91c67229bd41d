"""Order over whole frames, hot keys and the full profile, against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from threadloom.operators import decisions, graph, ordering, profile
from threadloom.plans import views


def rows(spark, hot=0.5, n=2000):
    """One key has half of all rows; times tie."""
    rng = random.Random(1)
    data = [("hot" if rng.random() < hot else rng.choice([None, "a", "b", "c"]), rng.randint(0, 200), i, rng.choice(["x", "y", None])) for i in range(n)]
    return data, spark.createDataFrame(data, "k string, t int, seq long, v string").repartition(6)


def test_numbered(spark):
    data, frame = rows(spark)
    got = {r["seq"]: r["rank"] for r in ordering.numbered(frame, [F.col("t").desc(), F.col("seq")]).collect()}
    assert got == {d[2]: i for i, d in enumerate(sorted(data, key=lambda d: (-d[1], d[2])), 1)}
    assert ordering.numbered(frame.limit(0), [F.col("t")]).count() == 0


@pytest.mark.parametrize("parts", ["1", "16"])
def test_previous(spark, parts):
    data, frame = rows(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {r["seq"]: (r["previous_t"], r["previous_seq"], r["previous_v"]) for r in ordering.with_previous(frame, ["k"], [F.col("t"), F.col("seq")], ["t", "seq", "v"]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want, last = {}, {}
    for k, t, seq, v in sorted(data, key=lambda d: (d[1], d[2])):
        want[seq] = last.get(k, (None, None, None))
        last[k] = (t, seq, v)
    assert got == want


def test_first_per_key_is_bounded_before_the_shuffle(spark):
    data, frame = rows(spark)
    few = ordering.first_per_key(frame, ["k"], [F.col("t"), F.col("seq")], 3)
    want = set()
    for k in {d[0] for d in data}:
        want |= {(k, d[2]) for d in sorted((d for d in data if d[0] == k), key=lambda d: (d[1], d[2]))[:3]}
    assert {(r["k"], r["seq"]) for r in few.collect()} == want
    plan = few._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[2]
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Partial") == 1


@pytest.mark.parametrize("name", ["convergence", "drift", "moves", "load_bearing", "half_life"])
def test_no_hot_key_is_sorted_whole(spark, sf, name):
    """Every window of these is limited on the map side, and no sort meets all rows of a key."""
    e = views.mention_events(spark, sf)
    frame = {
        "convergence": lambda: profile.convergence(e), "drift": lambda: profile.drift_recurrence(e, "valence", "target_id"), "load_bearing": lambda: decisions.load_bearing(views.decisions(spark, sf)),
        "moves": lambda: profile.moves(views.rules(spark, sf).withColumnsRenamed({"rule_text": "move", "provider": "owner"}).withColumn("session_id", F.lit("s"))), "half_life": lambda: profile.half_life(e),
    }[name]()
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == plan.count("WindowGroupLimit [") > 0


def test_full_profile_reads_the_log_once(spark, sf):
    e = views.mention_events(spark, sf)
    d = views.decisions(spark, sf)
    out = profile.full_profile(e, d, {"rules": views.rules(spark, sf)})
    alone = {
        "convergence": profile.convergence(e), "concern_lifecycle": profile.concern_lifecycle(e), "cross_provider": profile.cross_provider(e), "top_entities": profile.entity_frequency(e), "idea_resurrection": profile.resurrection(e),
        "decision_half_life": profile.half_life(e), "concern_lifetime": profile.concern_lifetime(e), "provider_cognition": profile.provider_cognition(e), "scale": profile.scale(e, {"rules": views.rules(spark, sf)}), "load_bearing": decisions.load_bearing(d),
    }
    for name, want in alone.items():
        assert sorted(map(str, out[name].select(*want.columns).collect())) == sorted(map(str, want.collect())), name
        if name != "load_bearing":
            assert "events.parquet" not in out[name]._jdf.queryExecution().executedPlan().toString()


def test_ranked_has_no_window_over_all(spark):
    s = spark.createDataFrame([(f"t{i:03}", float(i % 7)) for i in range(200)], "target_id string, score double")
    got = [(r["rank"], r["target_id"]) for r in graph.ranked(s).orderBy("rank").collect()]
    assert got == list(enumerate(sorted((f"t{i:03}" for i in range(200)), key=lambda t: (-(int(t[1:]) % 7), t)), 1))
    assert [(r["rank"], r["target_id"]) for r in graph.ranked(s, 9).orderBy("rank").collect()] == got[:9]


def test_index_of_events_without_a_time(spark):
    """Half of all events have no time: they are lines of a month of their own, none is lost."""
    from threadloom.operators import event_log

    rows = [(f"t{i % 5}", None if i % 2 else f"2026-0{1 + i % 3}-01T00:00:{i % 60:02}", f"s{i % 7}", i) for i in range(400)]
    got = event_log.index(spark.createDataFrame(rows, "target_id string, ts_raw string, session_id string, seq long").repartition(5)).collect()
    lines = {}
    for r in got:
        for ref in r["refs"]:
            lines.setdefault(ref["file"], []).append((ref["line"], ref["ts"], r["target_id"]))
    assert sum(map(len, lines.values())) == 400 and len(lines["unknown.jsonl"]) == 200
    for name, found in lines.items():
        want = sorted((t or "", s, q, target) for target, t, s, q in rows if ((t or "")[:7] or "unknown") + ".jsonl" == name)
        assert sorted(found) == [(i, w[0], w[3]) for i, w in enumerate(want)]


def test_a_long_session_is_sampled_in_ranges(spark):
    from threadloom.functions import text

    rows = [("hot", i, "x" * (i % 7)) for i in range(3000)] + [(None, i, "y" * 5) for i in range(40)] + [("one", 1, "z" * 900)]
    frame = spark.createDataFrame(rows, "session_id string, index int, text string").repartition(5)
    plan = text.sample_turns(frame, 8000, note=20)._jdf.queryExecution().optimizedPlan().toString()
    assert not any("_i#" in x or "text#" in x for x in plan.splitlines() if "Window [" in x)
    got = {(r["session_id"], r["index"]): r["stride"] for r in text.sample_turns(frame, 8000, note=20).collect()}
    hot = [(i, i % 7) for s, i, x in rows if s == "hot" and x]
    n, side = len(hot), len(hot) // 10
    edge, mid = hot[:side] + hot[n - side :], hot[side : n - side]
    room = 8000 - 20 - (sum(x + 2 for _, x in hot[:side]) - 2) - (sum(x + 2 for _, x in hot[n - side :]) - 2)
    stride = min(d for d in range(1, max(2, len(mid) // 4 + 1) + 1) if sum(x + 2 for _, x in mid[::d]) <= room + 2)
    assert {i for s, i in got if s == "hot"} == {i for i, _ in edge + mid[::stride]}
    assert {s for k, s in got.items() if k[0] == "hot"} == {stride} and {k for k in got if k[0] != "hot"} == {(None, i) for i in range(40)} | {("one", 1)}
