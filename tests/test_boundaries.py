"""Hand-checked cases at the edges of the model's rules."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from threadloom.functions import slugs, text
from threadloom.operators import decisions, dedup, domain, event_log, graph, profile, vault
from threadloom.streaming import incremental

EVENT = "seq long, ts_raw string, session_id string, provider string, target_id string, target_type string, mention_type string, valence string, authorship string"


def log(spark, rows):
    """rows: (target, day, mention type, valence, session)"""
    start = datetime(2026, 1, 1)
    data = [(i, (start + timedelta(days=d)).isoformat(), s, "p" + s[-1], t, "Decision" if t.startswith("d") else "Tool", m, v, "writer") for i, (t, d, m, v, s) in enumerate(rows)]
    return spark.createDataFrame(data, EVENT).withColumn("ts", text.parse_time(F.col("ts_raw")))


@pytest.mark.parametrize("raw,want", [("AcmeTool-Core-v2.1", "acmetool"), ("acmetool-mcp", "acmetool"), ("The Workshop", "workshop"), ("foo-mcp-v2-core", "foo"), ("kimi-k2", "kimi-k2"), ("claude_code", "claude_code"), ("a-mcp", "a-mcp"), ("x the y", "x-y"), ("", "")])
def test_slugs(spark, raw, want):
    once = spark.createDataFrame([(raw,)], "a string").select(slugs.normalise(F.col("a")).alias("a"))
    assert once.first()[0] == want
    assert once.select(slugs.normalise(F.col("a"))).first()[0] == want


def test_aliases(spark):
    t = slugs.alias_table(spark, {"joined": ["Acme Core", "acme-x"], "other": "o"})
    e = spark.createDataFrame([(1, "ACME", None), (2, "plain", None), (3, "Acme-X", "kept")], "seq long, target_id string, mentioned_as string")
    got = {r["seq"]: (r["target_id"], r["mentioned_as"]) for r in slugs.canonical_events(e, t).collect()}
    assert got == {1: ("joined", "ACME"), 2: ("plain", None), 3: ("joined", "kept")}


def test_convergence(spark):
    rows = [("two", 0, "reference", "neutral", "s1")] * 2 + [("three", i, "reference", v, "s1") for i, v in enumerate(["neutral", "confident", "frustrated"])]
    rows += [("stuck", i, "reference", v, "s1") for i, v in enumerate(["positive", "negative", "neutral", "neutral"])] + [("calm", i, "reference", "neutral", "s1") for i in range(3)]
    got = {r["target_id"]: r["status"] for r in profile.convergence(log(spark, rows)).collect()}
    assert got == {"three": "settled", "stuck": "possibly_abandoned_or_stuck", "calm": "ambiguous"}


def test_resurrection_bounds(spark):
    base = [("back", 0, "reference", "x", "s1"), ("back", 1, "reference", "x", "s1"), ("back", 31, "reference", "x", "s1")]
    late = [("old", 0, "reference", "x", "s1"), ("old", 1, "reference", "x", "s1"), ("old", 40, "reference", "x", "s1"), ("now", 54.1, "reference", "x", "s1")]
    assert [r["target_id"] for r in profile.resurrection(log(spark, base)).collect()] == ["back"]
    assert profile.resurrection(log(spark, late)).count() == 0


def test_half_life_is_absolute(spark):
    rows = [("d1", 0, "reference", "x", "s1"), ("d1", 5, "first_introduction", "x", "s1"), ("d1", 6, "reference", "x", "s1")]
    r = profile.half_life(log(spark, rows)).first()
    assert r["half_life_days"] == 5.0 and not r["thrashing"]


def test_concern_resolved_before_raised(spark):
    rows = [("c", 0, "concern_resolved", "x", "s1"), ("c", 3, "concern_raised", "x", "s2")]
    e = log(spark, rows)
    r = profile.concern_lifecycle(e).first()
    assert (r["status"], r["raised"], r["raised_in"]) == ("resolved", 1, "s2")
    assert profile.concern_lifetime(e).first()["lifetime_days"] == 3.0


def test_moves_count_repeats_in_a_session(spark):
    m = spark.createDataFrame([("s1", "x", "me", "gen"), ("s1", "x", "me", "gen")], "session_id string, move string, owner string, level string")
    assert profile.moves(m).first()["state"] == "confirmed"
    assert profile.moves(m, distinct_sessions=True).first()["state"] == "candidate"


def test_mega_session(spark):
    rows = [(f"t{i:02d}", 0, "reference", "x", "big1") for i in range(61)] + [("t00", 0, "reference", "x", "s1"), ("t01", 0, "reference", "x", "s1")]
    e = log(spark, rows)
    assert graph.cochange_meta(e).first()["skipped_mega_sessions"] == 1
    assert [(r["src"], r["dst"]) for r in graph.cochange(e, min_weight=1).orderBy("src").collect()] == [("t00", "t01"), ("t01", "t00")]
    assert (graph.auto_min_weight(199), graph.auto_min_weight(1000)) == (2, 3)


def test_equal_signals_are_half(spark):
    e = log(spark, [(t, 0, "reference", "neutral", "s1") for t in ("a", "b")])
    r = graph.criticality(e, graph.cochange(e, 1)).first()
    assert {r[c] for c in graph.WEIGHTS} == {0.5} and r["score"] == 0.5


@pytest.mark.parametrize("raw,want", [("2026-04", "2026-04"), ("", "unknown"), (None, "unknown"), ("1745474400000", "1745474")])
def test_month(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "t string").select(text.month(F.col("t"))).first()[0] == want


def test_top_ties_keep_first_seen(spark):
    e = log(spark, [(t, 0, "reference", "x", "s1") for t in ("z", "a", "m")])
    assert [r["target_id"] for r in profile.entity_frequency(e, 2).collect()] == ["z", "a"]


def test_merge_moves(spark):
    long = "always write the test before the code and then"
    m = spark.createDataFrame([(long + " run it", "u", "gen", 5), (long + " go home early", "u", "gen", 3), ("nineteen characters", "u", "gen", 2), ("this has nineteen characters inside", "u", "gen", 1)], "move string, owner string, level string, occurrences long")
    got = {r["move"]: r["occurrences"] for r in dedup.merge_moves(m).collect()}
    assert got == {long + " go home early": 8, "nineteen characters": 2, "this has nineteen characters inside": 1}


def test_domain_credit(spark, tmp_path):
    (tmp_path / "viability_verdict.md").write_text("\n".join(f"line {i}" for i in range(8)))
    (tmp_path / "open_questions.md").write_text("\n".join(f"line {i}" for i in range(7)))
    seen = domain.inspect(domain.load(spark, str(tmp_path)))
    assert domain.coverage(seen).first()["coverage"] == pytest.approx(0.30 + 0.025)
    assert {(r["kind"], r["gap"]) for r in domain.gaps(seen).collect()} >= {("open_questions", "stub"), ("industry_map", "missing")}


def test_supersession_and_history(spark):
    rows = [(1, "2026-01-01", "s1", "p", "locked", "use A", ["X"]), (2, "2026-01-02", "s2", "p", "reverted", "drop A", ["x", "y"]), (3, "2026-01-03", "s3", "p", "proposed", "think of x", [])]
    d = spark.createDataFrame(rows, "seq long, ts_raw string, session_id string, provider string, status string, proposition string, related_entities array<string>")
    got = {r["entity"]: (r["links"], r["flips"]) for r in decisions.supersession(d).collect()}
    assert got == {"x": (2, 1)}
    assert [r["seq"] for r in decisions.history(d, "X").collect()] == [1, 2, 3]
    assert [r["seq"] for r in decisions.open_items(d).collect()] == [3]
    assert [r["seq"] for r in decisions.history(d, "X", 0).collect()] == [1, 2, 3]


def test_incremental_equals_full(spark, sf, tmp_path):
    from threadloom.plans import views

    e = views.mention_events(spark, sf)
    part = F.pmod(F.xxhash64("session_id"), F.lit(3))
    halves = [e.where(part == i) for i in range(3)]
    got = incremental.incremental(spark, [*halves, halves[0]], str(tmp_path / "state"), profile.convergence)
    assert sorted(map(str, got.collect())) == sorted(map(str, profile.convergence(e).collect()))


def test_stream_follows_files(spark, sf, tmp_path):
    from threadloom.plans import views

    e = views.mention_events(spark, sf)
    src = str(tmp_path / "in")
    e.where("seq < 500").write.parquet(src)
    stream = lambda: spark.readStream.schema(e.schema).parquet(src)
    for _ in range(2):
        incremental.follow(stream(), str(tmp_path / "state"), str(tmp_path / "check")).awaitTermination()
        e.where("seq >= 500").join(e.where("seq < 500").select("session_id").distinct(), "session_id", "left_anti").select(*e.columns).write.mode("ignore").parquet(str(tmp_path / "more"))
        spark.read.parquet(str(tmp_path / "more")).write.mode("append").parquet(src)
    state = spark.read.parquet(str(tmp_path / "state"))
    assert state.count() == spark.read.parquet(str(tmp_path / "more")).count() + 500


def test_log_round_trip(spark, sf, tmp_path):
    from threadloom.plans import views

    e = views.mention_events(spark, sf)
    path = str(tmp_path / "log")
    event_log.write_months(e, path)
    assert event_log.read_log(spark, path).count() == e.count()
    event_log.append(e, path)
    assert event_log.read_log(spark, path).count() == e.count()


def test_text_functions(spark):
    t = spark.createDataFrame([("a\n```py\nx\n```\nb",)], "t string")
    assert t.select(text.strip_fences(F.col("t"))).first()[0] == "a\n\nb"
    assert t.select(text.escape(F.lit("<a b='c'>&\""))).first()[0] == "&lt;a b=&#x27;c&#x27;&gt;&amp;&quot;"
    assert t.select(text.truncate_tokens(F.lit("aaaa\nbbbb\ncccc"), 3)).first()[0] == "aaaa\nbbbb\n"
    assert t.select(text.common_prefix(F.lit("abcx"), F.lit("abdx"))).first()[0] == 2
    assert t.select(text.lenient_json(F.lit('Sure:\n```json\n{"a": 1}\n```')).cast("string")).first()[0] == '{"a":1}'
    assert t.select(text.repair_json(F.lit("{'a': [1, 2,], 'b': 'x'"))).first()[0] == '{"a": [1, 2], "b": "x"}'
    page = spark.createDataFrame([("n", "# H\n\n## Rules\n- do *this*\nprose\n## Environment\nplain & text\n---")], "name string, text string")
    assert text.compact_markdown(page).first()["xml"] == '<s t="Rules">\n<r>do this</r>\n</s>\n<s t="Environment">\nplain &amp; text\n</s>'
    code = "```\n" + "\n".join(map(str, range(12))) + "\n```"
    assert spark.createDataFrame([(code,)], "t string").select(text.shrink_code("t", F.lit(4))).first()[0] == "```\n0\n1\n… [8 lines elided] …\n10\n11\n```"


def plain_sample(lengths, most):
    """Places and stride of the turns that stay, by trying each stride in turn."""
    joined = lambda x: sum(x) + 2 * max(0, len(x) - 1)
    n = len(lengths)
    if joined(lengths) <= most:
        return list(range(n)), 1
    side = max(1, n // 10)
    tail = list(range(max(0, n - side), n)) if n > side else []
    middle = list(range(side, n - side)) if n > 2 * side else []
    room = most - joined(lengths[:side]) - joined([lengths[i] for i in tail]) - 200
    if middle and room > 0:
        for stride in range(1, max(2, len(middle) // 4 + 1) + 1):
            if joined([lengths[i] for i in middle[::stride]]) <= room:
                return [*range(side), *middle[::stride], *tail], stride
    return [*range(side), *tail], None


def test_sample_turns(spark):
    import random

    rng = random.Random(7)
    sessions = {f"s{k}": [rng.randrange(1, 40) for _ in range(rng.choice([1, 2, 3, 7, 19, 20, 35, 100, 240]))] for k in range(60)}
    t = spark.createDataFrame([(s, 3 * i, "x" * n) for s, v in sessions.items() for i, n in enumerate(v)], "session_id string, index int, text string")
    strides = set()
    for most in (150, 700, 1000, 2500):
        got = text.sample_turns(t, most).collect()
        for s, v in sessions.items():
            own = [r for r in got if r["session_id"] == s]
            places, stride = plain_sample(v, most)
            assert sorted(r["index"] // 3 for r in own) == places and {r["stride"] for r in own} == {stride}
            strides.add(stride)
    assert {None, 1, 2, 3, 5} < strides
    assert text.sample_turns(t).count() == t.count() and text.sample_turns(t.limit(0)).count() == 0


def plain_merge(moves):
    """One scan over all moves (move, owner, level, occurrences), most frequent first."""
    import os
    import re

    norm = lambda t: re.sub("[^a-z0-9]+", " ", t.lower()).strip()
    kept = []
    for m in sorted(moves, key=lambda m: (-m[3], m[0], m[1], m[2])):
        a = norm(m[0])
        for k in kept:
            b = norm(k[0])
            if a and (a in b or b in a) and min(len(a), len(b)) >= 20 or len(os.path.commonprefix([a, b])) >= 40:
                k[3] += m[3]
                k[4] += 1
                k[0] = m[0] if len(m[0]) > len(k[0]) else k[0]
                break
        else:
            kept.append([*m, 1])
    return sorted(map(tuple, kept))


def test_merge_moves_against_one_scan(spark):
    import random

    rng = random.Random(11)
    words = "always check the tests before you write more code and keep every change small".split()
    moves = {("Ship it", "u", "gen"), ("ship it!", "u", "gen"), ("!!", "u", "gen"), ("??", "u", "gen"), ("", "u", "gen"), ("foo-bar is not foobar at all", "u", "gen"), ("foobar is not foobar at all", "u", "gen")}
    for _ in range(250):
        at = rng.randrange(len(words))
        moves.add((" ".join(words[at : at + rng.randrange(2, 9)]) + rng.choice(["", "!", " now", ", " + rng.choice(words)]), rng.choice("ua"), "gen"))
    rows = [(*m, rng.randrange(1, 6)) for m in sorted(moves)]
    got = dedup.merge_moves(spark.createDataFrame(rows, "move string, owner string, level string, occurrences long").repartition(4)).collect()
    assert sorted(tuple(r) for r in got) == plain_merge(rows) and len(got) < len(rows)


def test_canonical_objects(spark):
    d = spark.createDataFrame([(1, "AcmeTool-MCP", ["Foo-core-v2", "bar", "Foo"]), (2, "x", []), (3, None, None)], "seq long, target_id string, related_entities array<string>")
    aliases = spark.createDataFrame([("bar", "baz")], "alias string, canonical string")
    got = {r["seq"]: (r["target_id"], r["mentioned_as"], r["related_entities"]) for r in slugs.canonical_objects(d, aliases).collect()}
    assert got == {1: ("acmetool", "AcmeTool-MCP", ["foo", "baz", "foo"]), 2: ("x", None, []), 3: (None, None, None)}


def test_decisions_about_a_target(spark):
    e = log(spark, [("a", 0, "reference", "positive", "s1"), ("b", 1, "reference", "positive", "s1")])
    d = spark.createDataFrame([(1, "s1", "use it", "a", "it is fast", []), (2, "s1", "drop it", "c", "", ["b"])], "seq long, session_id string, proposition string, target_id string, why string, related_entities array<string>")
    got = {(r["target_id"], r["line"]) for r in vault.decisions_of(e, d).collect()}
    assert got == {("a", "use it _(why: it is fast)_"), ("b", "drop it")}


def test_pages(spark):
    e = log(spark, [("a", 0, "concern_raised", "negative", "s1"), ("b", 1, "reference", "positive", "s1")])
    d = spark.createDataFrame([(1, "s1", "use a", ["a"])], "seq long, session_id string, proposition string, related_entities array<string>")
    page = {r["name"]: r["page"] for r in vault.pages(e, F.lit("2026-01-05").cast("timestamp"), d).collect()}
    assert "use a" in page["a"] and "## Concerns" in page["a"] and "co_mentioned_top: [b]" in page["a"] and "## Concerns" not in page["b"]


def test_page_names_and_sections(spark):
    from threadloom.operators import vault

    e = spark.createDataFrame([(1, "2026-01-01", "s1", "p", n, "T", "concern_raised", "neutral", "user", 'say "x"\nagain') for n in ("a/b", "a b", "A-b", "///", "key: v")], "seq long, ts_raw string, session_id string, provider string, target_id string, target_type string, mention_type string, valence string, authorship string, evidence_quote string").withColumn("ts", F.col("ts_raw").cast("timestamp"))
    r = spark.createDataFrame([(1, "s1", "keep key: v", None), (2, "s1", "other", "a/b")], "seq long, session_id string, rule_text string, applies_to string")
    got = {x["target_id"]: x for x in vault.pages(e, F.lit("2026-01-05").cast("timestamp"), None, r).collect()}
    assert len({x["name"].lower() for x in got.values()}) == 5 and got["///"]["name"] == "unnamed"
    assert 'target_id: "key: v"' in got["key: v"]["page"] and "co_mentioned_top: [" in got["a b"]["page"]
    assert "## Rules touching this entity\n- [[session_s1]] — keep key: v" in got["key: v"]["page"] and "— other" in got["a/b"]["page"] and "## Rules" not in got["a b"]["page"]
    assert '— **concern_raised** — say "x" again' in got["a b"]["page"]
    index = vault.index_page(vault.file_names(e)).first()["page"]
    assert index.startswith("# Vault index\n_5 entities_\n\n- [[unnamed]] — `///`\n") and index.index("`a b`") < index.index("`A-b`") < index.index("`a/b`")


@pytest.mark.parametrize("raw,want", [
    ('{"u": "http://x.org", "n": 1}', '{"u": "http://x.org", "n": 1}'), ("{'a': \"it's\", 'b': 1}", '{"a": "it\'s", "b": 1}'), ("{'a': 'it\'s so', 'b': [True, None,],}", '{"a": "it\'s so", "b": [true, null]}'),
    ('so: {"u": "http://x.org", // note, "no"\n "v": 2 /* { */}  and more', '{"u": "http://x.org", "v": 2}'), ('{"a": "x // y", "b": [1, 2', '{"a": "x // y", "b": [1, 2]}'), ('{"a": "line\nbreak, \\"q\\"",}', '{"a": "line\\nbreak, \\"q\\""}'),
    ("['say \"hi\"']", '["say \\"hi\\""]'), ("no json", None), ("{{{", None), ("", None), (None, None), ('{"a": 1}', '{"a": 1}'),
])
def test_repair_json(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "t string").select(text.repair_json(F.col("t"))).first()[0] == want


def test_tumbling_is_exact_in_a_stream(spark, sf, tmp_path):
    from threadloom.plans import views

    e = views.mention_events(spark, sf)
    e.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(e.schema).parquet(str(tmp_path / "in"))
    q = incremental.tumbling(stream).writeStream.format("memory").queryName("tumbled").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(str, spark.table("tumbled").collect())) == sorted(map(str, incremental.tumbling(e).collect()))


def test_decisions_of_given_sessions(spark, sf):
    from threadloom.plans import views

    few = spark.createDataFrame([("1",), ("7",), ("7",), (None,), ("none",)], "session_id string")
    got, want = views.decisions(spark, sf, few), views.decisions(spark, sf).where("session_id in ('1', '7')")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.columns == want.columns and want.count()
