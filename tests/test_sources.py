"""Transcript readers, the extraction scan and artifacts on small files."""

import json

import pytest
from pyspark.sql import functions as F

from threadloom.operators import extract, profile
from threadloom.plans.compilers import TARGETS, Profile, compile_profile, compile_projects, tokens
from threadloom.sources import extractions, transcripts


def put(root, name, data):
    p = root / name
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(data if isinstance(data, str) else json.dumps(data, indent=2))


def turns(df):
    return [(r["session_id"], r["index"], r["role"], r["text"], r["thinking"], r["timestamp"]) for r in df.orderBy("session_id", "index").collect()]


def test_chat_lines(spark, tmp_path):
    lines = [{"type": "user", "timestamp": "2026-01-01T00:00:00Z", "message": {"role": "user", "content": "hi"}}, {"type": "summary"}, {"type": "assistant", "timestamp": 1767225600000, "message": {"content": [{"type": "thinking", "thinking": "hm"}, {"type": "text", "text": "yo"}, {"type": "tool_use", "name": "x"}]}}, {"type": "user", "message": {"role": "tool", "content": "no"}}]
    put(tmp_path, "local_a.jsonl", "\n".join(map(json.dumps, lines)) + "\nnot json\n")
    assert turns(transcripts.claude_code(spark, str(tmp_path))) == [("a", 0, "user", "hi", "", "2026-01-01T00:00:00Z"), ("a", 1, "assistant", "yo", "hm", "2026-01-01T00:00:00Z")]
    put(tmp_path / "d", "local_s1/audit.jsonl", json.dumps({"type": "user", "_audit_timestamp": "T", "message": {"content": "q"}}))
    assert turns(transcripts.claude_desktop(spark, str(tmp_path / "d"))) == [("s1", 0, "user", "q", "", "T")]


def test_order_of_lines(spark, tmp_path):
    put(tmp_path, "s.jsonl", "\n".join(json.dumps({"type": "user", "message": {"content": f"m{i}"}}) for i in range(40)))
    assert [t[3] for t in turns(transcripts.claude_code(spark, str(tmp_path)))] == [f"m{i}" for i in range(40)]
    put(tmp_path, "t/raw.log", "one\ntwo\n\n> three\nfour\n\nfive")
    assert [(r, t) for _, _, r, t, _, _ in turns(transcripts.terminal(spark, str(tmp_path / "t")))] == [("assistant", "one\ntwo"), ("user", "three\nfour"), ("assistant", "five")]


def test_documents(spark, tmp_path):
    put(tmp_path, "g/s.json", {"messages": [{"type": "user", "content": "hi"}, "junk", {"type": "gemini", "content": [{"text": "a"}, {"text": "b"}], "thoughts": [{"text": "t"}], "tokens": {"n": 1}}, {"type": "info", "content": "x"}]})
    put(tmp_path, "g/bad.json", "{")
    assert turns(transcripts.gemini_cli(spark, str(tmp_path / "g"))) == [("s", 0, "user", "hi", "", None), ("s", 1, "assistant", "a\nb", "t", None)]
    put(tmp_path, "c/ui_messages.json", [{"type": "say", "say": "text", "text": "x" * 6000, "ts": 1767225600000}, {"type": "tool", "text": "no"}])
    put(tmp_path, "c/api.json", [{"role": "user", "content": "q"}, {"role": "tool", "content": "no"}])
    got = turns(transcripts.cline(spark, str(tmp_path / "c")))
    assert [(s, r, len(t)) for s, _, r, t, _, _ in got] == [("api", "user", 1), ("ui_messages", "assistant", 5000)]
    put(tmp_path, "a/uuid/plan.md", "# plan")
    assert transcripts.antigravity(spark, str(tmp_path / "a")).first()["artifacts"][0]["filename"] == "plan.md"
    put(tmp_path, "t/sid/raw.log", "> do it\n\n\x1b[31mdone\x1b[0m\n")
    assert [(r, t) for _, _, r, t, _, _ in turns(transcripts.terminal(spark, str(tmp_path / "t")))] == [("user", "do it"), ("assistant", "done")]
    put(tmp_path, "p/s9.json", {"session_id": "s9", "turns": [{"role": "user", "text": "hey"}]})
    s = transcripts.normalised(transcripts.reader("structured")(spark, str(tmp_path / "p")))
    assert json.loads(transcripts.to_json(s).first()["json"])["turns"][0]["text"] == "hey"
    assert set(transcripts.providers()) == {"claude_code", "claude_desktop", "gemini_cli", "cline", "structured", "terminal", "antigravity"}


DOC = {
    "session_id": "s1", "provider": "p", "session_meta": {"timestamp_start": "2026-01-05T00:00:00"},
    "mention_events": [{"target_id": "Acme-MCP", "target_type": "Tool", "mention_type": "reference", "valence": "confident", "timestamp": "2026-01-01T00:00:00"}, "junk", {"target_id": "x", "timestamp": 5}, {"target_id": ""}],
    "decisions": [{"proposition": "use it", "status": "locked", "related_entities": ["Acme", "", 3]}, 7], "rules": [{"rule_text": "be kind", "level": "gen"}], "mental_moves": [{"move": "m", "owner": "u", "level": "g"}] * 2,
}


def test_extractions(spark, tmp_path):
    put(tmp_path, "p/s1.json", DOC)
    put(tmp_path, "q/s1.json", {"session_id": "twice"})
    put(tmp_path, "p/bad.json", "{")
    put(tmp_path, "p/list.json", [1])
    put(tmp_path, "p/global_profile.json", {"mention_events": [{"target_id": "no"}]})
    put(tmp_path, "p/_logs/x.json", {"mention_events": [{"target_id": "no"}]})
    put(tmp_path, "p/1767225600000.json", {"mention_events": [{"target_id": "y"}]})
    docs = extractions.scan(spark, [str(tmp_path)])
    e = {r["target_id"]: r for r in extractions.mention_events(docs).collect()}
    assert set(e) == {"Acme-MCP", "x", "y"} and e["x"]["ts_raw"] == "5" and e["y"]["ts_raw"].startswith("2026-01-01") and e["y"]["provider"] == "p"
    d = extractions.decisions(docs).collect()
    assert [(r["proposition"], r["related_entities"], r["ts_raw"]) for r in d] == [("use it", ["Acme", "3"], "2026-01-05T00:00:00")]
    assert {r["session_id"]: r["rules"] for r in extractions.session_counts(docs).collect()}["s1"] == 1
    assert extractions.scan(spark, [str(tmp_path)], ["q"]).count() == 1


def test_artifacts_and_cli(spark, sf, tmp_path, capsys):
    from threadloom import cli
    from threadloom.plans.catalogue_more import _profile

    p = Profile({n: f.cache() for n, f in _profile(spark, sf).items()}, "src3")
    for name in TARGETS:
        out = compile_profile(p, name)
        assert out and (name in ("boot_context", "brain_view") or tokens(out) <= TARGETS[name][1] + 1)
    small = compile_profile(p, "light_ir", 60)
    assert "<ent-top" not in small and small.startswith("<user-profile")
    json.loads(compile_profile(p, "boot_context"))
    assert len(json.loads(compile_profile(p, "brain_view"))["fibers"]) == 22
    assert "src3" in compile_projects(p)
    put(tmp_path, "p/s1.json", DOC)
    assert cli.main(["compile", str(tmp_path / "p"), "--target", "claude_md"]) == 0
    assert "be kind" in capsys.readouterr().out
    assert cli.main(["pipeline", str(tmp_path / "p"), "--out", str(tmp_path / "o")]) == 0
    assert (tmp_path / "o/profile/convergence").is_dir() and (tmp_path / "o/events").is_dir()
    assert "# acme\n" in (tmp_path / "o/entities/acme.md").read_text() and "_2 entities_" in (tmp_path / "o/entities/INDEX.md").read_text()
    capsys.readouterr()

    def run(*argv):
        assert cli.main(list(argv)) == 0
        return capsys.readouterr().out

    stored = ["--profile", str(tmp_path / "o/profile")]
    assert "be kind" in run("compile", "-", "--target", "claude_md", *stored)
    state = json.loads(run("brain", "-", *stored))
    assert len(state["regions"]) == 8 and len(state["fibers"]) == 20 and len(state["hypotheses"]) == 10 and state["timeline"] == []
    assert json.loads(run("brain", str(tmp_path / "p")))["timeline"]
    line = {"type": "user", "timestamp": "2026-01-01T00:00:00Z", "message": {"content": "FooBar and GPU\n```\ncode\n```"}}
    put(tmp_path, "t/s7.jsonl", json.dumps(line))
    run("extract", str(tmp_path / "t"), "--out", str(tmp_path / "x"))
    made = json.loads((tmp_path / "x/claude_code/s7.json").read_text())
    assert {m["target_id"] for m in made["mention_events"]} >= {"FooBar", "GPU"}
    assert "# Session reflection" in run("reflect", str(tmp_path / "t"))
    assert "industry_map" in run("draft", str(tmp_path), "--project", "acme", *stored)
    assert "acme" in run("canonicalize", str(tmp_path / "p")) and run("canonicalize", str(tmp_path / "p"), "--apply") and run("canonicalize", str(tmp_path / "p"), "--apply") == ""
    run("ripple", str(tmp_path / "p"), "--out", str(tmp_path / "o"))


def test_extraction_surface(spark):
    s = spark.createDataFrame([("s", "p", "We use FooBar and foo-bar with GPU.")], "session_id string, provider string, text string")
    got = extract.extract(s, phases=["mentions"]).collect()
    assert {m["target_id"] for m in json.loads(got[0]["answer"])["mention_events"]} == {"FooBar", "foo-bar", "GPU"}

    def broken(system, user):
        raise ValueError

    assert extract.call(broken, "", "") is None
    r = spark.createDataFrame([("a rule",)], "rule_text string")
    assert extract.classify(r).first()["bucket"] == "project_domain"
    assert extract.classify(r, lambda s, u: "meta_user").first()["bucket"] == "meta_user"
    assert extract.classify(r, broken).first()["bucket"] == "project_domain"
    k = spark.createDataFrame([("keep",), ("DROP",), (None,), ("",)], "critique string")
    assert extract.keep_after_critique(k).count() == 3
    assert extract.lenses(s.select("session_id", F.col("text").alias("brief"))).count() == 6
    assert profile.moves(spark.createDataFrame([("x", "u", "g", "s")], "move string, owner string, level string, session_id string")).first()["state"] == "candidate"


def test_bundled_documents_scan_as_files_do(spark, tmp_path):
    from threadloom.sources import writing

    texts = [("p1/a", '{"session_id": "s", "mention_events": [{"target_id": "x"}]}'), ("p0/a", '{"provider": "q", "mention_events": [{"target_id": "y", "ts": "t"}], "unresolved": [{"text": "open"}]}'), ("p0/b", "no json"), ("p0/c", "[1]"), ("p0/_meta", "{}"), (".hidden/d", "{}"), ("p2/e", "{}")]
    docs = spark.createDataFrame(texts, "name string, text string")
    writing.write_texts(docs, f"{tmp_path}/files", suffix=".json").agg(F.sum("bytes")).collect()
    writing.write_bundle(docs, f"{tmp_path}/bundle", suffix=".json")
    seen = {}
    for name, scan, folder in (("files", extractions.scan, "files"), ("bundle", extractions.scan_bundles, "bundle")):
        for providers in (None, ["p0"]):
            d = scan(spark, [f"{tmp_path}/{folder}"], providers)
            rows = [(r["path"].rpartition(f"/{folder}/")[2], r["session_id"], r["provider"], r["j"]) for r in d.withColumn("j", F.to_json("v")).collect()]
            open_ = [(r["ts"], r["session_id"], r["text"]) for r in extractions.unresolved(d).collect()]
            seen[name, providers is None] = (sorted(rows), open_)
    assert seen["files", True] == seen["bundle", True] and seen["files", False] == seen["bundle", False]
    assert [r[:3] for r in seen["bundle", True][0]] == [("p0/a.json", "a", "q"), ("p2/e.json", "e", "p2")]


@pytest.mark.parametrize("name", ["extraction_events", "unresolved_concerns"])
def test_documents_of_events_take_few_files(spark, sf, name):
    from threadloom.plans import catalogue

    found = catalogue.QUERIES[name](spark, sf)
    assert 0 < len(found.inputFiles()) <= 64 and found.count() > 64
