"""Session runs, enrichment, reflections, drafts, rewritten files, stored profiles and input chains on small files."""

import json

import pytest
from pyspark.sql import functions as F

from threadloom.operators import drafts, extract, graph, vault
from threadloom.plans.compilers import Profile, compile_profile, compile_projects
from threadloom.sources import profiles, rewriting, transcripts
from threadloom.sources.writing import write_texts


def put(root, name, data):
    p = root / name
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(data if isinstance(data, str) else json.dumps(data, indent=2))


def scripted_model():
    def scripted(system, user, tokens):
        """A model that overruns once in the drifts phase, judges in verify and critique, and fails on a broken session."""
        if "broken" in user:
            raise RuntimeError("down")
        if "_verdict: " in user and "_critique" not in user:
            objects = json.loads(user.split("\n\n")[1])
            for i, o in enumerate(objects["mention_events"]):
                if isinstance(o, dict):
                    o["_verdict"] = "Supported" if i % 2 == 0 else "unsupported"
            return "```json\n" + json.dumps({**objects, "decisions": "no list"}) + "\n```", "stop"
        if "_critique_verdict" in user:
            objects = json.loads(user.split("\n\n")[1])
            for o in objects["mention_events"]:
                o |= {"_critique_verdict": "drop" if o["target_id"] == "c" else "keep", "_critique_reason": "r"}
            return json.dumps(objects), "stop"
        if "corrected the other" in user:
            return ("", "length") if tokens == extract.BUDGET else (json.dumps({"drifts": [{"trigger": "t"}]}), "stop")
        if "mention_events" in user:
            return "Here: " + json.dumps({"mention_events": [{"target_id": x} for x in "abc"] + ["junk"]}), "stop"
        return "no json", "stop"

    return scripted


def test_run_sessions(spark):
    s = spark.createDataFrame([("s1", "p", "text"), ("s2", "p", "broken"), ("s3", "p", None)], "session_id string, provider string, text string")
    got = {r["session_id"]: r for r in extract.run_sessions(s, scripted_model()).collect()}
    doc, log = json.loads(got["s1"]["document"]), json.loads(got["s1"]["log"])
    assert doc["mention_events"] == [{"target_id": "a"}] and doc["drifts"] == [{"trigger": "t"}] and doc["decisions"] == [] and set(extract.KINDS) <= set(doc)
    assert {"phase": "drifts", "retry": 2 * extract.BUDGET} in log["phases"] and [x["phase"] for x in log["phases"]][-1] == "critique"
    assert got["s2"]["document"] is None and "RuntimeError" in got["s2"]["error"] and got["s3"]["document"] is not None
    objects, log = extract.run_session("text", scripted_model(), fast=True)
    assert [o["target_id"] for o in objects["mention_events"]] == ["a", "c"] and log[-1]["phase"] == "verify"
    assert extract.run_session("", extract.budgeted(extract.rule_based))[0]["decisions"] == []


def test_enrich(spark):
    e = spark.createDataFrame([(i, f"2026-01-0{i % 9 + 1}", "s", f"p{i % 2}", t, "Tool", "neutral", q) for i, (t, q) in enumerate([("a", "one"), ("a", "two"), ("a", ""), ("b", "x"), ("c", None), ("d", "y")])], "seq long, ts_raw string, session_id string, provider string, target_id string, target_type string, valence string, evidence_quote string")
    top = spark.createDataFrame([(t, "Tool", 3, "p0,p1") for t in "abcd"], "target_id string, target_type string, event_count long, providers string")
    pages = spark.createDataFrame([("a", "# a\n## Mention log\n- x\n"), ("b", "# b\n")], "target_id string, page string")
    answer = json.dumps({"what": "a thing", "status": "active", "representative_quotes": [{"quote": " one ", "provider": "p0", "why": "w"}]})
    got = {r["target_id"]: r for r in extract.enrich(top, e, pages, lambda s, u: "nothing" if "Entity: b" in u else answer).collect()}
    assert [(got[t]["contexts"], got[t]["status"]) for t in "abcd"] == [(2, "merged"), (1, "parse_failed"), (0, "skipped_no_contexts"), (1, "no_vault_page")]
    page = got["a"]["page"]
    assert "**What:** a thing" in page and "**How used:** —" in page and '- [p0] "one" — _w_' in page and page.index("## Semantic summary") < page.index("## Mention log")
    again = spark.createDataFrame([("a", page)], "target_id string, page string")
    assert extract.enrich(top.where("target_id = 'a'"), e, again, lambda s, u: answer).first()["page"].count("## Semantic summary") == 1


def test_reflection(spark):
    a = spark.createDataFrame([("s", "drift", "### Own\ntext\n"), ("s", "decisions", "said"), ("s", "moves", " "), ("s", "none", "x")], "session_id string, lens string, answer string")
    s = spark.createDataFrame([("s", "p"), ("t", None)], "session_id string, provider string")
    got = {r["session_id"]: r["page"] for r in extract.reflection(a, s, project="P").collect()}
    assert got["s"].endswith("# Session reflection\n\n### Decisions\n\nsaid\n\n### Own\ntext\n") and "lens_count: 2" in got["s"] and "lens_count: 0" in got["t"]


def some_profile(spark):
    return {
        "top_entities": spark.createDataFrame([("acme-app", "Project", 5, "p"), ("acme", "Tool", 2, "p"), ("other", "Tool", 1, "q")], "target_id string, target_type string, event_count long, providers string"),
        "rules": spark.createDataFrame([(1, "use acme-app well", "x", "project_domain", ""), (2, "be kind", "gen", "meta_user", "acme-app"), (3, "be brief", "gen", "project_domain", " Acme-App ")], "seq long, rule_text string, level string, bucket string, scope string"),
        "concern_lifecycle": spark.createDataFrame([("acme-app-oom", 3), ("x", 1)], "target_id string, raised long"),
        "moves": spark.createDataFrame([("m", "confirmed", 2), ("n", "candidate", 1)], "move string, state string, occurrences long"),
    }


def test_drafts(spark, tmp_path):
    p = some_profile(spark)
    own = drafts.slices(p, "Acme-App")
    assert {n: f.count() for n, f in own.items()} == {"entities": 2, "rules": 1, "concerns": 1, "moves": 1}
    assert sorted(r["seq"] for r in drafts.project_rules(p["rules"], "acme-app").collect()) == [1, 3]
    put(tmp_path, "canvas/nodes/b/meta.json", {"kind": "goal", "title": "T", "intent": "i" * 2000})
    put(tmp_path, "canvas/nodes/a/meta.json", {"intent": "first"})
    put(tmp_path, "canvas/nodes/c/meta.json", "{")
    put(tmp_path, "canvas/nodes/d/meta.json", {"title": "no intent"})
    assert drafts.canvas_intent(spark, str(tmp_path)).first()["text"] == "### ?: ?\nfirst\n\n### goal: T\n" + "i" * 1500
    assert drafts.canvas_intent(spark, str(tmp_path / "none")).first()["text"] == ""
    put(tmp_path, "domain_brain/industry_map.md", "r" * 3000)
    asked = drafts.prompts(spark, str(tmp_path), "Acme-App", p, ["industry_map", "open_questions"])
    got = {r["kind"]: r for r in asked.collect()}
    assert got["industry_map"]["reference_present"] and "r" * 2000 in got["industry_map"]["user"] and "r" * 2001 not in got["industry_map"]["user"] and not got["open_questions"]["reference_present"]
    assert "- acme-app (5 events, p)\n- acme (2 events, p)" in got["open_questions"]["user"] and "- use acme-app well" in got["open_questions"]["user"]
    made = {r["kind"]: r for r in drafts.draft(asked, lambda s, u: "## X" if "Industry Map" in s else " ", "Acme-App", F.lit("T")).collect()}
    assert made["industry_map"]["text"].endswith("reference_present: True\n---\n\n## X") and made["open_questions"]["status"] == "empty_content" and made["open_questions"]["text"] is None
    with pytest.raises(ValueError):
        drafts.prompts(spark, str(tmp_path), "x", p, ["nothing"])
    assert "".join(compile_projects(Profile(p), min_rules=1)) == "Acme-App"
    text = compile_profile(Profile(p, "acme-app"), "light_ir_project")
    assert "use acme-app well" in text and "be brief" in text and "be kind" not in text


def test_documents_in_place(spark, tmp_path):
    put(tmp_path, "p/s1.json", {"n": 1, "mention_events": [{"target_id": "Foo-MCP"}, {"target_id": "bar", "mentioned_as": "B"}, 7], "decisions": [{"target_id": "x", "related_entities": ["The Foo", 3, "bar"]}], "rules": [{"target_id": "Kept-MCP"}]})
    put(tmp_path, "p/s2.json", {"mention_events": [{"target_id": "plain"}], "decisions": None})
    put(tmp_path, "p/bad.json", "{")
    put(tmp_path, "p/global_profile.json", {"mention_events": [{"target_id": "Foo-MCP"}]})
    aliases = spark.createDataFrame([("bar", "baz")], "alias string, canonical string")
    run = lambda: write_texts(rewriting.canonical_documents(spark, str(tmp_path), aliases), None, "path", "text").collect()
    assert [r["path"].rsplit("/", 1)[1] for r in run()] == ["s1.json"]
    got = json.loads((tmp_path / "p/s1.json").read_text())
    assert got["mention_events"] == [{"target_id": "foo", "mentioned_as": "Foo-MCP"}, {"target_id": "baz", "mentioned_as": "B"}, 7] and got["n"] == 1
    assert got["decisions"] == [{"target_id": "x", "related_entities": ["foo", 3, "baz"]}] and got["rules"] == [{"target_id": "Kept-MCP"}]
    assert run() == [] and sorted(x.name for x in (tmp_path / "p").iterdir() if not x.name.endswith(".crc")) == ["bad.json", "global_profile.json", "s1.json", "s2.json"]


def test_canvas(spark, tmp_path):
    nodes = {"a": {"title": "The Foo MCP", "x": [1]}, "b": {"label": "Bar", "slug_canonical": "old", "id": "n2"}, "c": {"title": 5}, "d": {"raw_title": "Bar", "slug_canonical": "bar"}}
    for n, v in nodes.items():
        put(tmp_path, f"{n}.json", v)
    look = lambda force: {r["node_id"]: (r["old_slug"], r["new_slug"], r["outcome"]) for r in rewriting.canvas_slugs(spark, str(tmp_path), force=force).collect()}
    assert look(False) == {"a": (None, "foo", "rewritten"), "n2": ("old", "bar", "skipped"), "c": (None, None, "skipped"), "d": ("bar", "bar", "skipped")}
    assert look(True)["n2"] == ("old", "bar", "rewritten") and look(True)["d"][2] == "skipped"
    out = rewriting.canvas_slugs(spark, str(tmp_path), at=F.lit("T")).where("outcome = 'rewritten'")
    assert len(write_texts(out, None, "path", "text").collect()) == 1
    assert json.loads((tmp_path / "a.json").read_text()) == {"title": "The Foo MCP", "x": [1], "slug_canonical": "foo", "canonicalized_at": "T"}
    assert look(False)["a"] == ("foo", "foo", "skipped")


def test_profiles(spark, tmp_path):
    p = some_profile(spark)
    profiles.save(p, str(tmp_path / "p"))
    (tmp_path / "p/scale").mkdir()
    (tmp_path / "p/scale/part-0.parquet").write_text("no parquet")
    back = profiles.load(spark, str(tmp_path / "p"))
    assert set(p) <= set(back) and all(back[n].schema == p[n].schema and sorted(map(str, back[n].collect())) == sorted(map(str, p[n].collect())) for n in p)
    assert profiles.load(spark, str(tmp_path / "none")) == {}
    put(tmp_path, "rules.json", {"rules": [{"rule_text": "r", "session": "s", "classification": {"bucket": "project_domain", "scope": "acme"}}, 3]})
    got = profiles.classified_rules(spark, str(tmp_path / "none.json"), str(tmp_path / "rules.json"))
    assert [(r["rule_text"], r["bucket"], r["scope"], r["session_id"]) for r in got.where("rule_text is not null").collect()] == [("r", "project_domain", "acme", "s")]
    assert profiles.classified_rules(spark, str(tmp_path / "none.json")).columns == got.columns


def test_input_chain(spark, tmp_path):
    put(tmp_path, "both/session.json", {"session_id": "s", "turns": [{"role": "user", "text": "doc", "timestamp": 1767225600000}]})
    put(tmp_path, "both/raw.log", "> log\n")
    put(tmp_path, "log/raw.log", "> log\n")
    put(tmp_path, "a.jsonl", json.dumps({"type": "user", "timestamp": 5, "message": {"content": "line"}}))
    load = lambda **kw: [r["text"] for r in transcripts.load_session(spark, **kw).collect()]
    d = str(tmp_path)
    assert load(session_dir=f"{d}/both") == ["doc"] and load(session_dir=f"{d}/log") == ["log"] and load(jsonl=f"{d}/a.jsonl", session_dir=f"{d}/both") == ["line"] and load(session_json=f"{d}/both/session.json") == ["doc"]
    with pytest.raises(ValueError):
        load()
    with pytest.raises(ValueError):
        load(session_dir=f"{d}/none")
    assert transcripts.structured(spark, f"{d}/both", coerce=False).first()["timestamp"] == "1767225600000"
    assert transcripts.claude_code(spark, f"{d}/a.jsonl", coerce=False).first()["timestamp"] == "5"


def test_shards_and_communities(spark, tmp_path):
    edges = spark.createDataFrame([("app/a", "app/b", 3, 1), ("app/b", "app/a", 3, 1), ("x", "y", 2, 1)], "src string, dst string, weight long, rank int")
    scores = spark.createDataFrame([("app/a", 0.5)], "target_id string, score double")
    write_texts(graph.shards(graph.ripple(edges, scores)), str(tmp_path), suffix=".json").collect()
    assert json.loads((tmp_path / "app-a.json").read_text()) == {"target": "app/a", "neighbors": [{"target": "app/b", "weight": 3}], "criticality": 0.5}
    assert "criticality" not in json.loads((tmp_path / "x.json").read_text()) and not list(tmp_path.glob(".*.tmp"))
    c = spark.createDataFrame([("app/a", 0), ("app/b", 0), ("x", 1), ("y", 1)], "node string, community int")
    assert {r["community"]: (r["size"], r["members"]) for r in graph.community_table(c, 1).collect()} == {0: (2, ["app/a"]), 1: (2, ["x"])}
    assert graph.community_meta(edges, c).first().asDict() == {"n_communities": 2, "total_modules": 4, "total_edges": 2, "modularity": 0.375, "resolution": 1.0}
    assert vault.file_names(spark.createDataFrame([], "target_id string")).count() == 0
