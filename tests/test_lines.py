"""Files of lines in ranges, and a log read by its index."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from threadloom.operators import event_log, graph
from threadloom.plans import views
from threadloom.sources import lines, transcripts


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_places(spark, small_splits, tmp_path):
    texts = {"a.txt": "".join(f"line {i} é\r\n" if i % 3 else "\n" for i in range(900)) + "no end", "b.txt": "x\n" * 5, "c.txt": ""}
    for name, t in texts.items():
        (tmp_path / name).write_bytes(t.encode())
    got = lines.offsets(lines.lines(spark, str(tmp_path))).collect()
    assert len({r["block"] for r in got if r["path"].endswith("a.txt")}) > 3
    for name, t in texts.items():
        data, rows = t.encode(), sorted((r for r in got if r["path"].endswith(name)), key=lambda r: (r["block"], r["n"]))
        assert [data[r["offset"] : r["offset"] + r["length"]].decode() for r in rows] == [r["line"] for r in rows] == [x for x in t.split("\n")][: len(rows)]
        assert len(rows) == len(t.split("\n")) - (t.endswith("\n") or not t)


def test_a_large_session_is_many_tasks(spark, small_splits, tmp_path):
    said = [{"type": "user" if i % 2 else "assistant", "timestamp": i, "message": {"role": "user" if i % 2 else "assistant", "content": f"turn {i} " + "x" * (i % 90)}} for i in range(700)]
    body = [json.dumps(t) for t in said]
    body[5:5] = ["", "no json", '{"type": "summary"}', '{"type": "user", "message": {"content": ""}}']
    (tmp_path / "s1.jsonl").write_text("\n".join(body))
    (tmp_path / "s2.jsonl").write_text("\n".join(body[:3]) + "\n")
    turns = transcripts.claude_code(spark, str(tmp_path))
    got = {s: [(r["index"], r["text"]) for r in turns.where(F.col("session_id") == s).orderBy("index").collect()] for s in ("s1", "s2")}
    assert got["s1"] == [(i, t["message"]["content"]) for i, t in enumerate(said)]
    assert got["s2"] == got["s1"][:3]
    assert lines.lines(spark, str(tmp_path)).rdd.getNumPartitions() > 5


def test_log_by_index(spark, small_splits, tmp_path, sf):
    e = views.mention_events(spark, sf)
    path = str(tmp_path / "log")
    event_log.write_months(e, path, files=3)
    index = {r["target_id"]: r["refs"] for r in event_log.file_index(spark, path).collect()}
    target = max(index, key=lambda t: len(index[t]))
    for r in index[target]:
        data = (tmp_path / "log" / r["file"]).read_bytes()[r["offset"] : r["offset"] + r["length"]]
        assert json.loads(data)["target_id"] == target and json.loads(data)["ts"] == r["ts"]
    refs = spark.createDataFrame([tuple(r[c] for c in ("file", "offset", "length")) for r in index[target]], "file string, offset long, length long")
    log = event_log.read_log(spark, path)
    want = log.where(F.col("target_id") == target)
    assert Counter(map(str, event_log.read_refs(spark, path, refs).select(want.columns).collect())) == Counter(map(str, want.collect()))
    assert sum(map(len, index.values())) == log.count()
    ordered = lambda d: sorted(map(str, d.select("session_id", "target_id", "n", "valence", "concern", "date").collect()))
    assert ordered(graph.session_targets(event_log.logged_events(spark, path))) == ordered(graph.session_targets(e))


def test_append_of_events_without_a_time(spark, tmp_path):
    path, now = str(tmp_path / "log"), F.lit("2026-05-06").cast("timestamp")
    rows = [(1, "2026-01-02T00:00:00", "s1", "a"), (2, None, "s1", "b"), (3, "", "s2", "c")]
    e = spark.createDataFrame(rows, "seq long, ts_raw string, session_id string, target_id string")
    event_log.append(e, path, "p", now)
    event_log.append(e, path, "p", now)
    got = sorted((r["ym"], r["target_id"], r["project"]) for r in event_log.read_log(spark, path).collect())
    assert got == [("2026-01", "a", "p"), ("2026-05", "b", "p"), ("2026-05", "c", "p")]
    assert {r["target_id"]: r["refs"][0]["file"][:10] for r in event_log.file_index(spark, path).collect()} == {"a": "ym=2026-01", "b": "ym=2026-05", "c": "ym=2026-05"}
