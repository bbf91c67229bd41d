"""Keyed state and the stream of session files: restarts, changed files, and the same as in batch."""

import os

import pytest
from pyspark.sql import functions as F

from threadloom.operators import profile
from threadloom.plans import views
from threadloom.sources import watching
from threadloom.streaming import keyed


@pytest.fixture
def rocksdb(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, keyed.ROCKSDB)
    yield
    spark.conf.unset(key)


def test_keyed_state_equals_batch(spark, sf, tmp_path, rocksdb):
    """Sessions in shuffled files, two runs with one checkpoint, a file that tells sessions again."""
    e = views.mention_events(spark, sf).cache()
    third = F.pmod(F.xxhash64("session_id"), F.lit(3))
    folder, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    read = lambda: spark.readStream.schema(e.schema).parquet(folder)
    e.where(third == 1).coalesce(1).write.mode("append").parquet(folder)
    keyed.follow_targets(read(), out, checkpoint).awaitTermination()
    e.where(third == 0).coalesce(1).write.mode("append").parquet(folder)
    e.where(third == 1).coalesce(1).write.mode("append").parquet(folder)
    keyed.follow_targets(read(), out, checkpoint).awaitTermination()
    touched = spark.read.parquet(f"{out}/batch=1").count()
    assert touched == e.where(third == 0).select("target_id").distinct().count()
    e.where(third == 2).coalesce(1).write.mode("append").parquet(folder)
    keyed.follow_targets(read(), out, checkpoint).awaitTermination()
    got = keyed.current(spark, out)
    want = profile.convergence(e, least=1)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    raised = {r["target_id"]: (r["raised"], r["resolved"]) for r in profile.concern_lifecycle(e).collect()}
    assert {r["target_id"]: (r["raised"], r["resolved"]) for r in got.where("raised > 0").collect()} == raised


def test_session_files(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    put = lambda name, text, at: ((folder / name).parent.mkdir(parents=True, exist_ok=True), (folder / name).write_text(text), os.utime(folder / name, (at, at)))

    def run():
        q = watching.watch(spark, str(folder), ".json", filesPerPartition="2").writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(once=True).start()
        q.awaitTermination()
        return sorted((os.path.relpath(r["path"], folder), r["text"]) for r in spark.read.parquet(out).collect())

    put("a/1.json", "one", 1000)
    put("a/2.json", "two", 1000)
    put("b/3.json", "three", 1001)
    put("b/note.txt", "no", 1001)
    put("b/.hidden.json", "no", 1001)
    first = [("a/1.json", "one"), ("a/2.json", "two"), ("b/3.json", "three")]
    assert run() == first and run() == first
    put("a/1.json", "one again", 1002)
    put("c/4.json", "four", 1003)
    assert run() == sorted([*first, ("a/1.json", "one again"), ("c/4.json", "four")])
    assert run() == sorted([*first, ("a/1.json", "one again"), ("c/4.json", "four")])


def test_stale_inputs(spark, tmp_path):
    for place, name, at in (("in", "a.jsonl", 10), ("in", "b.jsonl", 10), ("in", "c.jsonl", 30), ("out", "a.json", 10), ("out", "c.json", 20)):
        (tmp_path / place).mkdir(exist_ok=True)
        (tmp_path / place / name).write_text(name)
        os.utime(tmp_path / place / name, (at, at))
    left = watching.stale(watching.files(spark, str(tmp_path / "in")), watching.files(spark, str(tmp_path / "out")))
    assert sorted(os.path.basename(r["path"]) for r in left.collect()) == ["b.jsonl", "c.jsonl"]
    assert watching.files(spark, str(tmp_path / "none")).count() == 0
