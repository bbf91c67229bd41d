"""Profiles kept up to date target by target: keyed state that survives restarts, updated by the targets a batch touches.

Each target's state is its facts: counts, first and last times, its last events, and the sessions it has been told of, in a
map of their own. A micro-batch reads and writes the state of its own targets alone; nothing joins a batch with all that
came before. The state store must be RocksDB (spark.sql.streaming.stateStore.providerClass)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.profile import SETTLED, STUCK

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FACTS = "target_id string, target_type string, event_count long, providers string, first_seen timestamp, last_seen timestamp, last_valences string, status string, raised long, resolved long"
STATE = "target_type string, type_seq long, event_count long, providers array<string>, first_key string, first_seq long, first_seen timestamp, last_seen timestamp, tail_keys array<string>, tail_seqs array<long>, tail_valences array<string>, tail_mentions array<string>, raised long, resolved long"


class Facts(StatefulProcessor):
    """A target's facts. Events of a session that the target had in an earlier batch are dropped, so a session that is read
    again changes nothing; late sessions are new ones."""

    def __init__(self, last: int = 3):
        self.last = last

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.facts = handle.getValueState("facts", STATE)
        self.sessions = handle.getMapState("sessions", "session_id string", "events long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        e = pd.concat(list(rows))
        names = e["session_id"].fillna("")
        new = [s for s in names.unique() if not self.sessions.containsKey((s,))]
        e = e[names.isin(new)]
        if e.empty:
            return
        for s, n in e["session_id"].fillna("").value_counts().items():
            self.sessions.updateValue((s,), (int(n),))
        none = (None, None, 0, [], None, None, None, None, [], [], [], [], 0, 0)
        kind, kind_seq, count, providers, first_key, first_seq, first_seen, last_seen, keys, seqs, valences, mentions, raised, resolved = self.facts.get() if self.facts.exists() else none
        e = e.assign(k=e["ts_raw"].fillna("")).sort_values(["k", "seq"])
        low = e.loc[e["seq"].idxmin()] if e["seq"].is_unique else e.sort_values("seq").iloc[0]
        if kind_seq is None or low["seq"] < kind_seq:
            kind, kind_seq = low["target_type"], int(low["seq"])
        head = e.iloc[0]
        if first_seq is None or (head["k"], head["seq"]) < (first_key, first_seq):
            first_key, first_seq, first_seen = head["k"], int(head["seq"]), self.time(head["ts"])
        few = e.tail(self.last)
        tail = list(zip(keys, seqs, valences, mentions, [None] * len(keys), strict=True)) + list(zip(few["k"], few["seq"].map(int), few["valence"], few["mention_type"], few["ts"], strict=True))
        tail = sorted(tail, key=lambda t: t[:2])[-self.last :]
        if tail[-1][4] is not None:
            last_seen = self.time(tail[-1][4])
        keys, seqs, valences, mentions = ([t[i] for t in tail] for i in range(4))
        count += len(e)
        providers = sorted({*providers, *e["provider"].dropna()})
        raised += int((e["mention_type"] == "concern_raised").sum())
        resolved += int((e["mention_type"] == "concern_resolved").sum())
        self.facts.update((kind, kind_seq, count, providers, first_key, first_seq, first_seen, last_seen, keys, seqs, valences, mentions, raised, resolved))
        good = any(v in SETTLED or m == "concern_resolved" for v, m in zip(valences, mentions, strict=True))
        status = "settled" if good else "possibly_abandoned_or_stuck" if any(v in STUCK for v in valences) else "ambiguous"
        yield pd.DataFrame({"target_id": [key[0]], "target_type": [kind], "event_count": [count], "providers": [",".join(providers)], "first_seen": [first_seen], "last_seen": [last_seen], "last_valences": [",".join(v or "" for v in valences)], "status": [status], "raised": [raised], "resolved": [resolved]})

    def time(self, value: object) -> object:
        return None if pd.isna(value) else pd.Timestamp(value).to_pydatetime()

    def close(self) -> None:
        pass


def facts_of(stream: DataFrame, last: int = 3) -> DataFrame:
    """The facts of each target that a micro-batch touches, as they are after it. Events without a target take no part."""
    e = stream.where("target_id is not null and target_id <> ''").select("target_id", "seq", "ts_raw", "ts", "session_id", "provider", "target_type", "mention_type", "valence")
    return e.groupBy("target_id").transformWithStateInPandas(statefulProcessor=Facts(last), outputStructType=FACTS, outputMode="Update", timeMode="None")


def follow_targets(stream: DataFrame, out: str, checkpoint: str, interval: str | None = None, last: int = 3) -> StreamingQuery:
    """Keep a table of facts in `out`: each micro-batch writes its touched targets in a folder of its own, over whatever a
    failed run of the same batch left there. Without an interval what is there is taken and the query ends."""

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    w = facts_of(stream, last).writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=interval) if interval else w.trigger(availableNow=True)).start()


def current(spark: SparkSession, out: str) -> DataFrame:
    """The table that follow_targets keeps: each target's facts of the last batch that touched it."""
    t = spark.read.schema(FACTS + ", batch long").parquet(out)
    newest = t.groupBy("target_id").agg(F.max("batch").alias("batch"))
    return t.join(newest, ["target_id", "batch"]).drop("batch")
