"""Substring dedup by level-wise doubling.

Level 1: seeds of 9 words, chosen so that every window of `length` words holds one (the smallest seed hash in it, the
leftmost of ties; the choice depends on the window's words alone, so equal windows choose alike). Level 2: seeds that
repeat are extended to twice their length, forwards or backwards by where the window lies. Level 3: what repeats there is
extended to the windows themselves, whole runs of windows first, then single windows where the runs of a group differ.
Each level counts only what the one before has left; a window is judged on its full word sequence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import few_texts, release, row_key, spread_join, stage, unstage

#: Base of the rolling hash (odd, so invertible modulo 2**64).
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Words of a worker's chunk and of its memo of word hashes.
CHUNK, MEMO = 300_000, 1 << 18


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Rolling:
    """Hashes of any window of a sequence of word hashes."""

    powers = np.ones(1, np.uint64)
    inverses = np.ones(1, np.uint64)

    def __init__(self, x: np.ndarray):
        while len(self.powers) <= len(x):
            n = len(self.powers)
            for name, base in (("powers", BASE), ("inverses", INVERSE)):
                old = getattr(Rolling, name)
                setattr(Rolling, name, np.concatenate((old, old * np.uint64(pow(base, n, 1 << 64)))))
        self.sums = np.concatenate(([np.uint64(0)], np.cumsum(x * self.inverses[: len(x)], dtype=np.uint64)))

    def __call__(self, at: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return _mix((self.sums[at + length] - self.sums[at]) * self.powers[at])


def runs(roll: Rolling, starts: np.ndarray, sizes: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, ...]:
    """Of documents at these places of the sequence: (document, seed, first window, last window) of each run of windows
    that choose the same seed."""
    full = np.flatnonzero(sizes >= length)
    none = np.empty(0, np.int64)
    if not len(full):
        return none, none, none, none
    windows = sizes[full] - length + 1
    doc = np.repeat(full, windows)
    at = np.repeat(starts[full] - np.concatenate(([0], np.cumsum(windows)[:-1])), windows) + np.arange(windows.sum())
    total = len(roll.sums) - 1
    seeds = roll(np.arange(total - seed + 1), seed)
    slide = np.lib.stride_tricks.sliding_window_view(seeds, length - seed + 1)
    chosen = np.concatenate([at[i : i + 65536] + slide[at[i : i + 65536]].argmin(axis=1) for i in range(0, len(at), 65536)])
    new = np.flatnonzero(np.concatenate(([True], (chosen[1:] != chosen[:-1]) | (doc[1:] != doc[:-1]))))
    last = np.concatenate((new[1:], [len(at)])) - 1
    return doc[new], chosen[new], at[new], at[last]


def _chunks(texts: list[bytes | None], memo: _Hashes) -> Iterator[tuple[int, np.ndarray, np.ndarray, Rolling]]:
    """(first text, starts, sizes, rolling hashes) of groups of whole texts."""
    first, held, parts = 0, 0, []
    for i, text in enumerate(texts):
        words = (text or b"").split()
        parts.append(np.fromiter(map(memo.__getitem__, words), np.uint64, len(words)))
        held += len(words)
        if held >= CHUNK or i == len(texts) - 1:
            sizes = np.array([len(p) for p in parts])
            yield first, np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes, Rolling(np.concatenate(parts))
            first, held, parts = i + 1, 0, []


def _seeds(docs: DataFrame, length: int, seed: int) -> DataFrame:
    """Level 1: (hash, key, at) of every chosen seed; at is its place in the document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Hashes()
        for b in few_texts(batches):
            keys = b.column(0).to_numpy()
            for first, starts, sizes, roll in _chunks(b.column(1).to_pylist(), memo):
                doc, at, _, _ = runs(roll, starts, sizes, length, seed)
                h = roll(at, seed).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(keys[first + doc]), pa.array((at - starts[doc]).astype(np.int32))], ["hash", "key", "at"])

    return docs.select("key", "text").mapInArrow(run, "hash long, key long, at int")


def _extended(docs: DataFrame, length: int, seed: int) -> DataFrame:
    """Levels 2 and 3 of documents with `ats`, the places of their seeds that repeat: for each half of a seed's run the
    hash of twice the seed, the hash of the run's words, its first and last window and the windows' hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Hashes()
        for b in few_texts(batches):
            ids, keys, ats = b.column(0), b.column(1).to_numpy(), b.column(3)
            ends = np.asarray(ats.offsets) - ats.offsets[0].as_py()
            values = ats.flatten().to_numpy()
            for first, starts, sizes, roll in _chunks(b.column(2).to_pylist(), memo):
                doc, at, lo, hi = runs(roll, starts, sizes, length, seed)
                n = len(starts)
                own = np.repeat(np.arange(n), np.diff(ends[first : first + n + 1]))
                kept = np.isin(at, values[ends[first] : ends[first + n]] + starts[own])
                doc, at, lo, hi = doc[kept], at[kept], lo[kept], hi[kept]
                room = length - 2 * seed  # a window whose seed lies up to here holds the words that follow it
                forward = np.maximum(lo, at - room), hi, at
                backward = lo, np.minimum(hi, at - room - 1), at - seed
                for kind, (a, z, twice) in enumerate((forward, backward)):
                    ok = a <= z
                    d, p, a, z, twice = doc[ok], at[ok], a[ok], z[ok], twice[ok]
                    if not len(d):
                        continue
                    h2 = roll(twice, 2 * seed) + np.uint64(kind)
                    whole = _mix(roll(a, z - a + length) + ((p - a) * 4096 + (z - a)).astype(np.uint64))
                    count = z - a + 1
                    offsets = np.concatenate(([0], np.cumsum(count)))
                    windows = np.repeat(a - offsets[:-1], count) + np.arange(offsets[-1])
                    hs = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(roll(windows, length).view(np.int64)))
                    i = first + d
                    cols = [pa.array(h2.view(np.int64)), pa.array(whole.view(np.int64)), ids.take(pa.array(i)), pa.array(keys[i]), pa.array((a - starts[d]).astype(np.int32)), pa.array((z - starts[d]).astype(np.int32)), hs]
                    yield pa.RecordBatch.from_arrays(cols, ["twice", "whole", "doc_id", "key", "a", "z", "windows"])

    return docs.mapInArrow(run, "twice long, whole long, doc_id long, key long, a int, z int, windows array<long>")


def repeated_spans(docs: DataFrame, length: int = 35, seed: int = 9) -> DataFrame:
    """(doc_id, key, spans): the first and last windows [a, z] (places of their first words) of every run of windows of
    `length` words whose word sequence also starts anywhere else. key is row_key(); needs 3 * seed - 1 <= length <= 4 * seed."""
    if not 3 * seed - 1 <= length <= 4 * seed:
        raise ValueError("a seed must reach the window's length in two doublings")
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), row_key().alias("key"), F.col("text").cast("binary").alias("text"))
    seeds = stage(_seeds(texts, length, seed), "seeds")
    repeats = stage(seeds.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1"), "repeats")
    alive = spread_join(seeds, repeats.select("hash"), ["hash"], ["key", "at"], counts=repeats).select("key", "at").distinct()
    alive = stage(alive.groupBy("key").agg(F.collect_list("at").alias("ats")), "alive")
    unstage(seeds, repeats)
    release(spark)
    level2 = stage(_extended(texts.join(alive, "key").select("doc_id", "key", "text", "ats"), length, seed), "level2")
    release(spark)
    groups = level2.groupBy("twice").agg(F.count("*").alias("n"), F.min("whole").alias("lo"), F.max("whole").alias("hi")).where("n > 1")
    groups = stage(groups.select("twice", "n", (F.col("lo") == F.col("hi")).alias("alike")), "groups")
    repeated = lambda rows, of: spread_join(rows, of.select("twice"), ["twice"], ["key", "a"], counts=of.select("twice", "n"))
    alike = repeated(level2.drop("windows", "whole"), groups.where("alike")).select("doc_id", "key", "a", "z")
    mixed = repeated(level2.drop("whole"), groups.where("not alike"))
    single = stage(mixed.select("twice", "doc_id", "key", "a", F.posexplode("windows").alias("i", "hash")).withColumn("a", F.col("a") + F.col("i")).drop("i"), "single")
    again = stage(single.groupBy("twice", "hash").agg(F.count("*").alias("n")).where("n > 1"), "again")
    single_again = spread_join(single, again.drop("n"), ["twice", "hash"], ["key", "a"], counts=again).select("doc_id", "key", "a", F.col("a").alias("z"))
    spans = alike.unionByName(single_again).groupBy("doc_id", "key").agg(F.collect_set(F.struct("a", "z")).alias("spans"))
    out = stage(spans, "spans")
    unstage(alive, level2, groups, single, again)
    release(spark)
    return out


def substring_dedup(docs: DataFrame, length: int = 35, seed: int = 9) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by one space), removed (spans [first, last word]).

    Words are runs of anything but ASCII white space, unchanged. Null and empty texts have no words; texts of fewer than
    `length` words keep all. Repeated rows are documents of their own, so their windows repeat. Null ids take part. Very
    long texts are taken whole, in chunks of whole documents. Other columns are ignored, whatever their names; an empty
    table gives no row. A passage that a third of all documents share is dealt over tasks."""
    spans = repeated_spans(docs, length, seed)
    texts = docs.select(F.col("doc_id").cast("long"), row_key().alias("key"), F.col("text").cast("binary").alias("text"))
    joined = texts.join(spans, (texts["key"] == spans["key"]) & texts["doc_id"].eqNullSafe(spans["doc_id"]), "left")
    joined = joined.select(texts["doc_id"], "text", F.transform("spans", lambda s: s["a"]).alias("a"), F.transform("spans", lambda s: s["z"]).alias("z"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in few_texts(batches):
            n_words, n_removed, kept, removed = [], [], [], []
            for text, first, last in zip(b.column(1).to_pylist(), b.column(2), b.column(3), strict=True):
                words = (text or b"").split()
                spans: list[tuple[int, int]] = []
                if first.is_valid:
                    edge = np.zeros(len(words) + 1, np.int32)
                    np.add.at(edge, first.values.to_numpy(), 1)
                    np.add.at(edge, last.values.to_numpy() + length, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    turn = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
                    spans = list(zip(turn[::2].tolist(), (turn[1::2] - 1).tolist(), strict=True))
                left, at = [], 0
                for a, z in spans:
                    left += words[at:a]
                    at = z + 1
                left = left + words[at:] if spans else words
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                kept.append(b" ".join(left))
                removed.append([{"first": a, "last": z} for a, z in spans])
            kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()), pa.array(removed, kind)], ["doc_id", "n_words", "n_removed", "kept", "removed"])

    out = joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept binary, removed array<struct<first: int, last: int>>")
    return out.withColumn("kept", F.col("kept").cast("string"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return substring_dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP9_SQL = r"""
with w as (select row_number() over () as rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
s as (select rid, unnest(range(1, len(ws) - 33)) as p0, ws from w where len(ws) >= 35),
h as (select rid, p0, array_to_string(list_slice(ws, p0, p0 + 34), ' ') as win from s),
r as (select rid, p0 from (select *, count(*) over (partition by win) as n from h) where n > 1),
gone as (select distinct rid, unnest(range(p0, p0 + 35)) as pos from r),
g as (select rid, list(pos) as poss, count(*) as n from gone group by rid)
select doc_id, len(ws)::bigint as n_words, coalesce(n, 0)::bigint as n_removed,
  sha256(array_to_string(case when poss is null then ws else [ws[i] for i in range(1, len(ws) + 1) if not list_contains(poss, i)] end, ' ')) as kept_sha256
from w left join g using (rid)
"""
