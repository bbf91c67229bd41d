"""SimHash near-dedup by deletion-variant signatures.

Two 64-bit fingerprints that differ in at most k bits, cut into k // 2 + 1 segments, agree in some segment up to one bit.
So each fingerprint is indexed under every one-wildcard variant of every segment; an equality join on variants finds all
candidates and the Hamming distance verifies them. Groups are the connected components of the links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import few_texts, free, release, row_key, spread_join, stage, unstage

#: Rows of one variant key that one task compares; larger buckets are dealt out in pairs of blocks.
BLOCK = 4096
#: Buckets up to this size are compared row against row at once, larger ones by growing components.
SMALL = 32
#: Shingles hashed at once in a worker.
CHUNK = 1 << 20


def _majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each run of hashes (of these sizes, none 0) the bits set in over half of them."""
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    pieces = -(-sizes // 255)  # byte lanes hold up to 255
    first = np.concatenate(([0], np.cumsum(pieces)[:-1]))
    cuts = np.repeat(starts, pieces) + 255 * (np.arange(pieces.sum()) - np.repeat(first, pieces))
    out = np.zeros(len(sizes), np.uint64)
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & np.uint64(0x0101010101010101), cuts)
        counts = np.add.reduceat(lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        for j in range(8):
            out |= (2 * counts[:, j] > sizes).astype(np.uint64) << np.uint64(8 * j + k)
    return out


def simhash(texts: list[bytes | None], words: int = 4, seed: int = 42) -> np.ndarray:
    """Fingerprints of whole texts: A-Z lower-cased, words split at ASCII white space, all shingles with repeats."""
    out = np.zeros(len(texts), np.uint64)
    pending: list[np.ndarray] = []
    at: list[int] = []

    def flush() -> None:
        if at:
            out[at] = _majority(np.concatenate(pending), np.array([len(x) for x in pending]))
            pending.clear()
            at.clear()

    held = 0
    for i, text in enumerate(texts):
        w = (text or b"").lower().split()
        if not w:
            continue
        shingles = map(b" ".join, zip(*[w[j:] for j in range(words)], strict=False)) if len(w) > words else [b" ".join(w)]
        n = max(1, len(w) - words + 1)
        pending.append(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64, n))
        at.append(i)
        held += n
        if held > CHUNK:
            flush()
            held = 0
    flush()
    return out


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """doc_id, key (row_key), fp (the fingerprint as a signed long); texts without words have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in few_texts(batches):
            fp = simhash(b.column(2).to_pylist(), words)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))], ["doc_id", "key", "fp"])

    return docs.select(F.col("doc_id").cast("long"), row_key().alias("key"), F.col("text").cast("binary")).mapInArrow(run, "doc_id long, key long, fp long")


def segments(k: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the k // 2 + 1 segments of 64 bits."""
    n = k // 2 + 1
    edge = [64 * i // n for i in range(n + 1)]
    return [(edge[i], edge[i + 1] - edge[i]) for i in range(n)]


def variants(fp: Column, k: int) -> Column:
    """Array of 64 keys: for each bit its segment with that bit taken out, tagged with the bit."""

    def signed(x: int) -> int:
        return x - (1 << 64) if x >> 63 else x

    keys = []
    for first, bits in segments(k):
        for w in range(first, first + bits):
            mask = ((1 << bits) - 1) << first & ~(1 << w)
            rest = F.shiftrightunsigned(fp.bitwiseAND(F.lit(signed(mask)).cast("long")), first)
            # segments of up to 56 bits leave room for the tag; the whole word (k < 2) is mixed with it instead
            keys.append(F.shiftleft(F.lit(w).cast("long"), 58).bitwiseXOR(rest) if bits <= 58 else F.xxhash64(rest, F.lit(w)))
    return F.array(*keys)


def _links(key: np.ndarray, fp: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside each run of equal keys: all of small runs, a spanning forest of large ones."""
    a: list[np.ndarray] = []
    b: list[np.ndarray] = []
    if len(key) < 2:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.concatenate((start, [len(key)])))
    small = np.repeat(size <= SMALL, size)
    for lag in range(1, min(SMALL, int(size.max()))):
        i = np.flatnonzero((key[lag:] == key[:-lag]) & small[lag:])
        if not len(i):
            break
        x, y = fp[i], fp[i + lag]
        near = (np.bitwise_count(x ^ y) <= k) & (x != y)
        a.append(x[near])
        b.append(y[near])
    for s, n in zip(start[size > SMALL], size[size > SMALL], strict=True):
        rest = np.unique(fp[s : s + n])
        while len(rest):
            queue, rest = [rest[0]], rest[1:]
            while queue and len(rest):
                x = queue.pop()
                near = np.bitwise_count(rest ^ x) <= k
                if near.any():
                    found, rest = rest[near], rest[~near]
                    a.append(np.full(len(found), x))
                    b.append(found)
                    queue.extend(found)
    if not a:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    a_, b_ = np.concatenate(a), np.concatenate(b)
    pairs = np.unique(np.stack((np.minimum(a_, b_), np.maximum(a_, b_)), axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def near_links(fps: DataFrame, k: int = 4) -> DataFrame:
    """Links (a, b) between distinct fingerprints `fp` at most k bits apart, enough of them to connect every linked pair.

    Within a bucket of over SMALL fingerprints only a spanning forest of its links is kept; buckets of over BLOCK are cut
    into blocks by hash and each pair of blocks is a task's work of its own, so no bucket meets in one task."""
    conf = fps.sparkSession.conf.get("spark.sql.shuffle.partitions")
    fps = fps.repartition(max(int(conf), fps.sparkSession.sparkContext.defaultParallelism), "fp")  # each row becomes 64
    keyed = fps.select("fp", F.explode(variants(F.col("fp"), k)).alias("key"))
    hot = keyed.groupBy("key").count().where(F.col("count") > BLOCK).select("key", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    keyed = keyed.join(hot, "key", "left")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.least(own, j) * F.col("blocks") + F.greatest(own, j))
    keyed = keyed.select("key", "fp", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(pairs)).alias("pair"))
    dealt = keyed.repartition("key", "pair").sortWithinPartitions("key", "pair").select(F.xxhash64("key", "pair").alias("key"), "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.empty(0, np.int64), np.empty(0, np.uint64)
        for b in batches:
            key = np.concatenate((key, b.column(0).to_numpy()))
            fp = np.concatenate((fp, b.column(1).to_numpy().view(np.uint64)))
            if len(key) < 200_000:
                continue
            cut = len(key) - int(np.argmax(key[::-1] != key[-1])) if key[0] != key[-1] else 0  # the last run may go on
            if cut:
                x, y = _links(key[:cut], fp[:cut], k)
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], ["a", "b"])
                key, fp = key[cut:].copy(), fp[cut:].copy()
        x, y = _links(key, fp, k)
        yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable over links (a, b), for every node in a link. Alternating large and small
    stars; each round is a staged table, so lineage stays short, and takes the logarithm of the longest path in rounds."""
    edges = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = stage(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        low = stage(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        new = stage(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        now = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        unstage(edges, least, large, low)
        edges = new
        if now == mark:
            break
        mark = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def simhash_groups(docs: DataFrame, words: int = 4, k: int = 4) -> DataFrame:
    """doc_id, key, fp, group (the component's smallest fingerprint), component_id (the smallest doc_id reachable, itself
    included) for every row of docs.

    Null and empty texts have fingerprint 0 and are linked like any other; texts shorter than a shingle are one shingle.
    Rows equal in fingerprint are one node, so groups of exact copies cost one row, and large ones are dealt over tasks where
    rows meet their group. Null ids take part and never are the
    smallest (a group of null ids alone has component_id null). Repeated rows stay; other columns are ignored."""
    spark = docs.sparkSession
    prints = stage(fingerprints(docs, words), "prints")
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")), "nodes")
    links = stage(near_links(nodes.select("fp"), k), "links")
    release(spark)
    roots = components(links)
    nodes = stage(nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", "rows", F.coalesce("root", "fp").alias("root")), "rooted")
    smallest = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    member = spread_join(nodes, smallest, ["root"], ["fp"]).select("fp", F.col("root").alias("group"), "component_id")
    out = spread_join(prints, member, ["fp"], ["doc_id", "key"], counts=nodes.select("fp", F.col("rows").alias("n")))
    return out.select("doc_id", "key", "fp", "group", "component_id")


def one_of_each_group(docs: DataFrame, words: int = 4, k: int = 4) -> DataFrame:
    """docs with one row of each group of near copies: the smallest doc_id, null last, then the smallest text digest; rows
    equal in both are one. Texts without words are one group. The columns of docs, whatever their names; an empty table
    gives none."""
    groups = simhash_groups(docs, words, k)
    first = groups.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("m"))
    same = groups.groupBy("doc_id", "key").agg(F.count("*").alias("rows"))
    own, doc, key, again = free(docs, "_own", "_id", "_key", "_again")
    first = first.select(F.col("m.doc_id").alias(doc), F.col("m.key").alias(key))
    first = stage(first.join(same, (first[key] == same["key"]) & first[doc].eqNullSafe(same["doc_id"])).select(doc, key, (F.col("rows") > 1).alias(again)), "firsts")
    keyed = docs.withColumn(own, row_key())
    kept = keyed.join(first, (F.col(own) == F.col(key)) & F.col("doc_id").eqNullSafe(F.col(doc)))
    once = kept.where(again).dropDuplicates(["doc_id", own])
    return kept.where(~F.col(again)).unionByName(once).select(*docs.columns)


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return simhash_groups(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
