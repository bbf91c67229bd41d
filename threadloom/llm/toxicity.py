"""Toxicity scores: FTRL-proximal logistic regression over hashed words, bigrams and skip-grams.

Features are presences. Training takes a bounded sample of the labelled rows; features are hashed where the rows lie, and
one task, its size bounded by the sample, runs the online learner. L1 leaves few weights, which go out to every task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import few_texts, free

#: ASCII punctuation taken off the ends of words.
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
MEMO = 1 << 18
WORDS = 200_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word.strip(PUNCTUATION))
        return h


def _slots(h: np.ndarray, bits: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(64 - bits)).astype(np.int32)


def features(texts: list[bytes | None], bits: int, memo: _Hashes) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, number of texts, text of each feature, its slot) of groups of whole texts; repeats are kept."""
    first, held, parts = 0, 0, []
    for i, text in enumerate(texts):
        words = (text or b"").lower().split()
        parts.append(np.fromiter(map(memo.__getitem__, words), np.uint64, len(words)))
        held += len(words)
        if held >= WORDS or i == len(texts) - 1:
            doc = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            h = np.concatenate(parts)
            slots, docs = [_slots(h, bits)], [doc]
            for gap, salt in ((1, 0xC2B2AE3D27D4EB4F), (2, 0x165667B19E3779F9)):  # neighbours; one word skipped
                if len(h) > gap:
                    same = doc[gap:] == doc[:-gap]
                    slots.append(_slots((h[:-gap] * np.uint64(salt) + h[gap:])[same], bits))
                    docs.append(doc[gap:][same])
            yield first, len(parts), np.concatenate(docs), np.concatenate(slots)
            first, held, parts = i + 1, 0, []


@dataclass
class FTRL:
    """Per-coordinate FTRL-proximal for logistic loss over sets of slots; slot 2**bits is the bias."""

    bits: int = 20
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 1.0
    z: np.ndarray = field(init=False, repr=False)
    n: np.ndarray = field(init=False, repr=False)

    def __post_init__(self) -> None:
        self.z, self.n = np.zeros((1 << self.bits) + 1), np.zeros((1 << self.bits) + 1)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.where(np.abs(z) > self.l1, z - np.sign(z) * self.l1, 0.0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, slots: np.ndarray, label: int) -> None:
        at = np.append(slots, 1 << self.bits)
        w = self.weights(at)
        g = 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, float(w.sum()))))) - label
        old = self.n[at]
        new = old + g * g
        self.z[at] += g - (np.sqrt(new) - np.sqrt(old)) / self.alpha * w
        self.n[at] = new


def train(labelled: DataFrame, max_rows: int = 30_000, max_bytes: int = 256 << 20, epochs: int = 4, bits: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """(slots, weights) that aren't zero, of a learner fitted on about max_rows of the rows (text, label, row, and size in
    bytes, so that texts aren't moved to be measured), and on no more than about max_bytes of text: what one task holds is
    some eight times as much.

    The sample is drawn by hash of `row`, so it is the same at every run, and is taken in the order of that hash, ties by
    label and by the text's digest. Rows without a label are left out. Fewer than two rows give no weights: every score is
    then one half."""
    rows = labelled.where("label is not null and row is not null")
    length = F.col("size") if "size" in rows.columns else F.octet_length("text")
    total, size = rows.agg(F.count("*"), F.coalesce(F.sum(length), F.lit(0))).first()
    share = 1.0 if total <= max_rows else (max_rows - 3 * math.sqrt(max_rows)) / total
    share = min(share, max_bytes / size) if size else share
    drawn = rows.withColumn("order", F.xxhash64("row", F.lit("sample"))).where(F.pmod("order", F.lit(1 << 30)) < int(share * (1 << 30)))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Hashes()
        for b in few_texts(batches):
            for first, n, doc, slot in features(b.column(0).to_pylist(), bits, memo):
                by = np.argsort(doc, kind="stable")
                sets = [np.unique(x) for x in np.split(slot[by], np.cumsum(np.bincount(doc, minlength=n))[:-1])]
                yield pa.RecordBatch.from_arrays([b.column(1).slice(first, n), b.column(2).slice(first, n), b.column(3).slice(first, n), pa.array(sets, pa.list_(pa.int32()))], ["label", "order", "digest", "slots"])

    sets = drawn.select(F.col("text").cast("binary"), F.col("label").cast("int"), "order", F.xxhash64("text").alias("digest")).mapInArrow(hashed, "label int, order long, digest long, slots array<int>")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(label, slots.values.to_numpy()) for b in batches for label, slots in zip(b.column(0).to_pylist(), b.column(3), strict=True)]
        model = FTRL(bits)
        for _ in range(epochs):
            for label, slots in held:
                model.learn(slots, label)
        w = model.weights(slice(None))
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], ["slot", "weight"])

    # one task by design: it holds the sample's slots, bounded by max_rows and max_bytes
    fitted = sets.repartition(1).sortWithinPartitions("order", "label", "digest").mapInArrow(fit, "slot long, weight double").toPandas()
    return fitted["slot"].to_numpy(), fitted["weight"].to_numpy()


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], bits: int = 20, keep_text: bool = False) -> DataFrame:
    """docs (without text, unless kept) with `score`, 0 to 1; texts without words score as the bias says. Needs no shuffle."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c not in ("text", "score")]
    own = free(docs, "_text")[0]
    held = docs.select(*names, F.col("text").cast("binary").alias(own))
    schema = StructType([*(held if keep_text else held.select(*names)).schema.fields, StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, w = shared.value
        weights = np.zeros((1 << bits) + 1, np.float64)
        weights[at] = w
        memo = _Hashes()
        for b in few_texts(batches):
            out = np.full(b.num_rows, weights[-1])
            for first, n, doc, slot in features(b.column(len(names)).to_pylist(), bits, memo):
                hit = np.flatnonzero(weights[slot])
                pair = np.unique(doc[hit].astype(np.int64) << 32 | slot[hit])  # presences
                out[first : first + n] += np.bincount(pair >> 32, weights[pair & 0xFFFFFFFF], minlength=n)
            kept = b.columns if keep_text else b.columns[: len(names)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(1.0 / (1.0 + np.exp(-np.clip(out, -35, 35))))], schema.fieldNames())

    out = held.mapInArrow(run, schema)
    return out.select(*[F.col(own).cast("string").alias("text") if c == "text" else F.col(c) for c in docs.columns if c != "score"], "score") if keep_text else out


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training: crc32 of its id as text, modulo 5, is 0. Null ids are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = 30_000, threshold: float = 0.5, keep_text: bool = False) -> DataFrame:
    """docs (without text, unless kept) with held_out, score and predicted.

    Labels are learnt from rows that aren't held out, by text alone. Null and empty texts are scored too. A document with
    several labels is as many examples, always in the same order; unlabelled and null-labelled ones are none; with no
    examples every score is one half. Repeated rows stay and score alike, an empty table gives no row. Very long texts are
    scored whole, a presence counting once. Other columns stay, whatever their names; score, held_out and predicted are
    replaced."""
    marked = docs.select("doc_id", "text", F.octet_length("text").alias("size")).join(labels.select(F.col("doc_id").alias("_id"), F.col("toxic").alias("label")), F.col("doc_id") == F.col("_id"))
    known = marked.where(~held_out(F.col("doc_id"))).select("text", "size", "label", F.col("doc_id").alias("row"))
    out = score(docs, train(known, max_rows), keep_text=keep_text)
    return out.withColumn("held_out", held_out(F.col("doc_id"))).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select("doc_id", "held_out", "score", "predicted")
