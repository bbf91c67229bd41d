"""Plain versions of the learner and of proximity, columns of any name, and the pipeline's stages on edge rows."""

import math
import random
from collections import Counter, defaultdict

import corpus_pipeline as p
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from threadloom.llm import common, decontam, mixing, simhash, substring, tokens, toxicity, url_filter

#: Names that operators use inside, as columns of the caller.
NAMES = ["_key", "_id", "_text", "_own", "_best", "_url", "_plan", "_copies", "_rows", "_again", "_found", "_block", "key", "fp", "row", "rank", "score", "size", "n", "term", "hash", "shard"]


def slot(word_hashes, salt=None):
    h = word_hashes[0] if salt is None else (word_hashes[0] * salt + word_hashes[1]) % 2**64
    h = ((h ^ (h >> 32)) * 0x9E3779B97F4A7C15) % 2**64
    return h >> (64 - 20)


def plain_slots(text):
    hs = [xxhash.xxh3_64_intdigest(w.strip(toxicity.PUNCTUATION)) for w in (text or "").encode().lower().split()]
    out = {slot([h]) for h in hs}
    out |= {slot(x, 0xC2B2AE3D27D4EB4F) for x in zip(hs, hs[1:])}
    return out | {slot(x, 0x165667B19E3779F9) for x in zip(hs, hs[2:])}


class PlainFTRL:
    """The published algorithm, a coordinate at a time."""

    def __init__(self, alpha=1.0, beta=1.0, l1=4.0, l2=1.0):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = defaultdict(float), defaultdict(float)

    def weight(self, i):
        z = self.z[i]
        return 0.0 if abs(z) <= self.l1 else -(z - math.copysign(self.l1, z)) / ((self.beta + math.sqrt(self.n[i])) / self.alpha + self.l2)

    def score(self, slots):
        x = sum(self.weight(i) for i in [*slots, "bias"])
        return 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))

    def learn(self, slots, label):
        g = self.score(slots) - label
        for i in [*slots, "bias"]:
            w = self.weight(i)
            self.z[i] += g - (math.sqrt(self.n[i] + g * g) - math.sqrt(self.n[i])) / self.alpha * w
            self.n[i] += g * g


def test_toxicity_against_plain(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    marked = docs.join(labels, "doc_id").where(~toxicity.held_out(F.col("doc_id")) & F.col("toxic").isNotNull())
    rows = marked.select("text", "toxic", F.xxhash64("doc_id", F.lit("sample")).alias("o"), F.xxhash64("text").alias("d")).collect()
    model = PlainFTRL()
    sample = [(plain_slots(r["text"]), r["toxic"]) for r in sorted(rows, key=lambda r: (r["o"], r["toxic"], r["d"] or 0))]
    for _ in range(4):
        for slots, label in sample:
            model.learn(slots, label)
    got = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, labels).collect()}
    assert len(got) > 100
    for r in docs.collect():
        assert got[r["doc_id"]] == pytest.approx(model.score(plain_slots(r["text"])), abs=1e-9)


def test_toxicity_ties_and_bound(spark):
    """Several labels of one document are learnt in one order whatever the partitions; the sample's bytes are bounded."""
    d = spark.createDataFrame([(i, f"word{i % 2} other{i % 3} thing{i}") for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, (i + (j == 2)) % 2) for i in range(300) for j in range(3)], "doc_id long, toxic int")
    run = lambda a, b: [r["score"] for r in toxicity.toxicity(a, b).orderBy("doc_id").collect()]
    assert run(d, labels) == run(d.repartition(7), labels.repartition(5))
    known = d.join(labels, "doc_id").select("text", F.col("toxic").alias("label"), F.col("doc_id").alias("row"))
    assert len(toxicity.train(known, max_bytes=10)[0]) == 0 and len(toxicity.train(known)[0]) > 0


def plain_near(docs, items, span, counts):
    out = set()
    for d, text in docs:
        words = (text or "").lower().split()
        for item, t in items:
            need = Counter((t or "").lower().split())
            if not need or any(not counts[w] for w in need):
                continue
            order = (t or "").lower().split()
            rare = min(range(len(order)), key=lambda i: (counts[order[i]], i))
            for at in [i for i, w in enumerate(words) if w == order[rare]]:
                places = {w: [i for i in range(max(0, at - span), min(len(words), at + span + 1)) if words[i] == w] for w in need}
                if all(len(places[w]) >= need[w] for w in need):
                    out.add((d, item, min(x[0] for x in places.values()), max(x[-1] for x in places.values())))
    return out


def test_near_against_plain(spark):
    rng = random.Random(3)
    words = [f"t{i}" for i in range(14)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 60)))) for i in range(60)] + [(90, None), (91, "")]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 5)))) for i in range(12)] + [(50, None), (51, "")]
    counts = Counter(w for _, t in docs for w in (t or "").split())
    index = decontam.Index(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"], r["start"], r["end"]) for r in index.near(4).collect()}
    want = plain_near(docs, items, 4, counts)
    assert got == want and len(want) > 50


def test_vocabulary_that_is_not_broadcast(spark, monkeypatch):
    """The way beyond the bound gives the same hits; hot terms are dealt out."""
    rng = random.Random(5)
    docs = [(i, " ".join(["the"] * 30 + [f"w{rng.randrange(40)}" for _ in range(60)])) for i in range(80)]
    items = [(i, " ".join(f"w{rng.randrange(40)}" for _ in range(2)) + " the the") for i in range(3)] + [(9, "the the the the the the the the the the")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    rows = lambda: sorted((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in decontam.contamination(d, b).collect())
    want = rows()
    monkeypatch.setattr(decontam, "SMALL", 2)
    monkeypatch.setattr(common, "BLOCK", 50)
    assert rows() == want and any(r[2] for r in want)


def test_spread_join(spark):
    many = spark.range(5000).select(F.when(F.col("id") < 2000, 1).otherwise(F.col("id")).alias("k"), "id")
    few = spark.range(5001).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).unionByName(spark.createDataFrame([(1, -1)], "k long, v long"))
    got = common.spread_join(many, few, ["k"], ["id"], block=100)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, many.join(few, "k").collect()))
    assert common.hot_keys(many, ["k"], 100).collect()[0]["blocks"] == 20 and common.hot_keys(many, ["k"], 3000) is None


@pytest.fixture(scope="module")
def edge(spark):
    """Rows with nulls, empty and long texts and repeats, with columns named like the operators' own."""
    rows = [(1, "one two three four five six", "a"), (1, "one two three four five six", "a"), (2, None, "a"), (3, "", None), (None, "no id here at all", "b"), (4, " ".join(f"w{i % 97}" for i in range(20_000)), "b"), (None, None, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    return d.select("*", *[F.lit("mine").alias(c) for c in NAMES])


def test_names_of_columns(spark, edge):
    labels = spark.createDataFrame([(1, 0), (4, 1)], "doc_id long, toxic int")
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    kept = ["_key", "_own", "n", "hash"]
    for out, n in ((toxicity.toxicity(edge, labels, keep_text=True), 7), (mixing.mixed_documents(edge, mixing.mix(edge)), None), (simhash.one_of_each_group(edge), 4), (decontam.clean(edge, items), 5)):
        rows = out.collect()
        assert n is None or len(rows) == n
        assert all(r[c] == "mine" for r in rows for c in kept)
    assert substring.substring_dedup(edge).count() == simhash.simhash_groups(edge).count() == decontam.contamination(edge, items).count() == 7
    pages = edge.withColumn("page_id", F.col("doc_id")).withColumn("url", F.lit("http://a.net/"))
    got = url_filter.filter_urls(pages, url_filter.contract_rules(spark)).collect()
    assert len(got) == 7 and all(r["_best"] == r["_url"] == "mine" and r["verdict"] == "block" for r in got)


def test_stages_on_edge_rows(spark, edge, sf, tmp_path):
    """Each stage on nulls, repeats, long texts, clashing columns, and on no rows at all."""
    columns = edge.columns
    for docs in (edge, edge.limit(0)):
        for name, stage in p.STAGES:
            out = stage(spark, docs, sf)
            rows = out.collect()
            if name != "token ids":
                assert out.columns == columns and all(r["_key"] == "mine" for r in rows)
            assert len(rows) <= 2 * 7 and (docs is edge or not rows)
            if name == "near copies" and docs is edge:
                assert sorted(str(r["doc_id"]) for r in rows) == ["1", "2", "4", "None"]
            if name in ("decontamination", "token ids") and docs is edge:
                assert len(rows) == 7


def test_simhash_deals_hot_groups(spark, monkeypatch):
    monkeypatch.setattr(common, "BLOCK", 10)
    rows = [(i, "the same text here again") for i in range(200)] + [(i, f"text number {i} is of its own kind {i}") for i in range(200, 260)]
    got = simhash.simhash_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert len(got) == 260 and sum(r["component_id"] == 0 for r in got) == 200


def test_substring_deals_hot_groups(spark, monkeypatch):
    from test_ops import plain_substring

    monkeypatch.setattr(common, "BLOCK", 20)
    rng = np.random.default_rng(2)
    passage = " ".join(f"p{i}" for i in range(50))
    texts = [f"a{i} " * int(rng.integers(0, 4)) + passage + f" b{i}" * 3 for i in range(120)] + [passage + " " + passage]
    got = substring.substring_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)).orderBy("doc_id").collect()
    assert [(r["n_words"], r["n_removed"], r["kept"]) for r in got] == plain_substring(texts, 35)


def test_tokens_ignore_other_columns(spark, edge):
    import public_tokenizers

    assert tokens.tokenised(edge, public_tokenizers.path("word_bpe_49k.json")).count() == 7


def test_mix_of_null_ids(spark):
    """Documents without ids fall in many buckets of their source, and the mix is that of any other documents."""
    from threadloom.llm import mixing

    docs = spark.createDataFrame([(None, f"word {i} " * (i % 7 + 1), "ab"[i % 2]) for i in range(1000)] + [(None, None, None)], "doc_id long, text string, source string").repartition(5)
    got = mixing.mix(docs).collect()
    assert len(got) == 1001 and sorted((r["size"], r["taken"]) for r in got) == sorted((r["size"], r["taken"]) for r in mixing.mix(docs.repartition(2)).collect())
    for source in "ab":
        own = [r for r in got if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 20
        assert len({(r["key"] % 4096) for r in own}) > 100
