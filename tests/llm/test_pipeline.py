"""The corpus pipeline against a plain version of its last four stages on the documents its first stage keeps."""

import re
from collections import Counter

import corpus_pipeline as p
from test_ops import plain_fingerprint, plain_groups


def plain_dirty(docs, items, length=10):
    """Ids of documents that hold a window of any item."""
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(table))
    grams = lambda w, n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    wanted = set()
    for _, t in items:
        if w := words(t):
            wanted |= grams(w, min(length, len(w)))
    return {i for i, t in docs if any(grams(words(t), n) & wanted for n in {len(g) for g in wanted})}


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for name, stage in p.STAGES:
        docs = stage(spark, docs, sf)
        docs.write.parquet(str(tmp_path / name))
        docs = kept[name] = spark.read.parquet(str(tmp_path / name))
    columns = spark.read.parquet(f"{sf}/documents.parquet").columns
    assert all(f.columns == columns for f in list(kept.values())[:-1])
    rows = {n: [(r["doc_id"], r["text"]) for r in f.collect()] for n, f in list(kept.items())[:-1]}
    first = sorted(rows["toxicity"])
    ids, texts = zip(*first, strict=True)
    groups = plain_groups(ids, [plain_fingerprint(t, 5) for t in texts], p.RADIUS)
    alone = [(i, t) for (i, t), g in zip(first, groups, strict=True) if i == g]
    assert sorted(rows["near copies"]) == alone
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    dirty = plain_dirty(alone, items)
    assert {i for i, _ in rows["decontamination"]} == {i for i, _ in alone} - dirty
    mixed = Counter(i for i, _ in rows["mixing"])
    assert set(mixed) <= {i for i, _ in rows["decontamination"]} and max(mixed.values()) <= 2
    sizes = {i: len((t or "").encode().split()) for i, t in rows["decontamination"]}
    assert abs(sum(n * sizes[i] for i, n in mixed.items()) - 1.5 * sum(sizes.values())) <= max(sizes.values())
    out = kept["token ids"].orderBy("start").collect()
    assert Counter(r["doc_id"] for r in out) == mixed
    assert [r["doc_id"] for r in out] == sorted(r["doc_id"] for r in out)
