"""Alignment against a plain version that encodes whole texts and walks both token lists."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from threadloom.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "one", "Hello world, it's fine.", "two  spaces\n\nand lines \n here\t tab ", "  starts so", "ends so  ", "naïve café 中文字符 mixed 日本語テキスト emoji 😀👩‍👩‍👧 done",
    "<|endoftext|> and <s> and </s> <0x41> as text", "a ▁ b", "▁", "　wide　blank   no-break ​ zero", "x" * 3000, "word " * 4000, "don't we'll they're I'd", "\x00 \x1c odd \x85 controls ﻿",
    "  ".join("many blanks between".split()), "1234567890 12 3", "Привет мир שלום عالم", "same text here", "same text here", "ﬁ ① Å K",
]


def plain_tokens(text):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = plain_tokens.a = getattr(plain_tokens, "a", None) or Tokenizer.from_file(A)
    b = plain_tokens.b = getattr(plain_tokens, "b", None) or SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = plain_tokens.letters = getattr(plain_tokens, "letters", None) or alignment.byte_letters()
    if not text:
        return [], []
    xs = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    ys = []
    for i in b.encode(text):
        p = b.id_to_piece(i)
        ys.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (xs, ys) if b"".join(x for _, x in xs) == whole == b"".join(y for _, y in ys) else ([], [])


def plain_groups(text):
    """Both token lists, and the groups between the byte offsets where tokens of both end."""
    xs, ys = plain_tokens(text)
    ends = [np.cumsum([len(x) for _, x in tokens]).tolist() for tokens in (xs, ys)]
    out, i, j = [], 0, 0
    for e in sorted(set(ends[0]) & set(ends[1])):
        x, y = ends[0].index(e) + 1, ends[1].index(e) + 1
        out.append(([t for t, _ in xs[i:x]], [t for t, _ in ys[j:y]]))
        i, j = x, y
    return xs, ys, out


def plain(texts):
    each = [plain_groups(t) for t in texts]
    count = Counter(p for _, _, g in each for p in {(a, b) for xs, ys in g for a in xs for b in ys})
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    for xs, ys, g in each:
        links = [(a, b) for x, y in g for a in x for b in y]
        written = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in g)
        yield len(xs), len(ys), len(g), len(links), sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links), hashlib.sha256(written.encode()).hexdigest() if xs else ""


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("small", [False, True])
def test_against_plain(spark, monkeypatch, small):
    if small:  # slices of a few texts, links made a few at a time, words forgotten
        for name, n in (("SLICE_BYTES", 200), ("LINKS", 7), ("MEMO", 5)):
            monkeypatch.setattr(alignment, name, n)
    docs = spark.createDataFrame([(None if i == 3 else i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string").withColumn("slice", F.lit("mine")).withColumn("n", F.lit(1)).repartition(3)
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in alignment.alignment(docs, A, B).collect()}
    assert got == {None if i == 3 else i: w for i, w in enumerate(plain(TEXTS))}


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id")
    rows = docs.collect()
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in alignment.op11_align(spark, sf).collect()}
    assert got == dict(zip([r["doc_id"] for r in rows], plain([r["text"] for r in rows]), strict=True))


def test_empty_and_groups(spark):
    assert alignment.alignment(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4])], "doc_id long, text string")
    got = defaultdict(list)
    for r in alignment.groups(alignment.aligned(docs, A, B), A, B).orderBy("doc_id", "position").collect():
        got[r["doc_id"]].append(r)
    for i, t in enumerate(TEXTS):
        want = plain_groups(t)[2] * (2 if i == 4 else 1)
        assert sorted((r["a_ids"], r["b_ids"]) for r in got[i]) == sorted(want)
        if i != 4 and want:
            assert [r["start"] for r in got[i]] == [0, *(r["end"] for r in got[i])][:-1] and got[i][-1]["end"] == len(t.encode()) + 1


def test_words_are_the_text():
    """Texts of awkward characters, cut into words, against whole texts."""
    pair, rng = alignment.Pair(A, B), random.Random(3)
    assert pair.by_word
    letters = [*" " * 9, *"ab'sZ.,9\n\t\r▁<>é中😀", *map(chr, (0xA0, 0x85, 0x1C, 0x200B, 0x3000, 0x301, 0xFB01, 0x2028, 0x180E, 0xFEFF))]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 25))) for _ in range(4000)]
    out = pair.encode(pa.array(texts))
    pair.by_word = False
    for (x, ends), (y, want) in zip(out, pair.encode(pa.array([t or " " for t in texts])), strict=True):
        for i, t in enumerate(texts):
            if t:
                assert x[ends[i - 1] if i else 0 : ends[i]].tolist() == y[want[i - 1] if i else 0 : want[i]].tolist(), repr(t)


@pytest.mark.parametrize("seed", range(20))
def test_large_groups(monkeypatch, seed):
    """Links of groups of any size, made at once or from distinct ids."""
    rng = np.random.default_rng(seed)
    na, nb, per = rng.integers(1, 300, 6), rng.integers(1, 600, 6), [2, 0, 3, 1]
    a, b = rng.integers(0, 9, na.sum()).astype("<u2"), rng.integers(0, 9, nb.sum()).astype("<u2")
    first = np.cumsum([0, *per])
    split = lambda x, n: pa.array([x[n[: first[i]].sum() : n[: first[i + 1]].sum()].tobytes() for i in range(4)], pa.binary())
    sizes = lambda n: pa.array([alignment.pack_sizes(n[first[i] : first[i + 1]]).tobytes() for i in range(4)], pa.binary())
    rows = alignment.Rows(split(a, na), split(b, nb), sizes(na), sizes(nb), [np.dtype("<u2")] * 2)
    assert rows.na.tolist() == na.tolist() and rows.nb.tolist() == nb.tolist() and rows.n_groups.tolist() == per
    want = Counter()
    for g in range(6):
        for x in a[na[:g].sum() : na[: g + 1].sum()]:
            for y in b[nb[:g].sum() : nb[: g + 1].sum()]:
                want[int(np.searchsorted(first, g, "right") - 1), int(x) * 9 + int(y)] += 1
    for most in (1 << 21, 1000, 3):
        monkeypatch.setattr(alignment, "LINKS", most)
        row, pair, times = rows.links(9)
        assert dict(zip(zip(row.tolist(), pair.tolist(), strict=True), times.tolist(), strict=True)) == want
        assert len(row) == len(want)


def test_words_are_joined(monkeypatch):
    """New words are encoded many in a text, and their ids are those of each alone; known words are not encoded again."""
    asked, encode = Counter(), {c: c.encode for c in (alignment.ByteLevel, alignment.Pieces)}
    for c in encode:
        monkeypatch.setattr(c, "encode", lambda self, texts, c=c: (asked.update({c: len(texts)}), encode[c](self, texts))[1])
    pair, rng = alignment.Pair(A, B), random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzé中.,'", k=rng.randint(3, 9))) for _ in range(20_000)] + ["x" * 999, "q" * 70]
    texts = pa.array([" ".join(words[i : i + 100]) for i in range(0, len(words), 100)])
    first = pair.encode(texts)
    assert max(asked.values()) < 1000
    asked.clear()
    again = pair.encode(texts)
    assert max(asked.values()) < 10  # one whole text to compare, and words too long to be remembered
    pair.by_word = False
    for x, y, z in zip(first, again, pair.encode(texts), strict=True):
        assert np.array_equal(x[0], z[0]) and np.array_equal(x[1], z[1]) and np.array_equal(y[0], z[0]) and np.array_equal(y[1], z[1])


@pytest.mark.parametrize("memo", [0, 50, 100_000])
def test_odd_words(monkeypatch, memo):
    """Words whose tokens are not their bytes, and words that a memo of any size forgets, get the ids of each alone."""
    monkeypatch.setattr(alignment, "MEMO", memo)
    pair, rng = alignment.Pair(A, B), random.Random(7)
    letters = [*"abz'.9\n\t▁é中", *map(chr, (0, 0x85, 0xA0, 0x200B, 0x301, 0xFB01, 0xFEFF, 0x1F600))]
    words = ["a" + "".join(rng.choices(letters, k=rng.randint(0, 6))) + "b" for _ in range(300)]
    words = list(dict.fromkeys(words))
    for _ in range(4):
        some = rng.sample(words, 150)
        for got, want in zip(pair._words(pa.array(some), np.ones(len(some), bool)), zip(*pair._encode(some), strict=True), strict=True):
            assert got.to_pylist() == list(want)
