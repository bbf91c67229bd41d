"""Operators against plain versions, with nulls, empty and long texts, ties, repeated rows, empty tables and extra columns."""

import base64
import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from threadloom.llm import ann, common, decontam, mixing, pii, rans, simhash, substring, tokens, toxicity, url_filter, warc

DOCS = "doc_id long, text string, source string"
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
TEXTS = [None, "", "one", "One two three four five", LONG, LONG + " tail", "  \t\n ", "ünï cödé wörds hère and thére", "a b c d e f g h i j k l " * 8]
ROWS = [(i, t, [None, "b", "a"][i % 3]) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "b"), (3, "another text of the same id", "b"), (None, "no id at all here", "a"), (None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    """Edge rows, with a column whose name clashes with what the operators make."""
    return spark.createDataFrame(ROWS, DOCS).withColumn("key", F.lit("mine")).withColumn("size", F.lit(-1)).withColumn("score", F.lit("x")).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_mix(spark, docs, none):
    got = mixing.mix(docs).collect()
    assert len(got) == len(ROWS)
    per = Counter()
    for r in got:
        assert r["size"] == len((r_text(r)).split()) if r["doc_id"] not in (None, 3) else True
        assert 0 <= r["taken"] <= 2 * r["size"] and r["copies"] in (0, 1, 2)
        per[r["source"]] += r["taken"]
    for r in got:
        assert abs(per[r["source"]] - r["target"]) <= 30_001 and r["target"] <= 2 * r["source_size"]
    assert sum({r["source"]: r["target"] for r in got}.values()) == pytest.approx(1.5 * sum(r["size"] for r in got))
    out = mixing.mixed_documents(docs, mixing.mix(docs))
    assert out.columns == docs.columns and out.count() == sum(r["copies"] for r in got)
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none, mixing.mix(none)).count() == 0


def r_text(r):
    return TEXTS[r["doc_id"]] or ""


def test_mix_runs_agree(spark, docs):
    rows = lambda d: sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in mixing.mix(d).collect())
    assert rows(docs) == rows(docs.repartition(7))


def test_targets_stop_at_twice(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 10), (None, 0)], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    assert got["a"] == 20 and got["c"] == 20 and got["b"] == 1530 - 40 and got[None] == 0


def plain_hits(text, items, length=10):
    import re

    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(table))
    w, hit, found = words(text), set(), set()
    for item, t in items:
        i = words(t)
        n = min(length, len(i))
        for a in range(len(i) - n + 1 if n else 0):
            for p in range(len(w) - n + 1):
                if w[p : p + n] == i[a : a + n]:
                    hit.update(range(p, p + n))
                    found.add(item)
    return len(w), len(hit), sorted(map(str, found))


ITEMS = [(10, "one"), (2, "A B c d e f g h i j k"), (7, None), (8, ""), (9, "... !!"), (2, "five FIVE"), (11, "ünï CÖDÉ wörds"), (12, "ünï cödé wörds"), (13, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 nowhere")]


def test_decontamination(spark, docs, none):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], tuple(r["items"])) for r in decontam.contamination(docs, items).collect())
    want = sorted((str(d), n, h, tuple(f)) for d, t, _ in ROWS for n, h, f in [plain_hits(t, ITEMS)])
    assert got == want
    assert decontam.contamination(none, items).count() == 0
    assert {r["n_hit"] for r in decontam.contamination(docs, items.limit(0)).collect()} == {0}
    left = decontam.clean(docs, items)
    assert left.columns == docs.columns and left.count() == sum(h == 0 for _, _, h, _ in want)


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "x delta y gamma z beta w alpha"), (2, "alpha beta gamma " + "z " * 50 + "delta"), (3, "alpha alpha alpha")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    got = [(r["doc_id"], r["item_id"], r["start"], r["end"]) for r in decontam.Index(docs, items).near(10).collect()]
    assert got == [(1, 1, 1, 7)]


def test_no_python_in_native_plans(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for df in (decontam.contamination(docs, items), pii.pseudonymise(docs, "k")):
        plan = df._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_tokens(spark, docs, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    got = sorted(tokens.tokenised(docs, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] is not None and r["doc_id"] for r in got] == sorted([r[0] is not None and r[0] for r in ROWS], key=lambda x: -1 if x is False else x)
    at, seen = 0, Counter()
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
        seen[r["doc_id"], r["n_tokens"], r["ids_crc32"]] += 1
    want = Counter()
    for d, x, _ in ROWS:
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 2]
        want[d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert seen == want
    assert tokens.tokenised(none, path).count() == 0


def test_whole_text_tokenizer(spark):
    """A tokenizer that keeps white space is given whole texts."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    w = tokens.WordIds(path)
    assert not w.by_word
    text = "Some  text,\n here."
    assert np.frombuffer(w([text.encode()])[0], w.dtype).tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["J̌ a", "<|endoftext|> <|ENDOFTEXT|>x", "it's IT'S we'll.", "a.. b., c.", "«a». b… .c", "İstanbul! İ.", "x\x0by\x0cz\x1cw\x85v", "café. CAFÉ,", "1,234.5 x1.", "日本語。 क़.", "", "word.\r\nnext"])
def test_words_are_the_text(text):
    w = tokens.encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert w([text.encode()])[0] == w._encode([text])[0].tobytes()


@pytest.mark.parametrize("n", [0, 1, 255, 5000, 400_000])
def test_rans(n):
    ids = np.minimum(np.random.default_rng(n).zipf(1.3, n), 49_000).astype(np.int64)
    table = rans.Table.load(rans.Table(np.bincount(ids, minlength=49_408)).dump())
    block = rans.pack(np.array([1]), np.zeros(1), np.array([n]), ids, table, every=64)
    assert (rans.unpack(block, table)[3] == ids).all()
    if n > 5000:
        lanes, words, marks = rans.encode(ids, table, 64)
        assert len(marks) > 2
        part = rans.decode(n, lanes, words.astype(np.uint64), table, marks[2], 128, 64)
        assert (part == ids[128 * lanes : 192 * lanes]).all()
        bad = bytearray(block)
        bad[-1] ^= 1
        with pytest.raises(ValueError):
            rans.unpack(bytes(bad), table)


def test_pii(spark, docs, none):
    text = "Mr. John Smith +1 (017) 555-7713, +10175557713; Ab.c1@mail4.example.com ab.c1@mail4.example.com Frau Müller 10.0.0.1 123-45-6789 4111 1111 1111 1111 9b0b3c6a43eb78aa99cbd7049c572391524f37a8"
    d = spark.createDataFrame([(1, text), (1, text), (2, "john@x.org and Mrs John Smith"), (3, None), (4, ""), (5, "Version 2.0, 1234 words")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.pseudonymise(d, "k").collect()}
    a = got[1]["text"]
    for secret in ("John", "Smith", "7713", "mail4", "Müller", "10.0.0.1", "123-45", "4111", "9b0b3c6a43"):
        assert secret not in a
    n = a.split()
    phone = "".join(c for c in " ".join(n[3:6]) if c.isdigit())
    assert phone == "".join(c for c in n[6] if c.isdigit()) and phone[0] == "1"  # one number in two spellings
    assert n[7].lower() == n[8] and n[7][0].isupper()  # one address
    assert len(n[-1]) == 40 and set(n[-1]) <= set("0123456789abcdef")
    assert n[1] in pii.GIVEN["latin", "m"] or n[1] in pii.GIVEN["latin", "f"]
    assert got[3]["text"] is None and got[4]["text"] == "" and got[5]["text"] == "Version 2.0, 1234 words" and got[5]["n_entities"] == 0
    assert pii.pseudonymise(d, "k").count() == 6
    assert {r["text"] for r in pii.pseudonymise(d, "other").collect()}.isdisjoint({a})
    same = pii.pseudonymise(docs, "k")
    assert Counter(r["text"] for r in same.collect()) == Counter(t for _, t, _ in ROWS) and same.columns == [*docs.columns, "n_entities"]
    assert pii.pseudonymise(none, "k").count() == 0


def test_pii_surrogates_stay_distinct(spark):
    m = spark.range(3000).select(F.lit("ip").alias("kind"), F.concat(F.lit("9.9."), (F.col("id") % 250).cast("string"), F.lit("."), (F.col("id") / 250).cast("int").cast("string")).alias("entity"), F.lit(None).cast("string").alias("gender"))
    m = m.unionByName(spark.range(300).select(F.lit("ssn").alias("kind"), F.lpad(F.col("id").cast("string"), 3, "0").alias("entity"), F.lit(None).cast("string").alias("gender")))
    t = pii.entity_table(m, "k").collect()
    for kind in ("ip", "ssn"):
        own = [r for r in t if r["kind"] == kind]
        assert len({r["surrogate"] for r in own}) == len(own) and not {r["surrogate"] for r in own} & {r["entity"] for r in own}


def test_toxicity(spark, docs, none):
    rows = [(i, ("you are a total moron today friend " if i % 4 == 0 else "what a fine and quiet day it is here ") + f"n{i}") for i in range(400)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(1, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(d, labels).collect()
    assert len(got) == 400 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in got)
    edge = toxicity.toxicity(docs, labels, keep_text=True)
    assert edge.count() == len(ROWS) and all(0 <= r["score"] <= 1 for r in edge.select("score").collect())
    assert Counter(r["text"] for r in edge.collect()) == Counter(t for _, t, _ in ROWS)
    assert toxicity.toxicity(none, labels).count() == 0
    assert {r["score"] for r in toxicity.toxicity(d, labels.limit(0)).collect()} == {0.5}


def test_search(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 9)) * rng.uniform(0.5, 2, (600, 1))
    x[50:60] = x[49]
    rows = [(i, v.tolist(), "extra") for i, v in enumerate(x)] + [(600, None, ""), (620, [0.0] * 9, ""), (640, [1.0, None] + [0.0] * 7, ""), (660, [float("nan")] * 9, ""), (None, [1.0] * 9, ""), (680, [1.0, 2.0], ""), (0, x[0].tolist(), "extra")]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = ann.search(d, F.col("vec_id") % 20 == 0).collect()
    pool = {i: v for i, v in enumerate(x)} | {680: np.array([1.0, 2.0] + [0] * 7)}
    ids = np.array(list(pool))
    m = np.array(list(pool.values()))
    hit = 0
    for q in [i for i in pool if i % 20 == 0]:
        s = m @ pool[q]
        keep = ids != q
        best = ids[keep][np.lexsort((ids[keep], -s[keep].round(12)))][:20]
        own = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 21))
        assert all(abs(r["score"] - pool[q] @ pool[r["vec_id"]]) < 1e-9 for r in own)
        hit += len({r["vec_id"] for r in own} & set(best.tolist()))
    assert hit >= 0.9 * 20 * sum(i % 20 == 0 for i in pool)
    assert len(got) == 20 * sum(i % 20 == 0 for i in pool)
    assert ann.search(d.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [-1.0])], "vec_id long, embedding array<double>")
    assert [(r["rank"], r["vec_id"], r["score"]) for r in ann.search(few, F.col("vec_id") % 20 == 0).orderBy("rank").collect()] == [(1, 1, 2.0), (2, 2, -1.0)]


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://a.NET/x", "http://net", "http://net/", "http://x.example.net/en/1?q", "http://example.net/e", "https://www.example.com/de/", "http://example.com?/de/", "ftp://a.org/fr/#f", "http://notorg/fr/", "http://u:p@h.net:80/", "http://h.net/a://b.org/fr/", "http://" + "a." * 3000 + "net/" + "p/" * 3000]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] + [(3, urls[3], "x")], "page_id long, url string, rule string")
    got = url_filter.filter_urls(pages, url_filter.contract_rules(spark)).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        u = r["url"] or ""
        rest = u.split("://", 1)[1] if "://" in u else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = rest[:cut].lower(), rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
        fits = [(len(h + p), len(h), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, 0, None, "allow"))
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, best[2], best[3]), u
    assert url_filter.filter_urls(pages.limit(0), url_filter.contract_rules(spark)).count() == 0
    assert {r["verdict"] for r in url_filter.filter_urls(pages, url_filter.contract_rules(spark).limit(0)).collect()} == {"allow"}


def test_warc(spark, tmp_path):
    rows = [(1, "http://a/", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "http://b/\r\nX: y", None), (4, "http://c/", ""), (5, "http://d/ü", "é" * 200_000), (1, "http://a/", "<p>x</p>"), (None, "http://e/", "<p>x</p>"), (None, "http://e/", "only"), (9, "http://z/", "a\r\n\r\nWARC/1.1\r\n\r\nb")]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, type string").repartition(3)
    path = str(tmp_path / "w")
    warc.write_pages(pages, path)
    got = Counter(tuple(r) for r in warc.read_pages(spark, path).collect())
    first = {}
    for p, _, h in rows:
        if p is not None:
            first[h or ""] = min(p, first.get(h or "", p))
    want = Counter()
    for p, _, h in rows:
        b = (h or "").encode()
        f = first.get(h or "")
        again = f is not None and p != f
        want[p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", f if again else None] += 1
    assert got == want
    full = spark.read.format("warc").load(path)
    assert full.count() == len(rows)
    some = full.where("type = 'response' and target_uri like 'http://d%'")
    assert some.first()["payload"] == ("é" * 200_000).encode()
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" in plan
    kept = warc.WarcReader(spark.read.format("warc").load(path).schema, {"path": path})
    assert list(kept.pushFilters([warc.EqualTo(("type",), "revisit"), warc.EqualTo(("payload_length",), 1)])) == [warc.EqualTo(("payload_length",), 1)]
    assert all(h["WARC-Type"] == "revisit" and p is None for part in kept.partitions() for h, _, p in kept.records(part))
    empty = str(tmp_path / "none")
    warc.write_pages(pages.limit(0), empty)
    assert warc.read_pages(spark, empty).count() == 0


def test_warc_small_payloads_are_responses(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "x"), (2, "u", "x"), (3, "u", "long text"), (4, "u", "long text")], "page_id long, url string, html string")
    warc.write_pages(pages, str(tmp_path / "w"), least=5)
    assert {r["page_id"]: r["record_type"] for r in warc.read_pages(spark, str(tmp_path / "w")).collect()} == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_warc_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "RANGE", 1 << 12)
    pages = spark.createDataFrame([(i, f"u{i}", " ".join(str(j * i) for j in range(400))) for i in range(200)], "page_id long, url string, html string").coalesce(1)
    w = warc.WarcWriter({"path": str(tmp_path / "w")})
    rows = [{"record_id": f"<urn:page:{r['page_id']}>", "type": "response", "target_uri": r["url"], "date": "d", "payload_digest": None, "refers_to": None, "payload_length": len(r["html"]), "payload": r["html"].encode()} for r in pages.collect()]
    import pyarrow as pa

    w.commit([w.write(iter([pa.RecordBatch.from_pylist(rows)]))])
    r = warc.WarcReader(spark.createDataFrame([], warc.SCHEMA).schema, {"path": str(tmp_path / "w")})
    parts = r.partitions()
    assert len(parts) > 5
    assert [h["WARC-Record-ID"] for p in parts for h, _, _ in r.records(p)] == [x["record_id"] for x in rows]


def plain_substring(texts, length):
    seen = Counter()
    words = [(t or "").encode().split() for t in texts]
    for w in words:
        for i in range(len(w) - length + 1):
            seen[tuple(w[i : i + length])] += 1
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                gone.update(range(i, i + length))
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


@pytest.mark.parametrize("length,seed", [(35, 9), (12, 4), (8, 2)])
def test_substring(spark, docs, none, length, seed):
    rng = np.random.default_rng(length)
    passage = " ".join(f"p{i}" for i in rng.integers(0, 500, 60))
    texts = [" ".join(f"v{i}" for i in rng.integers(0, 3, 300)) for _ in range(6)]
    texts += [f"x{i} " * 20 + " ".join(passage.split()[rng.integers(0, 20) : rng.integers(40, 60)]) + f" y{i}" * 20 for i in range(20)]
    texts += ["same " * 200, " ".join(passage.split()[:length]), " ".join(passage.split()[: length - 1])]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = substring.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), length, seed).orderBy("doc_id").collect()
    assert [(r["n_words"], r["n_removed"], r["kept"]) for r in got] == plain_substring(texts, length)
    for r, t in zip(got, texts, strict=True):
        gone = {i for s in r["removed"] for i in range(s["first"], s["last"] + 1)}
        assert len(gone) == r["n_removed"] and " ".join(w for i, w in enumerate(t.split()) if i not in gone) == r["kept"]


def test_substring_edges(spark, docs, none):
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in substring.substring_dedup(docs).collect())
    plain = plain_substring([t for _, t, _ in ROWS], 35)
    assert got == Counter((d, *p) for (d, _, _), p in zip(ROWS, plain, strict=True))
    assert substring.substring_dedup(none).count() == 0
    with pytest.raises(ValueError):
        substring.substring_dedup(docs, 100, 9)


def plain_fingerprint(text, words=4):
    w = (text or "").encode().lower().split()
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i : i + words]), 42) for i in range(max(1, len(w) - words + 1))] if w else []
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hs) > len(hs))


def plain_groups(ids, prints, k=4):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= k:
                root[find(i)] = find(j)
    least = {}
    for i in range(len(prints)):
        if ids[i] is not None:
            least[find(i)] = min(ids[i], least.get(find(i), ids[i]))
    return [least.get(find(i)) for i in range(len(prints))]


def test_simhash(spark, docs, none):
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in rng.integers(0, 10_000, 400)]
    texts = [t for _, t, _ in ROWS]
    for i in range(60):
        w = list(base)
        for j in rng.integers(0, 400, 1 + i % 4):
            w[j] = f"c{i}"
        texts.append(" ".join(w))
    ids = [d for d, _, _ in ROWS] + list(range(100, 160))
    d = spark.createDataFrame([(i, t) for i, t in zip(ids, texts, strict=True)], "doc_id long, text string").repartition(3)
    prints = [plain_fingerprint(t) for t in texts]
    want = Counter(zip(ids, prints, plain_groups(ids, prints), strict=True))
    got = simhash.simhash_groups(d).collect()
    assert Counter((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got) == want
    assert simhash.simhash_groups(none).count() == 0
    one = simhash.one_of_each_group(docs)
    assert one.columns == docs.columns and one.count() == len(set(plain_groups(range(len(ROWS)), [plain_fingerprint(t) for _, t, _ in ROWS])))


@pytest.mark.parametrize("block,small", [(4096, 32), (64, 4)])
def test_links_connect_all(spark, monkeypatch, block, small):
    """Dense clusters and chains, with buckets cut into blocks and without."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "SMALL", small)
    rng = np.random.default_rng(1)
    prints = {int(x) for x in rng.integers(0, 1 << 63, 200)}
    centre = int(rng.integers(0, 1 << 63))
    for _ in range(800):
        x = centre
        for b in rng.integers(0, 64, rng.integers(0, 6)):
            x ^= 1 << int(b)
        prints.add(x)
    x = int(rng.integers(0, 1 << 63))
    for i in range(0, 60, 4):
        x ^= 0b1111 << i
        prints.add(x)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.near_links(spark.createDataFrame([(p,) for p in signed], "fp long"))
    roots = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    groups = plain_groups(signed, prints)
    assert [roots.get(p, p) for p in signed] == groups
    assert all((a ^ b).bit_count() <= 4 for a, b in ((r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in links.collect()))


def test_running_total(spark):
    rows = [(i % 7, i) for i in range(500)]
    d = spark.createDataFrame(rows, "a int, v int").repartition(5)
    got = common.running_total(d, [F.col("a"), F.col("v")], "v", "t").orderBy("rank").collect()
    total = 0
    for i, ((a, v), r) in enumerate(zip(sorted(rows), got, strict=True)):
        assert (r["a"], r["v"], r["rank"], r["before"]) == (a, v, i, total)
        total += v


def test_words_are_the_text_for_many_characters():
    """Every letter and mark of the basic plane beside marks, digits and letters, in one text each of words with it."""
    w = tokens.encoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = []
    for start in range(0, 0xD800, 64):
        chars = [chr(c) for c in range(start, start + 64) if not chr(c).isspace()]
        texts.append(" ".join(f"a{c}. {c}., A{c}b;! 1{c}? {c}" for c in chars))
    whole = [x.tobytes() for x in w._encode(texts)]
    got = w([t.encode() for t in texts])
    assert [i for i, (a, b) in enumerate(zip(whole, got, strict=True)) if a != b] == []


def test_shards(spark, monkeypatch):
    """Null ids and rows of one id are dealt over shards, long documents weigh more, and the order stays."""
    monkeypatch.setattr(tokens, "SHARD_BYTES", 4000)
    rows = [(None, f"null {i} words here") for i in range(300)] + [(7, f"seven {i} words here") for i in range(600)] + [(i, "w " * (5000 if i == 50 else 20)) for i in range(10, 200)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    plan = tokens.plan_shards(d)
    assert plan.nulls >= 1 and plan.count > 5
    path = public_tokenizers.path("word_bpe_49k.json")
    ids = tokens.token_ids(d, path, 2, plan).select("shard", "doc_id").collect()
    per = lambda f: Counter(r["shard"] for r in ids if f(r["doc_id"]))
    assert len(per(lambda x: x == 7)) > 2 and max(per(lambda x: x == 7).values()) < 400
    assert max(per(lambda x: x is None)) < min(per(lambda x: x is not None))
    back = sorted(tokens.tokenised(d, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] or 0 for r in back] == sorted(r[0] or 0 for r in rows)
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(back, back[1:]))


def test_unknown_configuration_encodes_whole_texts(tmp_path):
    """The way by words is taken for the exact known configuration only."""
    import json

    config = json.loads(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())
    config["normalizer"]["normalizers"][0] = {"type": "NFKC"}
    (tmp_path / "t.json").write_text(json.dumps(config), encoding="utf-8")
    w = tokens.WordIds(str(tmp_path / "t.json"))
    assert not w.by_word and w(["ﬁne text".encode()])[0] == w._encode(["ﬁne text"])[0].tobytes()
