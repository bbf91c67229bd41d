"""Token-ID output: whole texts to ids, entropy-coded shards in ascending doc_id order, and their parallel reader.

A shard is a run of rANS blocks (see rans) and a trailer with their places; all shards share one frequency table, counted
over the whole corpus and stored beside them. Any block decodes alone, and inside it any checkpoint.
"""

from __future__ import annotations

import json
import os
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import large_rows, new_path, release, row_key, stage, unstage
from .files import names, open_fs, write_whole
from .rans import Table, pack, unpack

#: Ids of a block (a longer document makes a longer block), bytes of text a shard, and words that a worker's memo may hold.
BLOCK_IDS, SHARD_BYTES, MEMO = 1 << 20, 512 << 20, 350_000
#: Words encoded at once and learnt at once, bytes of text and texts taken at once, the longest text that is encoded again as a whole to compare.
GROUP, LEARNED, SLICE_BYTES, SLICE_ROWS, COMPARED = 50, 20_000, 6 << 20, 4096, 20_000
TAIL = "<QI4s"
#: ASCII marks that the tokenizer never joins to the letter or digit before them, and such letters and digits
#: (not U+0130, whose lower case ends in a combining mark).
MARKS = ".,;:!?"
JOINT = r"[0-9A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}\x{400}-\x{481}\x{4E00}-\x{9FA5}\x{AC00}-\x{D7A3}]$"
#: The one configuration whose texts are known to be their words' ids one after another.
BY_WORD = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None, "truncation": None, "padding": None,
}
BY_WORD_MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>", "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}
#: What a special token of that configuration is, besides its content.
BY_WORD_ADDED = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True}


def _listed(strings: pa.Array) -> list[str]:
    """The strings as a list, several times as fast as to_pylist()."""
    return strings.to_numpy(zero_copy_only=False).tolist()


class WordIds:
    """Ids of whole texts. Of the one tokenizer configuration known to drop white space and to end each word (BY_WORD), a
    text's ids are those of its words, which are remembered; each slice encodes one whole text as well and compares. Any
    other tokenizer encodes each text at once.

    A word is looked up without the marks at its end, where a letter or digit stands before them. New words of letters
    alone are encoded in groups, each ending in the one id that carries the end mark; others one by one."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocab.values()) + 1
        self.dtype = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        config = json.loads(self.tokenizer.to_str())
        model = {k: v for k, v in config["model"].items() if k not in ("vocab", "merges")}
        added = config.get("added_tokens") or []
        plain = all({k: t.get(k) for k in BY_WORD_ADDED} == BY_WORD_ADDED and not any(c.isspace() for c in t["content"]) and not t["content"][-1].isalnum() and t["content"][-1] not in MARKS for t in added)
        self.by_word = {k: config.get(k) for k in BY_WORD} == BY_WORD and model == BY_WORD_MODEL and plain
        self.final = np.zeros(self.size, bool)
        if self.by_word:
            self.final[[i for w, i in vocab.items() if w.endswith(model["end_of_word_suffix"])]] = True
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # the memo before it was full: what is asked again moves back
        self.tails: dict[str, bytes] = {"": b""}

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, keys: list[str]) -> None:
        """Put the ids of new words in the memo; the library's encodings are large, so few are held at once."""
        for i in range(0, len(keys), LEARNED):
            self._learn_some(keys[i : i + LEARNED])

    def _learn_some(self, keys: list[str]) -> None:
        letters = [k for k in keys if (k.isalpha() if k.isascii() else unicodedata.normalize("NFC", k).lower().isalpha())]
        if letters:
            ids = np.concatenate(self._encode([" ".join(letters[i : i + GROUP]) for i in range(0, len(letters), GROUP)]))
            ends = ((np.flatnonzero(self.final[ids]) + 1) * self.dtype.itemsize).tolist()
            if len(ends) == len(letters):
                data = ids.tobytes()
                self.memo.update(zip(letters, (data[i:j] for i, j in zip([0, *ends[:-1]], ends, strict=True)), strict=True))
            else:
                self.memo.update(zip(letters, (x.tobytes() for x in self._encode(letters)), strict=True))
        if rest := [k for k in keys if k not in self.memo]:  # words of other characters
            self.memo.update(zip(rest, (x.tobytes() for x in self._encode(rest)), strict=True))

    def _words(self, words: pa.Array) -> pa.Array:
        """The ids of distinct words, as little-endian bytes."""
        core = pc.utf8_rtrim(words, characters=MARKS)
        key = pc.if_else(pc.match_substring_regex(core, JOINT), core, words)
        key = pc.if_else(pc.ascii_is_alpha(key), pc.ascii_lower(key), key).dictionary_encode()
        keys = _listed(key.dictionary)
        if len(self.memo) > MEMO:
            self.older, self.memo = self.memo, {}
        memo, older = self.memo, self.older
        if unseen := [k for k in keys if k not in memo]:
            memo.update((k, older[k]) for k in unseen if k in older)
            self._learn([k for k in unseen if k not in older])
        ids = pa.array(list(map(self.memo.__getitem__, keys)), pa.binary()).take(key.indices)
        cut = pc.subtract(pc.binary_length(words), pc.binary_length(key.dictionary).take(key.indices)).to_numpy()
        some = np.flatnonzero(cut)
        tails = np.full(len(words), "", object)
        tails[some] = [w[-n:] for w, n in zip(_listed(words.take(pa.array(some))), cut[some].tolist(), strict=True)]
        tail = pa.array(tails, pa.string()).dictionary_encode()
        for t in tail.dictionary.to_pylist():
            if t not in self.tails:
                self.tails[t] = self._encode([t])[0].tobytes()
        return pc.binary_join_element_wise(ids, pa.array([self.tails[t] for t in tail.dictionary.to_pylist()], pa.binary()).take(tail.indices), b"")

    def slice(self, texts: pa.Array) -> pa.Array:
        """Each text's ids as little-endian bytes."""
        texts = texts.fill_null("")
        if not self.by_word:
            return pa.array([x.tobytes() for x in self._encode(texts.to_pylist())], pa.binary())
        lists = pc.ascii_split_whitespace(texts)
        words = lists.flatten().dictionary_encode()
        if not len(words):
            return pa.array([b""] * len(texts), pa.binary())
        every = self._words(words.dictionary).take(words.indices)
        places = np.frombuffer(every.buffers()[1], np.int32)[every.offset : every.offset + len(every) + 1]
        ends = np.ascontiguousarray(places[np.asarray(lists.offsets)])
        out = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(ends), every.buffers()[2] or pa.py_buffer(b"")])
        sizes = pc.binary_length(texts).to_numpy()
        some = np.flatnonzero((sizes > 0) & (sizes <= COMPARED))
        i = int(some[len(some) // 2]) if len(some) else int(sizes.argmin())
        if self._encode([texts[i].as_py()])[0].tobytes() != out[i].as_py():
            raise ValueError("this tokenizer's texts are not their words' ids one after another")
        return out

    def __call__(self, texts: list[bytes | None]) -> list[bytes]:
        return self.slice(pa.array([(t or b"").decode() for t in texts], pa.string())).to_pylist()


def slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, number) of runs of texts of these sizes, of about SLICE_BYTES each and no more than SLICE_ROWS."""
    first, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        held += n
        if held >= SLICE_BYTES or i + 1 - first >= SLICE_ROWS or i + 1 == len(sizes):
            yield first, i + 1 - first
            first, held = i + 1, 0


#: One encoder a worker process and file: its memo serves all tasks that the process runs.
ENCODERS: dict[str, WordIds] = {}


def encoder(path: str) -> WordIds:
    if path not in ENCODERS:
        ENCODERS[path] = WordIds(path)
    return ENCODERS[path]


class Shards:
    """Which shard a document goes to: null ids first, then ranges of doc_id cut at bounds that hold about as many bytes.

    A bound that comes m times is an id that fills m shards; its documents are dealt over them in the order of their key,
    and so are null ids, so no id is one shard's."""

    def __init__(self, nulls: int, bounds: list[int]):
        self.nulls, self.bounds = nulls, np.array(bounds, np.int64)
        self.count = nulls + len(bounds) + 1

    def __call__(self, ids: np.ndarray, null: np.ndarray, keys: np.ndarray) -> np.ndarray:
        lo, hi = np.searchsorted(self.bounds, ids, "left"), np.searchsorted(self.bounds, ids, "right")
        lo, wide = np.where(null, 0, lo + self.nulls), np.where(null, max(1, self.nulls), hi - lo + 1)
        high = (keys.view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(32)
        return (lo + ((high * wide.astype(np.uint64)) >> np.uint64(32)).astype(np.int64)).astype(np.int32)


def plan_shards(docs: DataFrame, shards: int | None = None) -> Shards:
    """Shards of about SHARD_BYTES of text each, or so many. Small corpora get one a MB, up to the shuffle partitions.

    Bounds are quantiles of ids, each id counted once for every average document that its text is as long as (so at most
    twice as many rows as documents are sketched)."""
    d = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size")), "sizes")
    r = d.agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), F.count_if(F.col("doc_id").isNull()).alias("nulls"), F.sum(F.when(F.col("doc_id").isNull(), F.col("size"))).alias("null_bytes")).first()
    total, n = r["bytes"] or 0, r["n"]
    if shards is None:
        most = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        shards = max(1, -(-total // SHARD_BYTES), min(most, total >> 20))
    weight = (r["null_bytes"] + r["nulls"]) / (total + n) if r["nulls"] else 0.0
    nulls = max(1, round(shards * weight)) if r["nulls"] else 0
    rest = max(1, shards - nulls)
    if rest == 1 or n == r["nulls"]:
        return Shards(nulls, [])
    mean = max(1, total // n)
    often = d.where("doc_id is not null").select("doc_id", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.floor(F.col("size") / mean)).cast("int"))).alias("time"))
    bounds = often.approxQuantile("doc_id", [i / rest for i in range(1, rest)], 0.1 / rest)
    unstage(d)
    return Shards(nulls, [int(b) for b in bounds])


def token_ids(docs: DataFrame, path: str, end_id: int, shards: Shards) -> DataFrame:
    """shard, doc_id, key, ids: the whole text's ids and the end id, as little-endian integers of the vocabulary's width."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        end = pa.scalar(np.array([end_id], words.dtype).tobytes(), pa.binary())
        for b in batches:
            null = b.column(0).is_null().to_numpy(zero_copy_only=False)
            shard = shards(b.column(0).fill_null(0).to_numpy(), null, b.column(1).to_numpy())
            for first, n in slices(pc.binary_length(b.column(2)).fill_null(0).to_numpy()):
                ids = pc.binary_join_element_wise(words.slice(b.column(2).slice(first, n)), end, b"")
                yield pa.RecordBatch.from_arrays([pa.array(shard[first : first + n]), b.column(0).slice(first, n), b.column(1).slice(first, n), ids], ["shard", "doc_id", "key", "ids"])
                del ids
                pa.default_memory_pool().release_unused()

    return docs.select(F.col("doc_id").cast("long"), row_key().alias("key"), "text").mapInArrow(run, "shard int, doc_id long, key long, ids binary")


BLOCK = "shard int, seq int, doc_ids binary, nulls binary, lengths binary, ids binary"


def _blocks(tokens: DataFrame, dtype: np.dtype, block_ids: int) -> DataFrame:
    """Rows of whole documents, in order, cut into blocks: one row a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ENCODERS.clear()  # a worker that has encoded has no more use of its memo
        pa.default_memory_pool().release_unused()
        held: list[tuple[int | None, bytes]] = []
        size, seq, shard = 0, 0, None

        def block() -> pa.RecordBatch:
            ids = [d for d, _ in held]
            row = {
                "shard": [shard], "seq": [seq], "doc_ids": [np.array([d or 0 for d in ids], "<i8").tobytes()], "nulls": [np.array([d is None for d in ids], np.uint8).tobytes()],
                "lengths": [np.array([len(x) // dtype.itemsize for _, x in held], "<u8").tobytes()], "ids": [b"".join(x for _, x in held)],
            }
            kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row.values(), kinds, strict=True)], list(row))

        for b in batches:
            for s, d, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if held and (s != shard or size + len(x) > block_ids * dtype.itemsize):
                    yield block()
                    held, size, seq = [], 0, (seq + 1 if s == shard else 0)
                shard = s
                held.append((d, x))
                size += len(x)
        if held:
            yield block()

    return tokens.mapInArrow(run, BLOCK)


def write_tokens(docs: DataFrame, path: str, end_id: int, out: str | None = None, shards: int | None = None, block_ids: int = BLOCK_IDS, bits: int = 20) -> str:
    """Encode docs with the tokenizer file at `path` into shards in folder `out` (a new shared one if not given), in
    ascending doc_id order (nulls first, ties by text digest); the folder. Null texts are empty. Repeated rows stay.

    Shards hold about as many bytes each (see plan_shards), so their number grows with the corpus. Ids are shuffled once, by
    shard; the blocks that a task reads back are already in order, so it writes its runs of them as files at once."""
    spark = docs.sparkSession
    out = out or new_path(spark, "shards")
    size, dtype = encoder(path).size, encoder(path).dtype
    plan = plan_shards(docs, shards)
    tokens = token_ids(docs, path, end_id, plan)
    tokens = tokens.repartitionById(plan.count, F.col("shard")).sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "key").select("shard", "doc_id", "ids")
    blocks = stage(_blocks(tokens, dtype, block_ids), "blocks", "zstd")
    del tokens
    release(spark)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            for x in b.column(0).to_pylist():
                total += np.bincount(np.frombuffer(x, dtype), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    counts = np.zeros(size, np.int64)
    with large_rows(spark):
        for r in blocks.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
            counts[r["id"]] = r["n"]  # a row an id of the vocabulary
    table = Table(counts, bits)
    write_whole(f"{out}/table.freq", [table.dump()])
    dumped = table.dump()

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each run of consecutive blocks of a shard as a file, named by the shard and its first block: a task that runs
        again writes the same files."""
        own = Table.load(dumped)

        def packed() -> Iterator[tuple[int, int, int, bytes]]:
            for b in batches:
                for i in range(b.num_rows):
                    s, q, d, n, k, x = (b.column(j)[i].as_py() for j in range(6))
                    yield s, q, len(x) // dtype.itemsize, pack(np.frombuffer(d, "<i8"), np.frombuffer(n, np.uint8), np.frombuffer(k, "<u8"), np.frombuffer(x, dtype).astype(np.int64), own)

        rows = packed()
        done: list[tuple[int, int]] = []
        row = next(rows, None)
        while row is not None:
            shard, seq, places, at, ids = row[0], row[1], [], 0, 0

            def parts() -> Iterator[bytes]:
                nonlocal row, at, ids
                while row is not None and row[:2] == (shard, seq + len(places)):
                    places.append((at, len(row[3]), ids, row[2]))
                    at += len(row[3])
                    ids += row[2]
                    yield row[3]
                    row = next(rows, None)
                trailer = json.dumps({"blocks": places, "ids": ids, "width": dtype.itemsize}).encode()
                yield trailer + struct.pack(TAIL, len(trailer), zlib.crc32(trailer), b"TOKS")

            write_whole(f"{out}/shard-{shard:08d}-{seq:08d}.toks", parts())
            done.append((shard, ids))
        yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in done], pa.int32()), pa.array([n for _, n in done], pa.int64())], ["shard", "ids"])

    with large_rows(spark):
        blocks.mapInArrow(save, "shard int, ids long").write.format("noop").mode("overwrite").save()
    unstage(blocks)
    release(spark)
    return out


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32-bit), in file order by start.

    Files are listed by the driver, in the order of their names; trailers and blocks are read by the executors, each block a
    row that may go anywhere."""
    at, path = open_fs(f"{folder}/table.freq")
    with at.open_input_stream(path) as f:
        dumped = f.read()
    shards = spark.createDataFrame([(i, uri, size) for i, (uri, size) in enumerate(names(folder, ".toks"))], "shard int, uri string, size long")
    shards = shards.repartition(4 * spark.sparkContext.defaultParallelism)

    def trailers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s, uri, size in zip(*(c.to_pylist() for c in b.columns), strict=True):
                fs, path = open_fs(uri)
                with fs.open_input_file(path) as f:
                    f.seek(size - struct.calcsize(TAIL))
                    n, crc, magic = struct.unpack(TAIL, f.read(struct.calcsize(TAIL)))
                    f.seek(size - struct.calcsize(TAIL) - n)
                    body = f.read(n)
                if magic != b"TOKS" or zlib.crc32(body) != crc:
                    raise ValueError(f"{uri} is damaged")
                places = json.loads(body)["blocks"]
                cols = [pa.array([s] * len(places), pa.int32()), pa.array([uri] * len(places)), *(pa.array([p[i] for p in places], pa.int64()) for i in range(4))]
                yield pa.RecordBatch.from_arrays(cols, ["shard", "uri", "at", "size", "first", "n"])

    blocks = stage(shards.mapInArrow(trailers, "shard int, uri string, at long, size long, first long, n long"), "places")
    per = blocks.groupBy("shard").agg(F.sum("n").alias("ids"))
    base = per.select("shard", F.coalesce(F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    spread = blocks.join(base, "shard").select("uri", "at", "size", (F.col("base") + F.col("first")).alias("first")).repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), "uri", "at")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table.load(dumped)
        for b in batches:
            for uri, place, size, first in zip(*(c.to_pylist() for c in b.columns), strict=True):
                fs, path = open_fs(uri)
                with fs.open_input_file(path) as f:
                    f.seek(place)
                    doc_ids, nulls, lengths, ids = unpack(f.read(size), table)
                ends = np.cumsum(lengths)
                places = np.concatenate(([0], 4 * ends))
                each = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(places), pa.py_buffer(ids.astype("<u4"))])
                for i in range(0, len(each), 1024):
                    z = slice(i, i + 1024)
                    yield pa.RecordBatch.from_arrays([pa.array(doc_ids[z], mask=nulls[z]), pa.array(first + ends[z] - lengths[z]), pa.array(lengths[z]), each[z].cast(pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def tokenised(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every row of docs, read back from the shards that were written.

    Null texts are empty: the end id alone. Null ids come first. Repeated rows and ids stay, one document each. An empty
    table gives no shard and no row. Other columns are ignored."""
    spark = docs.sparkSession
    back = read_tokens(spark, write_tokens(docs, path, end_id))
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return tokenised(docs, public_tokenizers.path("word_bpe_49k.json"))
