"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and how often ids meet over a corpus.

Each document's B tokens are a static interval index, two sorted arrays of byte offsets. Every A token asks it by bisection
which B tokens it overlaps; a gap between A tokens that no B token spans is a group boundary. Ids whose tokens share a
group are linked. Corpus-wide, links are counted by document: distinct pairs a slice of documents leave its task, are
summed, and come back to the slices that hold them.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import large_rows, stage

#: Bytes of text and texts of a slice, words that a worker remembers, bytes of the longest that it does, words encoded in one text,
#: links that are made at once.
SLICE_BYTES, SLICE_ROWS, MEMO, LONG, JOINED, LINKS = 3 << 20, 4096, 300_000, 64, 32, 1 << 21
#: What stands at the edge of a word that isn't cut off there: nothing, every blank of any tokenizer, and the
#: letter that stands for a space in pieces.
BLANK = {"", *map(chr, (0x180E, 0x200B, 0x2060, 0x2581, 0xFEFF)), *(chr(c) for c in range(0x3001) if chr(c).isspace())}
#: The byte-level configuration whose texts may be cut before a single space between two words.
BY_WORD = {"normalizer": None, "post_processor": None, "truncation": None, "padding": None}
BY_WORD_CUT = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


def byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write a byte as its Latin-1 letter if that is visible, else as the next letter from U+0100."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """A byte-level tokenizer (`tokenizers` JSON): ids of a space and the text, special tokens' strings as plain text."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters = byte_letters()
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        table = [b""] * (max(vocab.values()) + 1)
        for word, i in vocab.items():
            table[i] = bytes(letters[c] for c in word) if all(c in letters for c in word) else word.encode()
        self.table = table
        config = json.loads(self.tokenizer.to_str())
        cut = config.get("pre_tokenizer") or {}
        plain = all(t["special"] for t in config.get("added_tokens") or [])
        self.by_word = plain and {k: config.get(k) for k in BY_WORD} == BY_WORD and {k: cut.get(k) for k in BY_WORD_CUT} == BY_WORD_CUT and not config["model"].get("dropout")

    def encode(self, texts: list[str]) -> list[list[int]]:
        out: list[list[int]] = []
        for i in range(0, len(texts), 512):  # the library's encodings are large
            out += [e.ids for e in self.tokenizer.encode_batch_fast([" " + t for t in texts[i : i + 512]], add_special_tokens=False)]
        return out


class Pieces:
    """A SentencePiece model: ids of the text, before which it puts a space itself; no control pieces."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.piece_size())]
        self.table = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        spec = pb.ModelProto.FromString(self.model.serialized_model_proto()).normalizer_spec
        self.by_word = not spec.precompiled_charsmap and spec.add_dummy_prefix and not spec.remove_extra_whitespaces and not any("▁" in p.lstrip("▁") for p in names)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def width(size: int) -> np.dtype:
    return np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")


def cut_at(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The rows of data up to each end, as binary."""
    places = np.concatenate(([0], ends)).astype(np.int64) * data.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


def listed(strings: pa.Array) -> list[str]:
    """The strings as a list, several times as fast as to_pylist()."""
    return strings.to_numpy(zero_copy_only=False).tolist()


def edge(words: pa.Array, *cut: int) -> np.ndarray:
    """Whether the letter of each word that the slice cuts out is there and no blank."""
    letters = pc.utf8_slice_codeunits(words, *cut).dictionary_encode()
    return np.array([c not in BLANK for c in letters.dictionary.to_pylist()], bool)[letters.indices.to_numpy()]


class Pair:
    """Both tokenizers. Where neither joins anything across a single space between two words (a byte-level pattern starts
    anew at such a space; no piece has a space after another character), a text is cut there, its words are encoded once
    and remembered, and one whole text a slice, of any length, is encoded as well and compared. Any other two tokenizers
    get whole texts."""

    def __init__(self, a: str, b: str):
        self.sides = (ByteLevel(a), Pieces(b))
        self.types = [width(len(s.table)) for s in self.sides]
        self.bytes = [pa.array(s.table, pa.binary()) for s in self.sides]
        self.lengths = [np.array([len(x) for x in s.table], np.int64) for s in self.sides]
        self.by_word = all(s.by_word for s in self.sides)
        self.memo: dict[str, int] = {}
        self.held = [pa.array([], pa.binary())] * 2
        self.older: tuple[dict[str, int], list[pa.Array]] = ({}, self.held)
        self.turn = 0.0

    def _encode(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        each = ([np.array(x, t).tobytes() for x in s.encode(texts)] for s, t in zip(self.sides, self.types, strict=True))
        return zip(*each, strict=True)

    def _learn(self, words: pa.Array) -> list[pa.Array]:
        """Either side's ids of words without blanks at their edges, JOINED of them in one text: at the single spaces between
        them both start anew. Words of a text whose tokens are not its bytes, or span such a space, are encoded one by one."""
        starts = np.arange(0, len(words), JOINED)
        lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(words)).astype(np.int32)), words)
        lines, ends = listed(pc.binary_join(lists, " ")), np.cumsum(pc.binary_length(words).to_numpy() + 1, dtype=np.int64)
        out = []
        for side, t, lengths in zip(self.sides, self.types, self.lengths, strict=True):
            found = [np.array(x, t) for x in side.encode(lines)]
            sizes = np.cumsum(lengths[np.concatenate(found)])
            last = np.cumsum([len(x) for x in found])
            held = np.searchsorted(sizes, ends)
            right = sizes[np.minimum(held, len(sizes) - 1)] == ends
            if right.all() and held[-1] + 1 == last[-1]:
                out.append(cut_at(np.concatenate(found), held + 1))
                continue
            single: list[np.ndarray] = []
            for line, ids in zip(lists, found, strict=True):
                each = pc.binary_length(line.values).to_numpy() + 1
                sizes, ends_here = np.cumsum(lengths[ids]), np.cumsum(each)
                held = np.searchsorted(sizes, ends_here)
                if held[-1] + 1 == len(sizes) and np.array_equal(sizes[held], ends_here):
                    single += np.split(ids, held[:-1] + 1)
                else:
                    single += [np.array(x, t) for x in side.encode(listed(line.values))]
            out.append(cut_at(np.concatenate(single), np.cumsum([len(x) for x in single])))
        return out

    def _words(self, words: pa.Array, plain: np.ndarray) -> list[pa.Array]:
        """Either side's ids of the words, as binary. plain: without blanks at their edges. The memo is a word's place in two
        arrays; what is not asked while it fills goes."""
        if len(self.memo) > MEMO:
            self.older, self.memo = (self.memo, self.held), {}
            self.held = [x.slice(0, 0) for x in self.held]
        names = listed(words)
        place = np.fromiter(map(self.memo.get, names, repeat(-1)), np.int64, len(names))
        miss = np.flatnonzero(place < 0)
        before = np.fromiter((self.older[0].get(names[i], -1) for i in miss.tolist()), np.int64, len(miss))
        new = miss[before < 0]
        brief = pc.binary_length(words.take(pa.array(new))).to_numpy() <= LONG
        kinds = [new[plain[new] & brief], new[~plain[new] & brief], new[~brief]]  # words over LONG come last, and aren't remembered
        parts = [[held, old.take(pa.array(before[before >= 0]))] for held, old in zip(self.held, self.older[1], strict=True)]
        for k, which in enumerate(kinds):
            if len(which):
                own = words.take(pa.array(which))
                found = self._learn(own) if k == 0 else [pa.array(x, pa.binary()) for x in zip(*self._encode(listed(own)), strict=True)]
                for part, x in zip(parts, found, strict=True):
                    part.append(x)
        order = np.concatenate([miss[before >= 0], *kinds])
        size = len(self.memo)
        place[order] = np.arange(size, size + len(order))
        kept = len(order) - len(kinds[-1])
        self.memo.update(zip([names[i] for i in order[:kept].tolist()], range(size, size + kept), strict=True))
        whole = [pa.concat_arrays(part) for part in parts]
        self.held = [x.slice(0, size + kept) for x in whole]
        return [x.take(pa.array(place)) for x in whole]

    def encode(self, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids of all texts, end of each text's) for either side."""
        if not self.by_word:
            each = [list(x) for x in zip(*self._encode(texts.to_pylist()), strict=True)]
            return [(np.frombuffer(b"".join(x), t), np.cumsum([len(y) // t.itemsize for y in x])) for x, t in zip(each, self.types, strict=True)]
        lists = pc.split_pattern(texts, " ")
        flat = lists.flatten().dictionary_encode()
        words, at, ends = flat.dictionary, flat.indices.to_numpy(), np.asarray(lists.offsets)
        opens, closes = edge(words, 0, 1), edge(words, -1)
        cut = np.ones(len(at), bool)
        cut[1:] = closes[at[:-1]] & opens[at[1:]]
        cut[ends[:-1]] = True
        begin = np.flatnonzero(cut)
        size = np.diff(np.append(begin, len(at)))
        unit = at[begin].astype(np.int64)
        plain = opens & closes
        if len(more := np.flatnonzero(size > 1)):  # words with more than one space, or other blanks at an edge
            first = np.cumsum(size[more]) - size[more]
            inner = np.repeat(begin[more] - first, size[more]) + np.arange(int(size[more].sum()))
            runs = pa.ListArray.from_arrays(pa.array(np.append(first, len(inner)).astype(np.int32)), words.take(pa.array(at[inner])))
            joined = pc.binary_join(runs, " ").dictionary_encode()
            unit[more] = joined.indices.to_numpy().astype(np.int64) + len(words)
            plain = np.concatenate((plain, edge(joined.dictionary, 0, 1) & edge(joined.dictionary, -1)))
            words = pa.concat_arrays([words, joined.dictionary])
        used = np.zeros(len(words), bool)
        used[unit] = True
        pick = np.flatnonzero(used)
        place = np.cumsum(used) - 1
        found = self._words(words.take(pa.array(pick)), plain[pick])
        last = np.searchsorted(begin, ends[1:])
        out = []
        for k, t in enumerate(self.types):
            ids = found[k].take(pa.array(place[unit]))
            offsets = np.frombuffer(ids.buffers()[1], np.int32)[: len(ids) + 1]
            data = np.frombuffer(ids.buffers()[2] or b"", t, count=int(offsets[-1]) // t.itemsize)
            out.append((data, offsets[last] // t.itemsize))
        self._compare(texts, out)
        return out

    def _compare(self, texts: pa.Array, out: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """One text, another share of the way from the shortest to the longest each time."""
        self.turn = (self.turn + 0.6180339887498949) % 1
        i = int(np.argsort(pc.binary_length(texts).to_numpy(), kind="stable")[int(self.turn * len(texts))])
        if not texts[i].as_py():
            return
        for (ids, ends), whole in zip(out, next(self._encode([texts[i].as_py()])), strict=True):
            if ids[ends[i - 1] if i else 0 : ends[i]].tobytes() != whole:
                raise ValueError("these tokenizers' texts are not their words' ids one after another")

    def whole(self, texts: pa.Array, out: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Whether the text isn't empty and both sides' tokens are the bytes of a space and the text."""
        want = pc.binary_join_element_wise(pa.scalar(b"", pa.binary()), texts.cast(pa.binary()), b" ")
        there = pc.binary_length(want).to_numpy()
        sound = there > 1
        edges = np.concatenate(([0], np.cumsum(there)))
        joined = np.frombuffer(want.buffers()[2], np.uint8)
        for k, (ids, ends) in enumerate(out):
            sums = np.concatenate(([0], np.cumsum(self.lengths[k][ids])))
            first, last = sums[np.concatenate(([0], ends[:-1]))], sums[ends]
            own = np.frombuffer(self.bytes[k].take(pa.array(ids)).buffers()[2] or b"", np.uint8)
            sound &= last - first == there
            if not (sound | (there == 1)).all() or not np.array_equal(own, joined):
                for i in np.flatnonzero(sound).tolist():
                    sound[i] = np.array_equal(own[first[i] : last[i]], joined[edges[i] : edges[i + 1]])
        return sound


def stabbed(a_lengths: np.ndarray, b_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends (in A and in B tokens) of the groups of two token lists over the same bytes; no token is empty.

    B's starts and ends are the index; A token i overlaps the B tokens from low[i] to before high[i]."""
    a_end, b_end = np.cumsum(a_lengths), np.cumsum(b_lengths)
    low = np.searchsorted(b_end, a_end - a_lengths, "right")
    high = np.searchsorted(b_end - b_lengths, a_end, "left")
    free = np.ones(len(a_end), bool)
    free[:-1] = high[:-1] <= low[1:]  # no B token spans the gap after A token i
    return np.flatnonzero(free) + 1, high[free]


def pack_sizes(sizes: np.ndarray) -> np.ndarray:
    """A size as so many bytes of 255 as it holds, and the rest in one byte."""
    more = sizes // 255
    if not more.any():
        return sizes.astype(np.uint8)
    out = np.full(int(more.sum()) + len(sizes), 255, np.uint8)
    out[np.cumsum(more + 1) - 1] = sizes % 255
    return out


def unpack_sizes(data: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(data < 255)
    total = np.concatenate(([0], np.cumsum(data.astype(np.int64))[ends]))
    return np.diff(total)


#: One pair a worker process and files: its memo serves all tasks that the process runs.
PAIRS: dict[tuple[str, str], Pair] = {}


def pair_of(a: str, b: str) -> Pair:
    if (a, b) not in PAIRS:
        PAIRS[a, b] = Pair(a, b)
    return PAIRS[a, b]


ALIGNED = "slice long, doc_id long, a_ids binary, b_ids binary, a_sizes binary, b_sizes binary"


def aligned(docs: DataFrame, a: str, b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row a document, staged: a_ids, b_ids (little-endian, two bytes an id up to 65,536 ids, else four), a_sizes, b_sizes
    (tokens of each group, see pack_sizes), and the slice of documents that it was encoded with.

    Null and empty texts, and those whose tokens are not the bytes of a space and the text, have no tokens. Long texts
    are whole. Null doc_ids and repeated rows are rows like any other; an empty table gives none. Other columns are
    ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair_of(a, b)
        seq = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column(1).fill_null("")
            held = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
            first = 0
            while first < len(texts):
                base = held[first - 1] if first else 0
                n = min(SLICE_ROWS, max(1, int(np.searchsorted(held, base + SLICE_BYTES, "right")) - first))
                seq += 1
                yield one(both, seq, batch.column(0).slice(first, n), texts.slice(first, n))
                first += n
            del texts, batch
            pa.default_memory_pool().release_unused()

    def one(both: Pair, seq: int, ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        texts = pa.concat_arrays([texts])  # offsets of its own
        out = both.encode(texts)
        sound = both.whole(texts, out)
        kept = []
        for tokens, ends in out:
            n = np.diff(ends, prepend=0)
            kept.append((tokens[np.repeat(sound, n)], np.cumsum(np.where(sound, n, 0))))
        (x, x_ends), (y, y_ends) = kept
        a_groups, b_groups = stabbed(both.lengths[0][x], both.lengths[1][y])
        groups = np.searchsorted(a_groups, x_ends, "right")
        columns = [pa.array([seq] * len(ids), pa.int64()), ids, cut_at(x, x_ends), cut_at(y, y_ends)]
        for ends in (a_groups, b_groups):
            sizes = np.diff(ends, prepend=0)
            places = np.concatenate(([0], np.cumsum(sizes // 255 + 1)))
            columns.append(cut_at(pack_sizes(sizes), places[groups]))
        return pa.RecordBatch.from_arrays(columns, ["slice", "doc_id", "a_ids", "b_ids", "a_sizes", "b_sizes"])

    spark = docs.sparkSession
    with large_rows(spark):
        return stage(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, ALIGNED), "aligned", "zstd")


class Rows:
    """Aligned rows taken apart: flat ids and group sizes, and which row each group is of."""

    def __init__(self, a: pa.Array, b: pa.Array, a_sizes: pa.Array, b_sizes: pa.Array, types: list[np.dtype]):
        flat = lambda c, t: (np.frombuffer(c.buffers()[2] or b"", t) if len(c) else np.array([], t), pc.binary_length(c).to_numpy() // np.dtype(t).itemsize)
        a, b, a_sizes, b_sizes = (pa.concat_arrays(c.chunks if isinstance(c, pa.ChunkedArray) else [c]) for c in (a, b, a_sizes, b_sizes))
        self.count = len(a)
        (self.a, self.n_a), (self.b, self.n_b) = flat(a, types[0]), flat(b, types[1])
        packed, bytes_ = flat(a_sizes, np.uint8)
        self.na, self.nb = unpack_sizes(packed), unpack_sizes(flat(b_sizes, np.uint8)[0])
        closed = np.concatenate(([0], np.cumsum(packed < 255)))  # a group ends at a byte under 255
        ends = closed[np.cumsum(bytes_)]
        self.n_groups = np.diff(ends, prepend=0)
        self.row = np.repeat(np.arange(self.count), self.n_groups)

    def links(self, b_size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, a id * b_size + b id, links), once each, by row and pair. Links are made LINKS at a time; those of a group
        of more are made from its distinct ids."""
        a0, b0 = np.cumsum(self.na) - self.na, np.cumsum(self.nb) - self.nb
        n = self.na * self.nb
        small = np.flatnonzero(n <= LINKS)
        cuts = np.searchsorted(np.cumsum(n[small]), np.arange(LINKS, int(n[small].sum()) + LINKS, LINKS), "right")
        found: list[tuple[np.ndarray, np.ndarray]] = []

        span = (int(self.a.max(initial=0)) + 1) * b_size  # a row and a pair are one number, so they are sorted as such

        def add(key: np.ndarray, times: np.ndarray | None) -> None:
            if times is None:
                key = np.sort(key)
            else:
                order = np.argsort(key, kind="stable")
                key, times = key[order], times[order]
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.array([], np.int64)
            times = np.diff(np.append(first, len(key))) if times is None else np.add.reduceat(times, first) if len(first) else times
            found.append((key[first], times))

        for part in np.split(small, np.unique(cuts)):
            if not len(part):
                continue
            g = np.repeat(part, self.na[part])  # the group of each A token, which meets all of the group's B tokens
            token = np.arange(len(g)) + np.repeat(a0[part] - (np.cumsum(self.na[part]) - self.na[part]), self.na[part])
            m = self.nb[g]
            total = np.cumsum(m)
            at = np.repeat(b0[g] - (total - m), m)
            at += np.arange(len(at))
            key = np.repeat(self.row[g] * span + self.a[token].astype(np.int64) * b_size, m)
            key += self.b[at]
            add(key, None)
        for g in np.flatnonzero(n > LINKS).tolist():
            xs, cx = np.unique(self.a[a0[g] : a0[g] + self.na[g]], return_counts=True)
            ys, cy = np.unique(self.b[b0[g] : b0[g] + self.nb[g]], return_counts=True)
            step = max(1, LINKS // len(ys))
            for i in range(0, len(xs), step):
                pair = (xs[i : i + step, None].astype(np.int64) * b_size + ys[None]).ravel()
                add(int(self.row[g]) * span + pair, (cx[i : i + step, None] * cy[None]).ravel())
        if len(found) > 1:
            whole = [np.concatenate(c) for c in zip(*found, strict=True)]
            found = []
            add(*whole)
        key, times = found[0] if found else (np.array([], np.int64),) * 2
        row = key // span
        return row, key - row * span, times

    def texts(self, tables: list[pa.Array]) -> tuple[memoryview, np.ndarray]:
        """The groups as `a1,a2|b1;a3|b2,b3;`, all rows in one buffer, and each row's end in it. tables: an A id and a comma,
        or a bar; a B id and a comma, or a semicolon."""
        a_end, b_end = np.cumsum(self.na), np.cumsum(self.nb)
        take = np.empty(len(self.a) + len(self.b), np.int32)
        size = len(tables[0])
        own = self.a.astype(np.int32)
        own[a_end - 1] += size
        take[np.arange(len(self.a)) + np.repeat(b_end - self.nb, self.na)] = own
        other = self.b.astype(np.int32) + 2 * size
        other[b_end - 1] += len(tables[2])
        take[np.arange(len(self.b)) + np.repeat(a_end, self.nb)] = other
        whole = pa.concat_arrays(tables).take(pa.array(take))
        offsets = np.frombuffer(whole.buffers()[1], np.int32)
        return memoryview(whole.buffers()[2] or b""), offsets[np.cumsum(self.n_a + self.n_b)]


@functools.cache
def written(sizes: tuple[int, int]) -> list[pa.Array]:
    return [pa.array([f"{i}{mark}" for i in range(n)]) for n, marks in zip(sizes, (",|", ",;"), strict=True) for mark in marks]


def linked_counts(rows: DataFrame, types: list[np.dtype], b_size: int) -> tuple[DataFrame, DataFrame]:
    """(slice, pair, docs): documents of the slice that hold the pair linked, staged; (pair, n, best): documents of the
    corpus, and whether no other pair of its A id has more. best comes from a row an A id, at most the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slices = batch.column(0).to_numpy()
            edges = np.flatnonzero(np.diff(slices)) + 1
            for i, j in zip([0, *edges.tolist()], [*edges.tolist(), len(slices)], strict=True):
                if i < j:
                    part = batch.slice(i, j - i)
                    _, pair, _ = Rows(*(part.column(k) for k in range(1, 5)), types).links(b_size)
                    pair, docs = np.unique(pair, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), slices[i])), pa.array(pair), pa.array(docs)], ["slice", "pair", "docs"])
            del batch
            pa.default_memory_pool().release_unused()

    with large_rows(rows.sparkSession):
        held = stage(rows.select("slice", "a_ids", "b_ids", "a_sizes", "b_sizes").mapInArrow(run, "slice long, pair long, docs long"), "pairs")
    counts = stage(held.groupBy("pair").agg(F.sum("docs").alias("n")), "counts")
    most = counts.groupBy(F.expr(f"pair div {b_size}").alias("a")).agg(F.max("n").alias("most"))
    both = counts.join(F.broadcast(most), F.expr(f"pair div {b_size}") == F.col("a"))
    return held, both.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def bundled(rows: DataFrame) -> DataFrame:
    """(slice, rows): the aligned rows of a slice as compressed Arrow streams, one or a few a slice; a third less to shuffle
    than the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=4))
        for batch in batches:
            slices = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(slices)) + 1).tolist(), len(slices)]
            for i, j in zip(edges, edges[1:], strict=False):
                if i < j:
                    part = pa.RecordBatch.from_arrays([pa.concat_arrays([c.slice(i, j - i)]) for c in batch.columns[1:]], batch.schema.names[1:])
                    out = pa.BufferOutputStream()
                    with pa.ipc.new_stream(out, part.schema, options=options) as stream:
                        stream.write_batch(part)
                    yield pa.RecordBatch.from_arrays([pa.array([slices[i]]), pa.array([out.getvalue().to_pybytes()], pa.binary())], ["slice", "rows"])
            del batch
            pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, "slice long, rows binary")


OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def alignment(docs: DataFrame, a: str, b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair is in most documents of all pairs of its A id, ties
    included), count_sum (documents that hold the pair linked, summed over links) and groups_sha256, a row a document.

    Edge rows as in `aligned`; a document without tokens has zeros and ''. A slice's tokens and the counts of its distinct
    pairs meet in one task, both bounded by the slice; a pair has one row a slice, so none is hot."""
    both = pair_of(a, b)
    types, sizes = both.types, (len(both.sides[0].table), len(both.sides[1].table))
    rows = aligned(docs, a, b, doc_id, text)
    held, counts = linked_counts(rows, types, sizes[1])
    counted = held.select("slice", "pair").join(counts, "pair")

    def finish(rows: pa.Table, counts: pa.Table) -> pa.Table:
        PAIRS.clear()  # a worker that has encoded has no more use of its memo
        rows = pa.concat_tables(pa.ipc.open_stream(x.as_buffer()).read_all() for x in rows.column("rows"))
        r = Rows(*(rows.column(c) for c in ("a_ids", "b_ids", "a_sizes", "b_sizes")), types)
        row, pair, times = r.links(sizes[1])
        known, at = np.unique(counts.column("pair").to_numpy(), return_index=True)
        at = at[np.searchsorted(known, pair)]
        n, best = counts.column("n").to_numpy()[at], counts.column("best").to_numpy()[at]
        summed = lambda w: np.add.reduceat(np.append(w, 0), np.searchsorted(row, np.arange(r.count)))
        there = r.n_groups > 0
        total = lambda w: np.where(there, summed(w), 0)
        text, ends = r.texts(written(sizes))
        starts = np.concatenate(([0], ends[:-1]))
        shas = [hashlib.sha256(text[i : j - 1]).hexdigest() if i < j else "" for i, j in zip(starts.tolist(), ends.tolist(), strict=True)]
        columns = [rows.column("doc_id"), r.n_a, r.n_b, r.n_groups, total(times), total(np.where(best, times, 0)), total(n * times), shas]
        return pa.Table.from_arrays([c if i == 0 else pa.array(c, pa.string() if i == 7 else pa.int64()) for i, c in enumerate(columns)], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return bundled(rows).groupBy("slice").cogroup(counted.groupBy("slice")).applyInArrow(finish, OUT)


def groups(rows: DataFrame, a: str, b: str) -> DataFrame:
    """The groups of aligned rows as a table: doc_id, position, a_ids, b_ids (arrays) and the bytes [start, end) of the space
    and the text that they cover."""
    both = pair_of(a, b)
    types, lengths = both.types, both.lengths

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r = Rows(*(batch.column(k) for k in range(1, 5)), types)
            a_end, b_end = np.cumsum(r.na), np.cumsum(r.nb)
            lists = [pa.ListArray.from_arrays(pa.array(np.concatenate(([0], e)).astype(np.int32)), pa.array(x.astype(np.int32))) for e, x in ((a_end, r.a), (b_end, r.b))]
            bytes_ = np.concatenate(([0], np.cumsum(lengths[0][r.a])))
            first = np.cumsum(r.n_groups) - r.n_groups
            zero = np.repeat(bytes_[np.cumsum(r.n_a) - r.n_a], r.n_groups)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(r.row)), pa.array(np.arange(len(r.row)) - first[r.row]), *lists, pa.array(bytes_[a_end - r.na] - zero), pa.array(bytes_[a_end] - zero)], ["doc_id", "position", "a_ids", "b_ids", "start", "end"])

    return rows.select("doc_id", "a_ids", "b_ids", "a_sizes", "b_sizes").mapInArrow(run, "doc_id long, position long, a_ids array<int>, b_ids array<int>, start long, end long")


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return alignment(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
