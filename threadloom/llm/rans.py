"""Static range asymmetric numeral system over interleaved lanes, in numpy.

Symbol i of a block goes to lane i mod lanes. Lane states are 64-bit, renormalised by 32-bit words; all lanes take a step
at once, and lanes that need a word take the stream's next ones in lane order. The table is shared by all blocks.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

LOW = np.uint64(1 << 32)


class Table:
    """Frequencies scaled to a power of two; every symbol with a count keeps at least one slot."""

    def __init__(self, counts: np.ndarray, bits: int = 20):
        counts = np.asarray(counts, np.int64)
        seen = np.flatnonzero(counts)
        if len(seen) > 1 << bits:
            raise ValueError("more symbols than slots")
        self.bits = bits
        f = np.zeros(len(counts), np.int64)
        if len(seen):
            f[seen] = np.maximum(1, np.floor(counts[seen] / counts.sum() * (1 << bits)).astype(np.int64))
            order = seen[np.argsort(-f[seen], kind="stable")]
            over = int(f.sum()) - (1 << bits)
            if over < 0:
                f[order[0]] -= over
            i = 0
            while over > 0:  # the largest give way
                take = min(over, int(f[order[i]]) // 2)
                f[order[i]] -= take
                over -= take
                i = (i + 1) % len(order)
        self.freq = f.astype(np.uint64)
        self.start = np.concatenate(([0], np.cumsum(f)[:-1])).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(f)), f).astype(np.uint32)

    def dump(self) -> bytes:
        body = struct.pack("<II", self.bits, len(self.freq)) + self.freq.astype("<u4").tobytes()
        return body + struct.pack("<I", zlib.crc32(body))

    @classmethod
    def load(cls, data: bytes) -> Table:
        if zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
            raise ValueError("the frequency table is damaged")
        bits, n = struct.unpack_from("<II", data)
        return cls(np.frombuffer(data, "<u4", n, 8), bits)


def lanes_for(n: int) -> int:
    return max(1, min(2048, n // 256))


def encode(ids: np.ndarray, table: Table, every: int = 256) -> tuple[int, np.ndarray, list[tuple[int, np.ndarray]]]:
    """(lanes, words, checkpoints). A checkpoint is (place in words, lane states) before a step; the first is the start."""
    n, lanes = len(ids), lanes_for(len(ids))
    steps = -(-n // lanes)
    shift, top = np.uint64(table.bits), np.uint64(64 - table.bits)
    freq, start = table.freq[ids], table.start[ids]
    if n and not freq.all():
        raise ValueError("an id has no slot in the table")
    limit = freq << (top - np.uint64(1)) << np.uint64(1) if table.bits else freq
    full = freq >= np.uint64(1 << table.bits)  # the only symbol: no information, no limit
    x = np.full(lanes, LOW, np.uint64)
    out: list[np.ndarray] = []
    marks: list[tuple[int, np.ndarray]] = []
    written = 0
    for t in range(steps - 1, -1, -1):
        a, z = t * lanes, min(n, (t + 1) * lanes)
        m = z - a
        f, s = freq[a:z], start[a:z]
        v = x[:m]
        spill = (v >= limit[a:z]) & ~full[a:z]
        if spill.any():
            w = v[spill]
            out.append((w & np.uint64(0xFFFFFFFF)).astype(np.uint32))
            written += len(w)
            v[spill] = w >> np.uint64(32)
        q = v // f
        x[:m] = (q << shift) + (v - q * f) + s
        if t % every == 0:
            marks.append((written, x.copy()))
    words = np.concatenate(out[::-1]) if out else np.empty(0, np.uint32)
    return lanes, words, [(len(words) - w, s) for w, s in reversed(marks)]


def decode(n: int, lanes: int, words: np.ndarray, table: Table, at: tuple[int, np.ndarray] | None, first: int = 0, steps: int | None = None) -> np.ndarray:
    """Symbols from step `first` on, whose checkpoint is `at`; all up to the end of n symbols, or so many steps."""
    total = -(-n // lanes) if n else 0
    last = total if steps is None else min(total, first + steps)
    out = np.empty(max(0, min(n, last * lanes) - first * lanes), np.uint32)
    if not len(out):
        return out
    p, x = at[0], at[1].copy()
    shift, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    for t in range(first, last):
        m = min(n - t * lanes, lanes)
        v = x[:m]
        slot = v & mask
        s = table.symbol[slot]
        out[(t - first) * lanes : (t - first) * lanes + m] = s
        v = table.freq[s] * (v >> shift) + slot - table.start[s]
        need = v < LOW
        k = int(need.sum())
        if k:
            v[need] = (v[need] << np.uint64(32)) | words[p : p + k]
            p += k
        x[:m] = v
    return out


HEAD = struct.Struct("<4sIQQIIQII")


def pack(doc_ids: np.ndarray, nulls: np.ndarray, lengths: np.ndarray, ids: np.ndarray, table: Table, every: int = 256) -> bytes:
    """A block: header, documents, checkpoints, words. It holds whole documents and checksums of both its sides."""
    lanes, words, marks = encode(ids, table, every)
    body = b"".join(
        [doc_ids.astype("<i8").tobytes(), nulls.astype(np.uint8).tobytes(), lengths.astype("<u8").tobytes()]
        + [struct.pack("<Q", w) + s.astype("<u8").tobytes() for w, s in marks]
        + [words.astype("<u4").tobytes()]
    )
    crc = zlib.crc32(ids.astype("<u4").tobytes())
    return HEAD.pack(b"BLK1", lanes, len(doc_ids), len(ids), every, len(marks), len(words), zlib.crc32(body), crc) + body


def unpack(data: bytes, table: Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc_ids, nulls, lengths, ids) of a block. Damage raises."""
    _, lanes, docs, n, every, marks, count, body_crc, crc = HEAD.unpack_from(data)
    if zlib.crc32(memoryview(data)[HEAD.size :]) != body_crc:
        raise ValueError("a block is damaged")
    p = HEAD.size
    doc_ids = np.frombuffer(data, "<i8", docs, p)
    nulls = np.frombuffer(data, np.uint8, docs, p + 8 * docs).astype(bool)
    lengths = np.frombuffer(data, "<u8", docs, p + 9 * docs).astype(np.int64)
    p += 17 * docs
    points = []
    for _ in range(marks):
        points.append((struct.unpack_from("<Q", data, p)[0], np.frombuffer(data, "<u8", lanes, p + 8)))
        p += 8 + 8 * lanes
    words = np.frombuffer(data, "<u4", count, p).astype(np.uint64)
    ids = np.concatenate([decode(n, lanes, words, table, at, i * every, every) for i, at in enumerate(points)]) if n else np.empty(0, np.uint32)
    if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
        raise ValueError("a block's ids are damaged")
    return doc_ids, nulls, lengths, ids
