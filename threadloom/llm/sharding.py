"""Sharding by minimax contiguous partition: the least capacity with which a greedy pass over the ordered groups of equal
texts fills at most so many shards, found by binary search; the shards are cut where that pass closes them.

Groups are atomic and ordered by the SHA-256 of their text, so their order needs no join and no group is ever gathered. The
search works on a table of digest prefixes with their bytes (at most NODES rows), whose rows are split by further digits
where a greedy pass could end inside them, until the passes that matter are exact. All work on rows is DataFrame functions.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free, running_total, stage

#: Rows of the table of prefixes that one job hands to the driver at most, hex digits of its first prefixes, and capacities
#: whose passes one round makes exact.
NODES, DIGITS, LEVELS = 1 << 16, 4, 48


def digest(text: Column) -> Column:
    """SHA-256 of a text in hex; a null text is an empty one."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def weight(text: Column, extra: int = 8) -> Column:
    """UTF-8 bytes of a text (null: none) plus a record's own bytes."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(extra)).cast("long")


class Ladder:
    """Sizes of ordered runs of groups: `nodes` maps a digest prefix to (size, whether it is one group)."""

    def __init__(self, nodes: dict[str, tuple[int, bool]]):
        self.nodes = nodes
        self.names = sorted(nodes)
        self.starts = [0, *accumulate(nodes[p][0] for p in self.names)]
        self.atomic = [nodes[p][1] for p in self.names]
        self.total = self.starts[-1]

    def steps(self, level: int, shards: int, high: bool, touched: set[str] | None = None) -> list[int]:
        """Ends of the shards that a greedy pass fills up to `level` each; a larger group has a shard alone. Where a pass ends
        inside a run of groups the end is a bound of the true one: from above if high, else from below."""
        ends, e = [], 0
        while e < self.total and len(ends) < shards:
            i, t = bisect_right(self.starts, e) - 1, min(e + level, self.total)
            j = bisect_right(self.starts, t) - 1
            sure = j == len(self.names) or self.atomic[j] or t == self.starts[j]
            full = self.starts[j] if sure or not high else t
            first = self.starts[i + 1] if self.atomic[i] or high else e + 1
            if touched is not None:
                if not sure:
                    touched.add(self.names[j])
                if not self.atomic[i] and full <= e + 1:
                    touched.add(self.names[i])
            e = max(full, first) if full <= e else full
            ends.append(e)
        return ends

    def least(self, shards: int, high: bool) -> int:
        """The least level with which that pass reaches the end."""
        lo, hi = 0, self.total
        while lo < hi:
            mid = (lo + hi) // 2
            ends = self.steps(mid, shards, high)
            lo, hi = (lo, mid) if not ends or ends[-1] >= self.total else (mid + 1, hi)
        return lo


def prefixes(base: DataFrame, into: list[str] | None, width: int) -> dict[str, tuple[int, bool]]:
    """Bytes of the digests below each prefix of `width` digits, and whether they are one; only below the prefixes `into`
    if these are given (all of one length)."""
    if into is not None:
        base = base.where(F.substring("digest", 1, len(into[0])).isin(into))
    per = base.groupBy(F.substring("digest", 1, width).alias("prefix")).agg(F.sum("size").alias("bytes"), (F.min("digest") == F.max("digest")).alias("one"))
    return {r["prefix"]: (r["bytes"], r["one"]) for r in per.collect()}  # at most 16 ** digits added a prefix


def plan(base: DataFrame, shards: int, digits: int = DIGITS) -> tuple[int, list[str]]:
    """The least level, and the least digests of the shards after the first; base has digest and size.

    Bounds of each pass from above and below give bounds of the level; the runs that passes between them touch are split,
    until both agree and the last pass ends at groups only."""
    ladder = Ladder(prefixes(base, None, digits))
    while True:
        lo, hi = ladder.least(shards, True), ladder.least(shards, False)
        touched: set[str] = set()
        for level in sorted({lo, hi, *(lo + (hi - lo) * i // LEVELS for i in range(1, LEVELS))}, key=lambda x: (x not in (lo, hi), x)):
            more = set(touched)
            ladder.steps(level, shards, True, more)
            ladder.steps(level, shards, False, more)
            if touched and len(more) > NODES // 16:
                break
            touched = more
        if lo == hi and not touched:
            break
        deeper = 2 if len(touched) <= NODES // 256 else 1
        for length in sorted({len(p) for p in touched}):
            mine = sorted(p for p in touched if len(p) == length)
            found = prefixes(base, mine, length + deeper)
            for p in mine:
                del ladder.nodes[p]
            ladder.nodes.update(found)
        ladder = Ladder(ladder.nodes)
    cuts = [ladder.names[ladder.starts.index(e)] for e in ladder.steps(lo, shards, False) if e < ladder.total]
    return lo, cuts


def among(value: Column, cuts: list[str], first: int = 0) -> Column:
    """How many of the sorted cuts are not after value, by a tree of comparisons."""
    if not cuts:
        return F.lit(first)
    mid = len(cuts) // 2
    return F.when(value < F.lit(cuts[mid]), among(value, cuts[:mid], first)).otherwise(among(value, cuts[mid + 1 :], first + mid + 1))


def shard(docs: DataFrame, shards: int = 24, doc_id: str = "doc_id", text: str = "text", extra: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: each row's shard and its place there, from 0 without gaps.

    Law `bytes`: documents of equal texts stay together, and no other cut of the ordered groups has a smaller largest shard.
    A group that alone is larger than that level has a shard of its own and the rest is dealt over the others. A shard's
    rows are in the order of digest, doc_id (nulls first) and row.

    A null text has no bytes and is in the group of the empty ones. Null doc_ids, ties and repeated rows are rows like any
    other; long texts count whole. With fewer groups than shards some shards are empty; an empty table gives none. Other
    columns are ignored. Hot groups are summed map-side and sorted with their doc_ids, never gathered."""
    text_, id_ = F.col(text), F.col(doc_id)
    base = docs.select(id_.alias("doc_id"), weight(text_, extra).alias("size"), F.crc32(F.coalesce(text_, F.lit("")).cast("binary")).alias("text_crc32"), digest(text_).alias("digest"), F.monotonically_increasing_id().alias("row"))
    base = stage(base, "texts")
    _, cuts = plan(base.select("digest", "size"), shards)
    placed = base.withColumn("shard", among(F.col("digest"), cuts).cast("int"))
    rows = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.count("*").alias("n")).collect()}  # a row a shard
    before = [0, *accumulate(rows.get(s, 0) for s in range(len(cuts)))]
    order = [F.col("digest"), F.col("doc_id").asc_nulls_first(), F.col("row")]
    ranked = running_total(placed, order, "size", "slots")
    slot = F.col("rank") - F.element_at(F.array(*[F.lit(b).cast("long") for b in before]), F.col("shard") + 1)
    return ranked.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", slot.alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = 24, text: str = "text", extra: int = 8) -> list[str]:
    """The documents themselves as Parquet, a folder shard=N each, rows in the order of digest; the digests of the cuts.

    Tasks are ranges of digests and salt inside a shard, so a hot group is written by many tasks as many files."""
    base = stage(docs.select(weight(F.col(text), extra).alias("size"), digest(F.col(text)).alias("digest")), "texts")
    _, cuts = plan(base, shards)
    at, key, salt = free(docs, "shard", "_digest", "_salt")
    salted = docs.withColumn(key, digest(F.col(text))).withColumn(at, among(F.col(key), cuts).cast("int")).withColumn(salt, F.monotonically_increasing_id())
    salted.repartitionByRange(F.col(at), F.col(key), F.col(salt)).sortWithinPartitions(at, key, salt).drop(key, salt).write.partitionBy(at).parquet(path)
    return cuts


def op13_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


#: CRC-32 by its table of 256 remainders, the search as one recursion whose step is a shard of a greedy pass.
OP13_SQL = r"""
with recursive d as (
  select row_number() over () as rid, doc_id, sha256(coalesce(text, '')) as digest, (coalesce(octet_length(encode(text)), 0) + 8)::bigint as size,
    upper(hex(encode(coalesce(text, '')))) as bytes from documents),
poly as (select list(v order by n) as t from (select n, list_reduce(list_prepend(n, range(8)), lambda c, k: if(c % 2 = 1, xor(c // 2, 3988292384), c // 2)) as v from (select unnest(range(256)) as n))),
crc as (select rid, xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(bytes, '..'), lambda h: ('0x' || h)::bigint)),
    lambda c, b: xor(c // 256, t[(xor(c, b) & 255) + 1])), 4294967295)::bigint as text_crc32 from d, poly),
g as (select digest, sum(size)::bigint as size, sum(sum(size)) over (order by digest)::bigint as upto from d group by digest),
all_ends as (select list(upto order by upto) as p, coalesce(max(upto), 0) as total from g),
pass(lo, hi, mid, edge, used) as (
  select 0::bigint, total, total // 2, 0::bigint, 0 from all_ends
  union all
  select if(done, lo2, lo), if(done, hi2, hi), if(done, (lo2 + hi2) // 2, mid), if(done, 0, nxt), if(done, 0, used + 1) from (
    select *, nxt >= total or used + 1 >= 24 as done, if(nxt >= total, lo, mid + 1) as lo2, if(nxt >= total, mid, hi) as hi2 from (
      select lo, hi, mid, edge, used, total, coalesce(greatest(list_max(list_filter(p, lambda x: x <= edge + mid and x > edge)), list_min(list_filter(p, lambda x: x > edge))), total) as nxt
      from pass, all_ends where lo < hi))),
level as (select lo from pass where lo = hi limit 1),
cut(edge, shard) as (
  select 0::bigint, 0
  union all
  select coalesce(greatest(list_max(list_filter(p, lambda x: x <= edge + lo and x > edge)), list_min(list_filter(p, lambda x: x > edge))), total), shard + 1 from cut, all_ends, level where edge < total),
s as (select g.digest, max(cut.shard) as shard from g join cut on cut.edge <= g.upto - g.size group by g.digest)
select doc_id, size, text_crc32, 'bytes' as law, shard::int as shard, row_number() over (partition by shard order by digest, doc_id nulls first, rid) - 1 as slot, null::int as grown_shard
from d join s using (digest) join crc using (rid)
"""
