"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its shuffled documents, repeated for as many epochs as a document may be taken. A document's
virtual finish time is the source's cumulative size up to and with it over the source's target; a global range sort by
finish time, cut at the total budget, is the mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import free, row_key, running_total, stage

WORD = r"[^\x20\x09-\x0D]+"
#: Hex digits of the shuffle key that make a bucket: each source's queue is summed in 16**3 pieces.
BUCKET_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, cycle: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """One row a source: source, source_size, weight, target.

    Sources in code-point order, null last, take the weights in turn. share x all sizes is dealt by weight; a target stops
    at most x its source's size and the excess is dealt again, until none is above. Each round is one aggregate over the
    table of sources; there are at most as many rounds as sources, in practice a few."""
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    src = running_total(src, [F.col("source").asc_nulls_last()], "source_size", "sources")
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    src = src.select("source", "source_size", F.element_at(weights, (F.col("rank") % len(cycle) + 1).cast("int")).alias("weight"))
    src = stage(src, "weights")
    total = src.agg(F.sum("source_size")).first()[0] or 0
    budget, level, capped = share * total, 0.0, -1
    cap = F.col("source_size") * F.lit(float(most))
    while True:
        full = cap <= F.col("weight") * F.lit(level)
        row = src.agg(F.count_if(full), F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))).first()
        if row[0] == capped or not row[2]:
            break
        capped, level = row[0], (budget - row[1]) / row[2]
    return src.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def mix(docs: DataFrame, cycle: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2, seed: str = "mix", size: Column | None = None) -> DataFrame:
    """The mix's plan, a row a document: row, doc_id, key (row_key), source, size, source_size, target, copies, taken.

    Null sources are a source of their own, null or empty texts have size 0; with no words at all every target is 0. Null ids
    are shuffled by their texts, long texts count whole, an empty table gives an empty plan.
    Repeated rows are documents of their own. Ties in the shuffle order (equal ids) go by size, so rows that tie in all
    are alike in the result. Documents are never cut: each source's taken words come within about one document of its
    target. Extra columns are ignored. A hot source is summed in buckets of its shuffle key, never in one task."""
    size = word_count(F.col("text")) if size is None else size
    # documents without an id are told apart by their text, so they fall in many buckets
    shuffle = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("#"), row_key().cast("string")))))
    base = docs.select("doc_id", row_key().alias("key"), "source", size.alias("size"), shuffle.alias("shuffle"), F.monotonically_increasing_id().alias("row"))
    base = stage(base, "sizes").withColumn("bucket", F.substring("shuffle", 1, BUCKET_DIGITS))
    targets = source_targets(base, cycle, share, most)
    budget = share * (targets.agg(F.sum("source_size")).first()[0] or 0)
    pieces = base.groupBy("source", "bucket").agg(F.sum("size").alias("piece"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("source", "bucket", F.coalesce(F.sum("piece").over(earlier), F.lit(0)).alias("ahead"))
    pieces = pieces.join(targets, pieces["source"].eqNullSafe(targets["source"])).select(pieces["source"].alias("s"), pieces["bucket"].alias("b"), "ahead", "source_size", "target")
    inside = Window.partitionBy("source", "bucket").orderBy("shuffle", "doc_id", "size", "key", "row").rowsBetween(Window.unboundedPreceding, 0)
    queued = base.withColumn("inside", F.sum("size").over(inside))
    queued = queued.join(pieces, queued["source"].eqNullSafe(pieces["s"]) & (queued["bucket"] == pieces["b"]))
    finish = F.try_divide((F.col("epoch") - 1) * F.col("source_size") + F.col("ahead") + F.col("inside"), F.col("target"))
    served = queued.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(most)))).withColumn("finish", F.coalesce(finish, F.lit(0.0)))
    served = served.select("row", "doc_id", "key", "source", "size", "source_size", "target", "shuffle", "epoch", "finish")
    order = [F.col("finish"), F.col("source").asc_nulls_last(), F.col("epoch"), F.col("shuffle"), F.col("doc_id"), F.col("size"), F.col("key"), F.col("row")]
    served = running_total(served, order, "size", "served")
    kept = F.sum((F.col("before") + F.col("size") <= F.lit(float(budget))).cast("int"))
    plan = served.groupBy("row", "doc_id", "key", "source", "size", "source_size", "target").agg(kept.alias("copies"))
    return plan.withColumn("taken", F.col("copies") * F.col("size"))


def mixed_documents(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """docs with each row as often as the plan takes it (not at all for 0 copies); the columns of docs, whatever their names.

    Rows equal in doc_id and text share their copies, and one of them stands for all. Null ids and texts are rows like any
    other; an empty table gives none."""
    own, doc, planned, copies, rows, copy = free(docs, "_key", "_id", "_plan", "_copies", "_rows", "_copy")
    per = plan.groupBy(F.col("doc_id").alias(doc), F.col("key").alias(planned)).agg(F.sum("copies").alias(copies), F.count("*").alias(rows))
    keyed = docs.withColumn(own, row_key())
    both = keyed.join(per, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(own) == F.col(planned)))
    again = both.where(F.col(rows) > 1).dropDuplicates(["doc_id", own])
    both = both.where(F.col(rows) == 1).unionByName(again).where(F.col(copies) > 0)
    return both.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).select(*docs.columns)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


OP1_SQL = r"""
with d as (select row_number() over () as rid, doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
             md5('mix:' || coalesce(doc_id::varchar, '')) as shuffle from documents),
s0 as (select source, sum(size)::bigint as source_size from d group by source),
s1 as (select *, [3.0, 1.0, 2.0][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as w from s0),
s2 as (select *, 2.0::double * source_size as cap, row_number() over (order by 2.0::double * source_size / w, source nulls last) as k from s1),
s3 as (select *, coalesce(sum(cap) over (order by k rows between unbounded preceding and 1 preceding), 0) as before_cap,
         sum(w) over (order by k rows between current row and unbounded following) as rest_w, sum(source_size) over ()::double * 1.5 as budget from s2),
s4 as (select *, (budget - before_cap) / rest_w as level from s3),
lv as (select level, budget from s4 where cap > level * w or cap = 0 or k = (select max(k) from s4) order by (cap > level * w) desc, k limit 1),
t as (select source, source_size, least(cap, w * lv.level) as target from s4, lv),
q as (select d.*, t.source_size, t.target,
        sum(size) over (partition by d.source order by shuffle, doc_id, size, rid rows unbounded preceding) as place
      from d join t on d.source is not distinct from t.source),
e as (select q.*, epoch, coalesce(((epoch - 1) * source_size + place)::double / nullif(target, 0), 0) as finish from q, (values (1), (2)) v(epoch)),
r as (select *, sum(size) over (order by finish, source nulls last, epoch, shuffle, doc_id, size, rid rows unbounded preceding) as upto from e)
select doc_id, size, any_value(source_size) as source_size, any_value(target) as target, sum(case when upto <= (select budget from lv) then size else 0 end)::bigint as taken
from r group by rid, doc_id, size
"""
