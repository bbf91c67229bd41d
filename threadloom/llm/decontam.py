"""Benchmark decontamination over a positional inverted index, in DataFrame operations alone.

Training token postings (document, position) are stored for the rarest terms of each benchmark window, by their counts in
the whole corpus. Their lists, shifted by the term's offset in the window, are intersected into candidate places; the
postings of the windows' other terms, in the candidate documents only, then confirm exact phrases or proximity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, release, row_key, spread_join, stage, unstage

#: What separates words: ASCII other than digits and letters (once A-Z are lower case).
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Most terms that are broadcast, some 10 MB: a checked bound.
SMALL = 200_000
#: Rarest terms of a window whose lists are intersected first.
ANCHORS = 2


def tokens(text: Column) -> Column:
    """Words of a text in order; an empty string stands first or last where the text begins or ends with a break. Positions
    are places in this array, so they agree everywhere."""
    return F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAK)


def word_total(words: Column) -> Column:
    ends = F.when(F.size(words) == 1, (words[0] == "").cast("int")).otherwise((words[0] == "").cast("int") + (F.element_at(words, -1) == "").cast("int"))
    return (F.size(words) - ends).cast("long")


def windows(benchmark: DataFrame, length: int = 10) -> DataFrame:
    """(window, item_id, n, offset, term): a row a term of each window of `length` words; shorter items are one window."""
    items = benchmark.select("item_id", F.array_remove(tokens(F.col("text")), "").alias("words")).where(F.size("words") > 0)
    n = F.least(F.lit(length), F.size("words"))
    w = items.select("item_id", "words", n.alias("n"), F.explode(F.sequence(F.lit(1), F.size("words") - n + 1)).alias("first"))
    w = w.select("item_id", "n", F.slice("words", F.col("first"), F.col("n")).alias("words")).distinct()
    w = w.select(F.xxhash64(F.coalesce(F.col("item_id").cast("string"), F.lit("null")), F.concat_ws(" ", "words")).alias("window"), "item_id", "n", "words")
    return w.select("window", "item_id", "n", F.posexplode("words").alias("offset", "term"))


class Index:
    """The corpus seen through the terms of the benchmark. Rows of docs equal in doc_id and text are one document."""

    def __init__(self, docs: DataFrame, benchmark: DataFrame, length: int = 10, anchors: int = ANCHORS):
        self.docs = docs.select(F.col("doc_id").cast("long"), row_key().alias("key"), "text")
        self.windows = stage(windows(benchmark, length), "windows")
        # tables of their own, so that their sizes are known where a join asks whether they are small
        self.vocabulary = stage(self.windows.select("term").distinct(), "vocabulary")
        words = self.vocabulary.count()
        if words <= SMALL:
            counted = self._positions(self.docs).join(F.broadcast(self.vocabulary), "term").groupBy("term").agg(F.count("*").alias("total"))
        else:  # counted before they meet the vocabulary, so that no term meets in one task
            counted = self._positions(self.docs).groupBy("term").agg(F.count("*").alias("total")).join(self.vocabulary, "term", "left_semi")
        # a window with a term that the corpus lacks occurs nowhere
        rare = self.windows.join(stage(counted, "counts"), "term", "left")
        by = Window.partitionBy("window").orderBy(F.col("total").asc_nulls_first(), "offset")
        rare = rare.select("window", "offset", "term", F.row_number().over(by).alias("rank"), F.count_if(F.col("total").isNull()).over(Window.partitionBy("window")).alias("absent"))
        self.anchors = stage(rare.where(f"rank <= {anchors} and absent = 0").select("window", "rank", "term", "offset"), "anchors")
        used = stage(self.anchors.select("term").distinct(), "used")
        self.postings = stage(self._of_terms(self.docs, used).select("term", "doc_id", "key", "pos"), "postings")
        release(docs.sparkSession)

    @staticmethod
    def _positions(docs: DataFrame) -> DataFrame:
        return docs.select("doc_id", "key", F.posexplode(tokens(F.col("text"))).alias("pos", "term"))

    def _of_terms(self, docs: DataFrame, terms: DataFrame) -> DataFrame:
        """Positions in docs of the terms of a staged table: broadcast where there are few, else hot terms are dealt out."""
        if terms.count() <= SMALL:
            return self._positions(docs).join(F.broadcast(terms), "term")
        return spread_join(self._positions(docs), terms, ["term"], ["key", "pos"])

    def _all_postings(self, candidates: DataFrame) -> DataFrame:
        """Postings of every term of the benchmark in the candidates' documents."""
        at = candidates.select("doc_id", "key").distinct()
        docs = self.docs.join(at, (self.docs["key"] == at["key"]) & self.docs["doc_id"].eqNullSafe(at["doc_id"]), "left_semi")
        return self._of_terms(docs, self.vocabulary).select("doc_id", "key", "pos", "term").distinct()

    def phrases(self) -> DataFrame:
        """(doc_id, key, window, item_id, n, start): every exact occurrence of a window, start being its first position."""
        first = self._shifted(1).distinct()
        more = self._shifted(2).distinct().withColumnsRenamed({c: f"_{c}" for c in ("window", "doc_id", "key", "start")})
        both = (first["window"] == more["_window"]) & (first["key"] == more["_key"]) & first["doc_id"].eqNullSafe(more["_doc_id"]) & (first["start"] == more["_start"])
        alone = self.windows.where("n = 1").select("window").distinct()
        found = first.join(more, both, "left_semi").unionByName(first.join(alone, "window", "left_semi"))
        candidates = stage(found, "candidates")
        wanted = candidates.join(self.windows, "window").select("doc_id", "key", "window", "item_id", "n", "start", (F.col("start") + F.col("offset")).alias("pos"), "term")
        have = self._all_postings(candidates).withColumnsRenamed({"doc_id": "_doc_id", "key": "_key"})
        met = wanted.join(have, (wanted["key"] == have["_key"]) & (wanted["pos"] == have["pos"]) & (wanted["term"] == have["term"]) & wanted["doc_id"].eqNullSafe(have["_doc_id"]))
        return met.groupBy("doc_id", "key", "window", "item_id", "n", "start").count().where("count = n").drop("count")

    def near(self, span: int = 20) -> DataFrame:
        """(doc_id, key, window, item_id, start, end): places where all terms of a window (as often as it has them) lie
        within `span` words of the rarest one, in any order; start and end bound the terms met.

        Null and empty texts and items have no terms; an empty table gives no row. A term that stands oftener than the window
        has it counts once; of several places of the rarest term each is a row of its own (ties included). Very long texts are
        postings like any other, and rows equal in doc_id and text are one document. Other columns are ignored."""
        anchor = self._shifted(1, shift=False).distinct().withColumnRenamed("start", "at")
        have = self._all_postings(anchor).withColumnsRenamed({"doc_id": "_doc_id", "key": "_key"})
        needed = self.windows.groupBy("window", "item_id", "term").agg(F.count("*").alias("times"))
        kinds = needed.groupBy("window", "item_id").agg(F.count("*").alias("kinds"))
        wanted = anchor.join(needed, "window")
        close = (wanted["key"] == have["_key"]) & (wanted["term"] == have["term"]) & wanted["doc_id"].eqNullSafe(have["_doc_id"]) & have["pos"].between(wanted["at"] - span, wanted["at"] + span)
        met = wanted.join(have, close).groupBy("doc_id", "key", wanted["window"], "item_id", "at", wanted["term"], "times").agg(F.count("*").alias("seen"), F.min("pos").alias("lo"), F.max("pos").alias("hi")).where("seen >= times")
        met = met.groupBy("doc_id", "key", "window", "item_id", "at").agg(F.count("*").alias("met"), F.min("lo").alias("start"), F.max("hi").alias("end"))
        return met.join(kinds, ["window", "item_id"]).where("met = kinds").select("doc_id", "key", "window", "item_id", "start", "end")

    def _shifted(self, rank: int, shift: bool = True) -> DataFrame:
        a = self.anchors.where(F.col("rank") == rank).select("term", "window", "offset")
        at = F.col("pos") - F.col("offset") if shift else F.col("pos")
        return self.postings.join(a, "term").select("window", "doc_id", "key", at.alias("start"))


def hits(docs: DataFrame, benchmark: DataFrame, length: int = 10) -> DataFrame:
    """(_doc_id, _key, n_hit, n_items, items), staged, of the documents that hold any window."""
    index = Index(docs, benchmark, length)
    found = stage(index.phrases().select("doc_id", "key", "item_id", "start", "n"), "phrases")
    hit = found.select("doc_id", "key", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("pos")).distinct().groupBy("doc_id", "key").agg(F.count("*").alias("n_hit"))
    named = found.select("doc_id", "key", F.col("item_id").cast("string").alias("item")).distinct().groupBy("doc_id", "key").agg(F.count("*").alias("n_items"), F.array_sort(F.collect_list("item")).alias("items"))
    per = hit.join(named, hit["key"].eqNullSafe(named["key"]) & hit["doc_id"].eqNullSafe(named["doc_id"])).select(hit["doc_id"].alias("_doc_id"), hit["key"].alias("_key"), "n_hit", "n_items", "items")
    per = stage(per, "hits")
    unstage(index.postings)
    release(docs.sparkSession)
    return per


def clean(docs: DataFrame, benchmark: DataFrame, length: int = 10) -> DataFrame:
    """The rows of docs that hold no window of the benchmark."""
    per = hits(docs, benchmark, length).select("_doc_id", "_key")
    return docs.join(per, (row_key() == per["_key"]) & docs["doc_id"].eqNullSafe(per["_doc_id"]), "left_anti")


def contamination(docs: DataFrame, benchmark: DataFrame, length: int = 10) -> DataFrame:
    """doc_id, key, n_words, n_hit, n_items, items (ids as sorted strings) of every row of docs.

    A word inside any exact occurrence of a window is hit. Null and empty texts have no words; items without words and
    null item texts have no window; an item of null id counts as an item but is not listed. Repeated rows each get the
    same values; an empty benchmark hits nothing. Other columns are ignored."""
    per = hits(docs, benchmark, length)
    own = docs.select("doc_id", row_key().alias("key"), word_total(tokens(F.col("text"))).alias("n_words"))
    out = own.join(per, (own["key"] == per["_key"]) & own["doc_id"].eqNullSafe(per["_doc_id"]), "left")
    zero = F.lit(0).cast("long")
    return out.select("doc_id", "key", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP2_SQL = r"""
with d as (select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark),
w0 as (select item_id, ws, least(10, len(ws)) as n from b where len(ws) > 0),
w1 as (select item_id, ws, n, unnest(range(1, len(ws) - n + 2)) as p0 from w0),
w as (select distinct item_id, n, array_to_string(list_slice(ws, p0, p0 + n - 1), ' ') as win from w1),
lens as (select distinct n from w),
g0 as (select rid, ws, n, unnest(range(1, len(ws) - n + 2)) as p0 from d, lens where len(ws) >= n),
g as (select rid, n, p0, array_to_string(list_slice(ws, p0, p0 + n - 1), ' ') as win from g0),
f as (select g.rid, g.p0, g.n, w.item_id from g join w on g.n = w.n and g.win = w.win),
hit0 as (select distinct rid, unnest(range(p0, p0 + n)) as pos from f),
hit as (select rid, count(*) as n_hit from hit0 group by rid),
it as (select rid, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct rid, item_id::varchar as item from f) group by rid)
select doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (rid) left join it using (rid)
"""
