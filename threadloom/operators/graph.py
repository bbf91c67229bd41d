"""The co-mention graph: pair weights, communities and criticality of targets.

Pairs come from an equi-join of a session's distinct targets with themselves. The co-change graph leaves out sessions of
over 60 targets, as the reference does; plain co-mentions pair sessions of any size, and long ones are dealt out as pairs of
blocks, so no session meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import scratch
from .communities import louvain
from .ordering import first_per_key, numbered

#: The weights of the signals, and valences that count as strong.
WEIGHTS = {"blast_radius": 0.30, "event_volume": 0.20, "recency": 0.15, "valence_intensity": 0.15, "concern_weight": 0.20}
STRONG = ["frustrated", "confident", "negative", "positive", "urgent"]
MOST_TARGETS, TOP = 60, 30
#: Targets of one session that one task pairs; longer sessions are dealt out in pairs of blocks.
BLOCK = 1024


def auto_min_weight(sessions: int) -> int:
    return 2 if sessions < 1000 else 3


def session_targets(events: DataFrame) -> DataFrame:
    """(session_id, target_id, n, valence, concern, date): the long form of a graph session. The dominant valence is the most
    frequent, ties by first seen."""
    e = events.where("target_id is not null and target_id <> ''")
    v = e.where("valence is not null").groupBy("session_id", "target_id", "valence").agg(F.count("*").alias("c"), F.min("seq").alias("first"))
    v = v.groupBy("session_id", "target_id").agg(F.min_by("valence", F.struct((-F.col("c")).alias("c"), "first")).alias("valence"))
    dates = events.groupBy("session_id").agg(F.to_date(F.min("ts")).alias("date"))
    per = e.groupBy("session_id", "provider", "target_id").agg(F.count("*").alias("n"), F.bool_or(F.col("mention_type") == "concern_raised").alias("concern"))
    return per.join(v, ["session_id", "target_id"], "left").join(dates, "session_id")


def cochange(events: DataFrame, min_weight: int | None = None, most_targets: int = MOST_TARGETS, top: int = TOP) -> DataFrame:
    """(src, dst, weight, rank): directed edges, each target's heaviest `top` partners; sessions of over `most_targets` targets
    make no pairs. Ties in weight go by partner."""
    if min_weight is None:
        min_weight = auto_min_weight(events.select("session_id").distinct().count())
    pairs = co_mentions(events, most_targets).where(F.col("weight") >= min_weight)
    return first_per_key(pairs, ["src"], [F.col("weight").desc(), F.col("dst")], top, "rank")


def co_mentions(events: DataFrame, most_targets: int | None = None, block: int = BLOCK) -> DataFrame:
    """(src, dst, weight): sessions that mention both, in both directions. The pairs are made once, a before b, and turned
    round after they are summed. Sessions over most_targets make none (null: all do).

    Sessions of up to `block` targets are joined with themselves on the session, which the sizes share. A longer one is cut
    into blocks by hash: each target goes to every pair of blocks its own is in; targets of one block meet in that block's
    pair with itself alone, those of two in the one pair of the two."""
    st = events.where("target_id is not null and target_id <> ''").select("session_id", "target_id").distinct()
    sizes = st.groupBy("session_id").agg(F.count("*").alias("size")).where("size >= 2")
    if most_targets is not None:
        sizes = sizes.where(F.col("size") <= most_targets)
    sized = st.join(sizes, "session_id")
    short = sized.where(F.col("size") <= block)
    pairs = short.select("session_id", F.col("target_id").alias("a")).join(short.select("session_id", F.col("target_id").alias("b")), "session_id").where("a < b").select("a", "b")
    if most_targets is None or most_targets > block:
        pairs = pairs.unionByName(_dealt_pairs(sized.where(F.col("size") > block), block))
    half = pairs.groupBy("a", "b").agg(F.count("*").alias("weight"))
    both = F.array(F.struct(F.col("a").alias("src"), F.col("b").alias("dst")), F.struct(F.col("b").alias("src"), F.col("a").alias("dst")))
    return half.select(F.explode(both).alias("e"), "weight").select("e.src", "e.dst", "weight")


def _dealt_pairs(sized: DataFrame, block: int) -> DataFrame:
    """(a, b) of each session's pairs of targets, made in pairs of blocks."""
    st = sized.withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    st = st.withColumn("own", F.pmod(F.xxhash64("target_id"), F.col("blocks")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least("own", j).alias("lo"), F.greatest("own", j).alias("hi")))
    st = st.select("session_id", "target_id", "own", F.explode(pairs).alias("p")).select("session_id", "target_id", "own", "p.lo", "p.hi")
    on = ["session_id", "lo", "hi"]
    a, b = st.select(*on, F.col("target_id").alias("a"), F.col("own").alias("oa")), st.select(*on, F.col("target_id").alias("b"), F.col("own").alias("ob"))
    return a.join(b, on).where("a < b and (oa <> ob or lo = hi)").select("a", "b")


def cochange_meta(events: DataFrame, most_targets: int = MOST_TARGETS) -> DataFrame:
    per = events.groupBy("session_id").agg(F.count_distinct(F.when(F.col("target_id") != "", F.col("target_id"))).alias("targets"))
    return per.agg(F.count("*").alias("total_sessions"), F.count_if(F.col("targets") > most_targets).alias("skipped_mega_sessions"))


def normalised(value: str) -> Column:
    """Min-max over all rows; half where all are equal. Over rows that are one a target already."""
    all_ = Window.partitionBy()
    lo, hi = F.min(value).over(all_), F.max(value).over(all_)
    return F.when(F.col(value).isNull(), 0.0).when(hi == lo, 0.5).otherwise((F.col(value) - lo) / (hi - lo))


def criticality(events: DataFrame, edges: DataFrame) -> DataFrame:
    """(target_id, five signals, score, rank, reasons): signals of one session-target frame in a single aggregate, joined
    with the edges' degrees; extremes of each signal come from a one-row aggregate."""
    st = session_targets(events)
    per = st.groupBy("target_id").agg(
        F.sum("n").cast("double").alias("event_volume"), F.max(F.unix_date("date")).cast("double").alias("recency"),
        F.avg(F.coalesce(F.col("valence").isin(STRONG), F.lit(False)).cast("double")).alias("valence_intensity"), F.avg(F.col("concern").cast("double")).alias("concern_weight"),
    )
    radius = edges.groupBy(F.col("src").alias("target_id")).agg(F.count("*").cast("double").alias("blast_radius"))
    x = per.join(radius, "target_id", "full_outer")
    ends = x.agg(*[f(c).alias(f"{n}_{c}") for c in WEIGHTS for n, f in (("lo", F.min), ("hi", F.max))])
    x = x.crossJoin(F.broadcast(ends))  # one row by construction
    scaled = {c: F.round(F.when(F.col(c).isNull(), 0.0).when(F.col(f"hi_{c}") == F.col(f"lo_{c}"), 0.5).otherwise((F.col(c) - F.col(f"lo_{c}")) / (F.col(f"hi_{c}") - F.col(f"lo_{c}"))), 4) for c in WEIGHTS}
    x = x.select("target_id", *[e.alias(c) for c, e in scaled.items()])
    # in whole ten-thousandths and hundredths, so that halves round alike everywhere
    score = sum((F.round(F.col(c) * 10_000).cast("long") * round(100 * w) for c, w in WEIGHTS.items()), F.lit(0))
    x = x.withColumn("score", F.floor((score + 50) / 100) / F.lit(10_000.0))
    high = F.filter(F.array(*[F.struct((-F.col(c)).alias("v"), F.lit(i).alias("i"), F.lit(c).alias("name")) for i, c in enumerate(WEIGHTS)]), lambda s: s["v"] < -0.5)
    reasons = F.array_join(F.transform(F.slice(F.array_sort(high), 1, 4), lambda s: s["name"]), ",")
    return x.select("target_id", *WEIGHTS, "score", reasons.alias("reasons"))


def ranked(scores: DataFrame, n: int | None = None) -> DataFrame:
    """Rank by score, ties by target: of the top n by a bounded sort, of all by a range sort and a row a range."""
    order = [F.col("score").desc(), F.col("target_id")]
    if n is None:
        return numbered(scores, order).withColumn("rank", F.col("rank").cast("int"))
    return scores.orderBy(*order).limit(n).withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component): the smallest node reachable, by spreading the smallest label along edges and then jumping to the
    label's own label, until nothing changes. Each round is checkpointed."""
    scratch(edges.sparkSession)
    e = edges.select(F.col(src).alias("a"), F.col(dst).alias("b"))
    e = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().checkpoint()
    label = e.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")).checkpoint()
    while True:
        seen = e.join(label, e["b"] == label["node"]).groupBy("a").agg(F.min("component").alias("near"))
        new = label.join(seen, label["node"] == seen["a"]).select("node", F.least("component", "near").alias("component"))
        jump = new.select(F.col("node").alias("n2"), F.col("component").alias("c2"))
        new = new.join(jump, new["component"] == jump["n2"], "left").select("node", F.least("component", F.coalesce("c2", "component")).alias("component")).checkpoint()
        old = label.select(F.col("node").alias("n3"), F.col("component").alias("c3"))
        moved = new.join(old, (F.col("node") == F.col("n3")) & (F.col("component") != F.col("c3"))).limit(1).count()
        label = new
        if not moved:
            return label


def modularity(edges: DataFrame, communities: DataFrame, resolution: float = 1.0) -> DataFrame:
    """One row: modularity of the communities over the kept edges, both directions added."""
    c = communities.select("node", "community")
    e = edges.join(c.withColumnsRenamed({"node": "src", "community": "cs"}), "src").join(c.withColumnsRenamed({"node": "dst", "community": "cd"}), "dst")
    inside = e.agg(F.sum(F.when(F.col("cs") == F.col("cd"), 2 * F.col("weight")).otherwise(0)).alias("inside"), F.sum(2 * F.col("weight")).alias("total"))
    degree = e.select(F.col("cs").alias("c"), "weight").unionByName(e.select(F.col("cd").alias("c"), "weight")).groupBy("c").agg(F.sum("weight").alias("d"))
    square = degree.agg(F.sum(F.col("d").cast("double") * F.col("d")).alias("square"))
    return inside.crossJoin(square).select((F.col("inside") / F.col("total") - resolution * F.col("square") / (F.col("total").cast("double") * F.col("total"))).alias("modularity"))


def community_labels(communities: DataFrame, words: int = 3) -> DataFrame:
    """(community, size, label): the words of three letters and more that most members' names hold, numbers left out."""
    tokens = communities.select("community", F.explode(F.split(F.lower("node"), r"[^\p{L}\p{N}]+")).alias("w")).where("length(w) >= 3 and not w rlike '^[0-9]+$'")
    counted = tokens.groupBy("community", "w").agg(F.count("*").alias("n"))
    by = Window.partitionBy("community").orderBy(F.col("n").desc(), "w")
    top = counted.withColumn("r", F.row_number().over(by)).where(F.col("r") <= words)
    named = top.groupBy("community").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "w"))), lambda s: s["w"]), " / ").alias("label"))
    return communities.groupBy("community").agg(F.count("*").alias("size")).join(named, "community", "left")


def ripple(edges: DataFrame, scores: DataFrame) -> DataFrame:
    """One row a target with edges: its neighbours by weight and its criticality, if any."""
    near = edges.groupBy(F.col("src").alias("target_id")).agg(F.array_sort(F.collect_list(F.struct(F.col("rank"), F.col("dst").alias("target"), F.col("weight")))).alias("neighbours"))
    return near.join(scores.select("target_id", "score"), "target_id", "left")


def shards(rows: DataFrame) -> DataFrame:
    """(name, text): a JSON text for each row of ripple(), under a file name of its own."""
    from .vault import file_names

    near = F.transform("neighbours", lambda n: F.struct(n["target"].alias("target"), n["weight"].alias("weight")))
    text = F.to_json(F.struct(F.col("target_id").alias("target"), near.alias("neighbors"), F.col("score").alias("criticality")))
    return rows.join(file_names(rows), "target_id").select("name", text.alias("text"))


def community_table(communities: DataFrame, most: int = 25) -> DataFrame:
    """(community, size, label, members): members by name, the first `most` of them; size counts all."""
    r = F.row_number().over(Window.partitionBy("community").orderBy("node"))
    shown = communities.withColumn("r", r).where(F.col("r") <= most).groupBy("community").agg(F.array_sort(F.collect_list("node")).alias("members"))
    return community_labels(communities).join(shown, "community")


def community_meta(edges: DataFrame, communities: DataFrame, resolution: float = 1.0) -> DataFrame:
    """One row: communities, modularity to four places, targets and undirected edges."""
    n = communities.agg(F.count_distinct("community").alias("n_communities"), F.count("*").alias("total_modules"))
    pairs = edges.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct().agg(F.count("*").alias("total_edges"))
    m = modularity(edges, communities, resolution).select(F.round("modularity", 4).alias("modularity"))
    return n.crossJoin(F.broadcast(pairs)).crossJoin(F.broadcast(m)).withColumn("resolution", F.lit(resolution))  # one row each


def bundle(events: DataFrame, min_weight: int | None = None, resolution: float = 1.0) -> dict[str, DataFrame]:
    edges = cochange(events, min_weight)
    communities = louvain(edges, resolution)
    return {"cochange": edges, "communities": communities, "community_table": community_table(communities), "community_meta": community_meta(edges, communities, resolution), "criticality": criticality(events, edges), "meta": cochange_meta(events)}
