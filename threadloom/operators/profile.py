"""Inferences over a log of mention events.

An event has seq (a total order that breaks ties), ts_raw (the time as written; order is by this string, missing first),
ts (the time parsed, for arithmetic), session_id, provider, target_id, target_type, mention_type and valence.

Everything per target is an aggregate with map-side combination or a window over targets; state of a group is bounded by
its result, except for the lists that are the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import stage
from .ordering import first_per_key, with_previous

#: Fixed values of the model.
SETTLED = ["positive", "confident"]
STUCK = ["frustrated", "negative"]
INTRODUCED = ["first_introduction", "decision_made"]
DAY = 8.64e10


def days(a: Column, b: Column) -> Column:
    """Absolute difference in days."""
    return F.abs(F.unix_micros(b) - F.unix_micros(a)) / F.lit(DAY)


def when_key() -> Column:
    """Orders events in time: the raw time, then seq."""
    return F.struct(F.coalesce("ts_raw", F.lit("")).alias("t"), F.col("seq"))


def timeline() -> Window:
    return Window.partitionBy("target_id").orderBy(F.coalesce("ts_raw", F.lit("")), "seq")


def present(events: DataFrame) -> DataFrame:
    """Events with a target."""
    return events.where("target_id is not null and target_id <> ''")


def first_type() -> Column:
    return F.min_by("target_type", "seq").alias("target_type")


#: Facts of a target that inferences are projections of; each set is made by one aggregate over its events.
def basic() -> dict[str, Column]:
    return {
        "target_type": first_type(), "event_count": F.count("*"), "providers": F.array_sort(F.collect_set("provider")), "first_seq": F.min("seq"),
        "first_seen": F.min_by("ts", when_key()), "last_seen": F.max_by("ts", when_key()),
    }


def concerns() -> dict[str, Column]:
    """How often raised and resolved, in which sessions, and when first."""
    out = {}
    for kind in ("raised", "resolved"):
        is_ = F.col("mention_type") == f"concern_{kind}"
        listed = F.array_sort(F.collect_list(F.when(is_, F.struct("seq", "session_id"))))
        out |= {kind: F.count_if(is_), f"{kind}_in": F.array_join(F.transform(listed, lambda e: e["session_id"]), ","), f"{kind}_at": F.min_by("ts", F.when(is_, when_key()))}
    return out


def introductions() -> dict[str, Column]:
    """The first event and the first that introduces the target."""
    event = F.struct("ts", "seq")
    return {"first": F.min_by(event, when_key()), "intro": F.min_by(event, F.when(F.col("mention_type").isin(INTRODUCED), when_key()))}


def aggregate(events: DataFrame, *facts: dict[str, Column]) -> DataFrame:
    return events.groupBy("target_id").agg(*[c.alias(n) for f in facts for n, c in f.items()])


def tails(events: DataFrame, last: int = 3) -> DataFrame:
    """(target_id, tail): the last events of each target in time, from at most `last` of them a map task."""
    newest = first_per_key(events.select("target_id", "ts_raw", "seq", "valence", "mention_type"), ["target_id"], [F.coalesce("ts_raw", F.lit("")).desc(), F.col("seq").desc()], last)
    return newest.groupBy("target_id").agg(F.array_sort(F.collect_list(F.struct(when_key().alias("k"), "valence", "mention_type"))).alias("tail"))


def convergence(events: DataFrame, least: int = 3, last: int = 3) -> DataFrame:
    """Targets of at least three events by how their last three end: settled, possibly_abandoned_or_stuck or ambiguous.

    Facts come from one aggregate, the last events from a bounded number a map task: no target's events are sorted whole."""
    e = present(events)
    return _convergence(aggregate(e, basic()).where(F.col("event_count") >= least).join(tails(e, last), "target_id"), least)


def _convergence(facts: DataFrame, least: int = 3) -> DataFrame:
    good = F.exists("tail", lambda e: e["valence"].isin(SETTLED) | (e["mention_type"] == "concern_resolved"))
    bad = F.exists("tail", lambda e: e["valence"].isin(STUCK))
    status = F.when(F.coalesce(good, F.lit(False)), "settled").when(F.coalesce(bad, F.lit(False)), "possibly_abandoned_or_stuck").otherwise("ambiguous")
    listed = F.array_join(F.transform("tail", lambda e: e["valence"]), ",", "")
    return facts.where(F.col("event_count") >= least).select("target_id", "target_type", "event_count", F.array_join("providers", ",").alias("providers"), "first_seen", "last_seen", listed.alias("last_valences"), status.alias("status"))


def concern_lifecycle(events: DataFrame) -> DataFrame:
    """Targets with a raised concern: how often raised and resolved, in which sessions, resolved or latent."""
    return _lifecycle(aggregate(present(events).where("mention_type in ('concern_raised', 'concern_resolved')"), concerns()))


def _lifecycle(facts: DataFrame) -> DataFrame:
    return facts.where("raised > 0").select("target_id", "raised", "resolved", "raised_in", "resolved_in", F.when(F.col("resolved") > 0, "resolved").otherwise("latent_unresolved").alias("status"))


def cross_provider(events: DataFrame, least: int = 2) -> DataFrame:
    """Targets that several providers mention."""
    return _reach(aggregate(present(events), {k: v for k, v in basic().items() if k in ("providers", "event_count")}), least)


def _reach(facts: DataFrame, least: int = 2) -> DataFrame:
    return facts.where(F.size("providers") >= least).select("target_id", F.size("providers").cast("long").alias("provider_count"), F.array_join("providers", ",").alias("providers"), "event_count")


def entity_frequency(events: DataFrame, n: int = 30) -> DataFrame:
    """The n most mentioned targets, ties by first mention, with their type and providers."""
    return _frequency(aggregate(present(events), {k: v for k, v in basic().items() if k in ("target_type", "providers", "event_count", "first_seq")}), n)


def _frequency(facts: DataFrame, n: int = 30) -> DataFrame:
    return facts.orderBy(F.col("event_count").desc(), "first_seq").limit(n).select("target_id", "target_type", "event_count", F.array_join("providers", ",").alias("providers"))


def drift_recurrence(drifts: DataFrame, trigger: str = "trigger", detail: str = "detail", examples: int = 3) -> DataFrame:
    """How often each trigger of drift recurs, with its first examples. Null triggers are one of their own."""
    counted = drifts.groupBy(trigger).agg(F.count("*").alias("count"))
    few = first_per_key(drifts.select(trigger, "seq", F.col(detail).alias("_d")), [trigger], [F.col("seq")], examples)
    few = few.groupBy(F.col(trigger).alias("_t")).agg(F.array_sort(F.collect_list(F.struct("seq", F.col("_d").alias("d")))).alias("_shown"))
    return counted.join(few, counted[trigger].eqNullSafe(few["_t"])).select(trigger, "count", F.array_join(F.transform("_shown", lambda e: e["d"]), "|").alias("examples"))


def corpus_now(events: DataFrame) -> DataFrame:
    """One row: the greatest raw time."""
    return events.where("ts_raw <> ''").agg(F.max_by("ts", "ts_raw").alias("now"))


def resurrection(events: DataFrame, gap_days: float = 30, recent_days: float = 14, least: int = 3) -> DataFrame:
    """Targets that went silent for gap_days and came back within recent_days of the corpus's last event."""
    e = present(events).withColumn("previous_ts", F.lag("ts").over(timeline()))
    return _resurrection(aggregate(e, basic(), gaps()), corpus_now(events), gap_days, recent_days, least)


def gaps() -> dict[str, Column]:
    return {"max_gap": F.max(days(F.col("previous_ts"), F.col("ts")))}


def _resurrection(facts: DataFrame, now: DataFrame, gap_days: float = 30, recent_days: float = 14, least: int = 3) -> DataFrame:
    out = facts.crossJoin(F.broadcast(now))  # one row by construction
    out = out.where((F.col("event_count") >= least) & (F.col("max_gap") >= gap_days) & (days(F.col("last_seen"), F.col("now")) <= recent_days))
    return out.select("target_id", "target_type", "event_count", F.round("max_gap", 1).alias("gap_days"), "last_seen")


def half_life(events: DataFrame) -> DataFrame:
    """Decisions: days from their introduction to the first other event in time; thrashing if under two with three events."""
    e = present(events)
    second = first_per_key(e.select("target_id", "ts_raw", "ts", "seq"), ["target_id"], [F.coalesce("ts_raw", F.lit("")), F.col("seq")], 2).where("r = 2")
    return _half_life(aggregate(e, basic(), introductions()).join(second.select("target_id", F.col("ts").alias("second")), "target_id"))


def _half_life(facts: DataFrame) -> DataFrame:
    """second: the time of the target's second event. The first event that isn't the introduction is the first of all, or
    the second where the first is it."""
    d = facts.where("target_type = 'Decision' and event_count >= 2").withColumn("intro", F.coalesce("intro", "first"))
    d = d.select("target_id", "event_count", F.col("intro.ts").alias("introduced"), F.when(F.col("intro.seq") == F.col("first.seq"), F.col("second")).otherwise(F.col("first.ts")).alias("next"))
    life = days(F.col("introduced"), F.col("next"))
    return d.select("target_id", "event_count", "introduced", F.round(life, 2).alias("half_life_days"), ((life < 2) & (F.col("event_count") >= 3)).alias("thrashing"))


def concern_lifetime(events: DataFrame) -> DataFrame:
    """Days from a concern's first raise to its first resolve, or to the corpus's last event while it is open."""
    only = {k: v for k, v in concerns().items() if k.endswith("_at")}
    return _lifetime(aggregate(present(events), {"target_type": first_type()}, only), corpus_now(events))


def _lifetime(facts: DataFrame, now: DataFrame) -> DataFrame:
    out = facts.where("raised_at is not null").crossJoin(F.broadcast(now))  # one row by construction
    kind = F.when(F.col("resolved_at").isNull(), "still_open").otherwise("resolved")
    return out.select("target_id", "target_type", kind.alias("kind"), F.round(days(F.col("raised_at"), F.coalesce("resolved_at", "now")), 1).alias("lifetime_days"))


def provider_cognition(events: DataFrame) -> DataFrame:
    """Providers with a concern event: raised and resolved per session, and how often each kind of concern event occurs
    (breakdown, as kind:count by name)."""
    e = present(events)
    kind = F.col("mention_type")
    raised, resolved = F.count_if(kind == "concern_raised"), F.count_if(kind == "concern_resolved")
    per = e.groupBy("provider").agg(F.count_distinct("session_id").alias("sessions"), raised.alias("raised"), resolved.alias("resolved"))
    kinds = e.where(kind.startswith("concern")).groupBy("provider", "mention_type").agg(F.count("*").alias("n"))
    kinds = kinds.groupBy("provider").agg(F.sum("n").alias("concern_events"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("mention_type", "n"))), lambda k: F.concat(k["mention_type"], F.lit(":"), k["n"].cast("string"))), ",").alias("breakdown"))
    rate = lambda c: F.round(F.col(c) / F.col("sessions"), 3).alias(f"{c}_per_session")
    return per.join(kinds, "provider").select("provider", "sessions", "raised", "resolved", "concern_events", rate("raised"), rate("resolved"), "breakdown")


#: Kinds of object that count as deltas; decisions do not.
DELTAS = ["rules", "affect", "stances", "mental_moves", "drifts"]


def scale(events: DataFrame, objects: dict[str, DataFrame] | None = None) -> DataFrame:
    """One row: sessions, providers, events and targets of the log, and the deltas among the objects (by kind)."""
    deltas = None
    for kind in DELTAS:
        if objects and kind in objects:
            n = objects[kind].agg(F.count("*").alias("n"))
            deltas = n if deltas is None else deltas.unionByName(n)
    out = events.agg(F.count_distinct("session_id").alias("sessions"), F.count_distinct("provider").alias("providers"), F.count("*").alias("events"), F.count_distinct("target_id").alias("targets"))
    if deltas is None:
        return out.withColumn("total_deltas", F.lit(0).cast("long"))
    return out.crossJoin(F.broadcast(deltas.agg(F.sum("n").alias("total_deltas"))))  # one row by construction


def moves(frame: DataFrame, least: int = 2, width: int = 100, distinct_sessions: bool = False, examples: int = 5) -> DataFrame:
    """(move, owner, level) with occurrences and the sessions of the first ones: confirmed at `least`, else candidates. Long
    moves are told by their start. Examples come from a bounded number a map task, so no move's rows are sorted whole."""
    keys = ["move", "owner", "level"]
    at = F.col("seq") if "seq" in frame.columns else F.col("session_id")
    m = frame.select(F.substring("move", 1, width).alias("move"), F.coalesce("owner", F.lit("?")).alias("owner"), F.coalesce("level", F.lit("?")).alias("level"), at.alias("seq"), "session_id")
    n = F.count_distinct("session_id") if distinct_sessions else F.count("*")
    counted = m.groupBy(*keys).agg(n.alias("occurrences"))
    few = first_per_key(m, keys, [F.col("seq")], examples).groupBy(F.col("move").alias("_m"), F.col("owner").alias("_o"), F.col("level").alias("_l"))
    few = few.agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "session_id"))), lambda e: e["session_id"]).alias("_shown"))
    per = counted.join(few, counted["move"].eqNullSafe(few["_m"]) & (counted["owner"] == few["_o"]) & (counted["level"] == few["_l"]))
    return per.select(*keys, "occurrences", F.array_join("_shown", ",").alias("example_sessions"), F.when(F.col("occurrences") >= least, "confirmed").otherwise("candidate").alias("state"))


#: What the inferences read of an event.
NARROW = ["seq", "ts_raw", "ts", "session_id", "provider", "target_id", "target_type", "mention_type", "valence"]


def clustered(events: DataFrame) -> DataFrame:
    """The log's columns that inferences read, staged in the order of target and time, with the time of the event before
    (previous_ts) and whether there is one (later). A hot target lies in many ranges."""
    e = events.select(*NARROW, F.coalesce("ts_raw", F.lit("")).alias("_t"), F.lit(True).alias("_one"))
    x = with_previous(e, ["target_id"], [F.col("_t"), F.col("seq")], ["ts", "_one"])
    return x.withColumn("later", F.coalesce("previous__one", F.lit(False))).drop("previous__one", "_t", "_one")


def all_facts(log: DataFrame, last: int = 3) -> DataFrame:
    """One row a target, staged: every fact that A1 to A13 need of it, from one aggregate over a clustered log."""
    e = present(log)
    second = {"second": F.min_by("ts", F.when(F.col("later"), when_key()))}  # the first of all events but the first
    return stage(aggregate(e, basic(), concerns(), introductions(), gaps(), second).join(tails(e, last), "target_id"))


def full_profile(events: DataFrame, decisions: DataFrame | None = None, objects: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Every inference over one log; objects (by kind) add moves, drifts, rules and affect.

    The log is read for one range sort (and its sample) and staged by target; one aggregate over it makes a row of facts a
    target, staged too, and the inferences of targets are projections of that. Those of providers read the staged log."""
    from . import decisions as d

    log = clustered(events)
    facts, now = all_facts(log), stage(corpus_now(log))
    out = {
        "convergence": _convergence(facts), "concern_lifecycle": _lifecycle(facts), "cross_provider": _reach(facts), "top_entities": _frequency(facts),
        "idea_resurrection": _resurrection(facts, now), "decision_half_life": _half_life(facts), "concern_lifetime": _lifetime(facts, now), "provider_cognition": provider_cognition(log), "scale": scale(log, objects),
    }
    if decisions is not None:
        out["load_bearing"] = d.load_bearing(decisions)
    if objects:
        out |= {k: objects[k] for k in ("rules", "affect", "stances") if k in objects}
        if "mental_moves" in objects:
            out["moves"] = moves(objects["mental_moves"])
        if "drifts" in objects:
            out["drifts"] = drift_recurrence(objects["drifts"], "trigger", "trigger_detail")
    return out
