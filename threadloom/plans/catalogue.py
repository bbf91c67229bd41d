"""Registered queries over the driver tables and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import decisions, graph, profile, reliability
from . import views
from .views import D_SQL, M_SQL, R_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register a query under a name, with its SQL where there is one."""

    def keep(f: Callable) -> Callable:
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return keep


def on_events(name: str, op: Callable[[DataFrame], DataFrame], sql: str | None = None) -> None:
    query(name, None if sql is None else f"with {M_SQL.strip()}{sql}")(lambda spark, sf_dir: op(views.mention_events(spark, sf_dir)))


def on_decisions(name: str, op: Callable[[DataFrame], DataFrame], sql: str | None = None) -> None:
    query(name, None if sql is None else f"with {D_SQL.strip()}{sql}")(lambda spark, sf_dir: op(views.decisions(spark, sf_dir)))


on_events("p1_convergence", profile.convergence, """,
t as (select *, row_number() over (partition by target_id order by ts desc, seq desc) as rn from m),
l as (select target_id, any_value(n) as n, bool_or(valence in ('positive', 'confident') or mention_type = 'concern_resolved') as good, bool_or(valence in ('frustrated', 'negative')) as bad,
        string_agg(valence, ',' order by ts, seq) as last_valences
      from (select *, count(*) over (partition by target_id) as n from t) where rn <= 3 group by target_id),
p as (select target_id, min_by(target_type, seq) as target_type, count(*) as event_count, string_agg(distinct provider, ',' order by provider) as providers, min(ts) as first_seen, max(ts) as last_seen from m group by target_id)
select p.target_id, target_type, event_count, providers, first_seen, last_seen, last_valences,
  case when good then 'settled' when bad then 'possibly_abandoned_or_stuck' else 'ambiguous' end as status
from p join l using (target_id) where event_count >= 3""")

on_events("p5_concern_lifecycle", profile.concern_lifecycle, """
select target_id, count(*) filter (mention_type = 'concern_raised') as raised, count(*) filter (mention_type = 'concern_resolved') as resolved,
  coalesce(string_agg(session_id, ',' order by seq) filter (mention_type = 'concern_raised'), '') as raised_in,
  coalesce(string_agg(session_id, ',' order by seq) filter (mention_type = 'concern_resolved'), '') as resolved_in,
  case when count(*) filter (mention_type = 'concern_resolved') > 0 then 'resolved' else 'latent_unresolved' end as status
from m group by target_id having count(*) filter (mention_type = 'concern_raised') > 0""")

on_events("p6_cross_provider", profile.cross_provider, """
select target_id, count(distinct provider) as provider_count, string_agg(distinct provider, ',' order by provider) as providers, count(*) as event_count
from m group by target_id having count(distinct provider) >= 2""")

on_events("entity_top30", profile.entity_frequency, """
select target_id, min_by(target_type, seq) as target_type, count(*) as event_count, string_agg(distinct provider, ',' order by provider) as providers from m group by target_id order by event_count desc, min(seq) limit 30""")

on_events("corpus_now", profile.corpus_now, """
select max(ts) as now from m""")

on_events("idea_resurrection", lambda e: profile.resurrection(e, gap_days=7), """,
g as (select *, (epoch_us(ts) - epoch_us(lag(ts) over (partition by target_id order by ts, seq))) / 8.64e10::double as gap from m)
select target_id, min_by(target_type, seq) as target_type, count(*) as event_count, round(max(gap), 1) as gap_days, max(ts) as last_seen
from g group by target_id
having count(*) >= 3 and max(gap) >= 7 and abs(epoch_us((select max(ts) from m)) - epoch_us(max(ts))) / 8.64e10::double <= 14""")

on_events("decision_half_life", profile.half_life, """,
o as (select *, row_number() over (partition by target_id order by (mention_type in ('first_introduction', 'decision_made')) desc, ts, seq) as ri,
        count(*) over (partition by target_id) as n, first_value(target_type) over (partition by target_id order by seq) as tt from m),
h as (select target_id, any_value(n) as event_count, max(ts) filter (ri = 1) as introduced, min(ts) filter (ri > 1) as next
      from o where tt = 'Decision' and n >= 2 group by target_id)
select target_id, event_count, introduced, round(abs(epoch_us(next) - epoch_us(introduced)) / 8.64e10::double, 2) as half_life_days,
  abs(epoch_us(next) - epoch_us(introduced)) / 8.64e10::double < 2 and event_count >= 3 as thrashing from h""")

on_events("concern_lifetime", profile.concern_lifetime, """,
c as (select target_id, min_by(target_type, seq) as target_type, min(ts) filter (mention_type = 'concern_raised') as a, min(ts) filter (mention_type = 'concern_resolved') as b from m group by target_id)
select target_id, target_type, case when b is null then 'still_open' else 'resolved' end as kind,
  round(abs(epoch_us(coalesce(b, (select max(ts) from m))) - epoch_us(a)) / 8.64e10::double, 1) as lifetime_days
from c where a is not null""")

on_events("provider_cognition", profile.provider_cognition, """,
k as (select provider, string_agg(mention_type || ':' || n, ',' order by mention_type) as breakdown from (select provider, mention_type, count(*) as n from m where mention_type like 'concern%' group by 1, 2) group by 1)
select provider, any_value(breakdown) as breakdown, count(distinct session_id) as sessions, count(*) filter (mention_type = 'concern_raised') as raised, count(*) filter (mention_type = 'concern_resolved') as resolved,
  count(*) filter (mention_type like 'concern%') as concern_events,
  round(count(*) filter (mention_type = 'concern_raised') / count(distinct session_id)::double, 3) as raised_per_session,
  round(count(*) filter (mention_type = 'concern_resolved') / count(distinct session_id)::double, 3) as resolved_per_session
from m join k using (provider) group by provider having count(*) filter (mention_type like 'concern%') > 0""")


@query("scale", f"""with {M_SQL.strip()}, {R_SQL.strip()}
select count(distinct session_id) as sessions, count(distinct provider) as providers, count(*) as events, count(distinct target_id) as targets,
  (select count(*) from r) + (select count(*) from m where mention_type like 'concern%') as total_deltas from m""")
def scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = views.mention_events(spark, sf_dir)
    return profile.scale(e, {"rules": views.rules(spark, sf_dir), "affect": e.where("mention_type like 'concern%'"), "decisions": views.decisions(spark, sf_dir)})


on_events("drift_recurrence", lambda e: profile.drift_recurrence(e.where("mention_type like 'concern%'"), "valence", "target_id"), """,
c as (select *, row_number() over (partition by valence order by seq) as r from m where mention_type like 'concern%')
select valence, count(*) as count, string_agg(target_id, '|' order by seq) filter (r <= 3) as examples from c group by valence""")


@query("moves_confirmed", f"""with {R_SQL.strip()},
x as (select *, row_number() over (partition by substring(rule_text, 1, 100), provider, level order by seq) as n from r)
select substring(rule_text, 1, 100) as move, coalesce(provider, '?') as owner, coalesce(level, '?') as level, count(*) as occurrences, string_agg((seq % 50)::varchar, ',' order by seq) filter (n <= 5) as example_sessions, case when count(*) >= 2 then 'confirmed' else 'candidate' end as state
from x group by substring(rule_text, 1, 100), provider, level""")
def moves_confirmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = views.rules(spark, sf_dir).withColumnsRenamed({"rule_text": "move", "provider": "owner"})
    return profile.moves(r.withColumn("session_id", (F.col("seq") % 50).cast("string")))


on_decisions("p3_load_bearing", decisions.load_bearing, """,
x as (select *, row_number() over (partition by entity order by seq) as r from d)
select entity, count(distinct session_id) as sessions, count(*) as anchors, string_agg(distinct provider, ',' order by provider) as providers,
  string_agg(proposition, '|' order by seq) filter (r <= 3) as sample_propositions, count(distinct session_id) >= 3 as load_bearing
from x group by entity""")

on_decisions("open_decisions", lambda d: decisions.open_items(d).select("decision_id", "session_id", "provider", "status", "proposition"), """
select seq as decision_id, session_id, provider, status, proposition from d0 where status = 'proposed' order by ts desc, seq desc limit 30""")

on_decisions("decision_history", lambda d: decisions.history(d, "Brand#12").select("decision_id", "session_id", "provider", "status", "proposition"), """
select seq as decision_id, session_id, provider, status, proposition from d where entity = 'brand#12' order by ts desc, seq desc limit 50""")

on_decisions("supersession", decisions.supersession, """,
x as (select *, lag(status) over (partition by entity order by ts, seq) as before from d)
select entity, count(*) as links, count(*) filter (status = 'reverted') as reversed, count(*) filter (status = 'reverted' and before = 'locked') as flips
from x group by entity having count(*) >= 2 and count(*) filter (status = 'reverted') > 0""")

COUNTS = ["mentions", "concerns", "decisions"]
PER = """,
s as (select provider, session_id, count(*) as turns, count(*) as mentions, count(*) filter (mention_type like 'concern%') as concerns, count(*) filter (target_type = 'Decision') as decisions from m group by 1, 2),
per as (select provider, count(*) as sessions, round(avg(turns), 1) as avg_turns, """ + ", ".join(f"median({c})::double as {c}_median, round(avg({c}), 2) as {c}_mean, sum({c})::bigint as {c}_total" for c in COUNTS) + """ from s group by provider)"""

on_events("reliability_provider", lambda e: reliability.per_provider(reliability.session_counts(e), COUNTS), PER + "\nselect * from per")

on_events("reliability_skew", lambda e: reliability.skew(reliability.per_provider(reliability.session_counts(e), COUNTS), "concerns_mean"), PER + """,
md as (select median(concerns_mean) as mid from per)
select provider, round(concerns_mean, 2) as value, round(coalesce(concerns_mean / nullif(mid, 0), 0), 2) as ratio,
  case when concerns_mean / mid >= 2 then 'over-extracting (noise risk)' when concerns_mean / mid <= 0.5 and concerns_mean > 0 then 'under-extracting (sparse)' else 'in-range' end as verdict
from per, md""")

ST = """,
st0 as (select session_id, target_id, valence, count(*) as c, min(seq) as f from m group by 1, 2, 3),
sv as (select session_id, target_id, valence from (select *, row_number() over (partition by session_id, target_id order by c desc, f) as rn from st0) where rn = 1),
sd as (select session_id, min(ts)::date as date from m group by 1),
st as (select session_id, target_id, provider, n, valence, concern, date
       from (select session_id, target_id, provider, count(*) as n, bool_or(mention_type = 'concern_raised') as concern from m group by 1, 2, 3) join sv using (session_id, target_id) join sd using (session_id))"""
CO = """,
sz as (select session_id from m group by 1 having count(distinct target_id) >= 2),
ss as (select distinct session_id, target_id from m join sz using (session_id)),
half as (select a.target_id as a, b.target_id as b, count(*) as weight from ss a join ss b on a.session_id = b.session_id and a.target_id < b.target_id group by 1, 2),
co as (select a as src, b as dst, weight from half union all select b, a, weight from half)"""
#: Only the co-change graph leaves out sessions of over 60 targets.
ST0 = CO.replace("count(distinct target_id) >= 2", "count(distinct target_id) between 2 and 60")
EDGES = ST0 + """,
mw as (select case when count(distinct session_id) < 1000 then 2 else 3 end as mw from m),
edges as (select * from (select co.*, row_number() over (partition by src order by weight desc, dst) as rank from co, mw where weight >= mw) where rank <= 30)"""

on_events("graph_sessions", graph.session_targets, ST + "\nselect * from st")
on_events("co_mentions", graph.co_mentions, CO + "\nselect * from co")


def long_sessions(events: DataFrame) -> DataFrame:
    """The events as a few sessions of a hundred targets and more each."""
    return events.withColumn("session_id", F.concat(F.lit("s"), (F.col("seq") % 3).cast("string"), F.substring("target_id", -1, 1)))


LONG = M_SQL.strip().replace("user_id || '-' || strftime(ts, '%Y%m%d') as session_id", "'s' || (event_id % 3) || (user_id % 10) as session_id")


@query("co_mentions_long_sessions", f"with {LONG}{CO} select * from co")
def co_mentions_long_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions far beyond the co-change limit, dealt out in pairs of small blocks."""
    return graph.co_mentions(long_sessions(views.mention_events(spark, sf_dir)), block=16)


@query("cochange_long_sessions", f"with {LONG}{EDGES} select src, dst, weight, rank from edges union all select 'skipped', null, (select count(*) from (select session_id from m group by 1 having count(distinct target_id) > 60)), null")
def cochange_long_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sessions make no co-change edges and are counted as skipped."""
    e = long_sessions(views.mention_events(spark, sf_dir))
    skipped = graph.cochange_meta(e).select(F.lit("skipped").alias("src"), F.lit(None).cast("string").alias("dst"), F.col("skipped_mega_sessions").alias("weight"), F.lit(None).cast("int").alias("rank"))
    return graph.cochange(e).select("src", "dst", "weight", "rank").unionByName(skipped)

on_events("cochange_edges", graph.cochange, EDGES + "\nselect src, dst, weight, rank from edges")
on_events("cochange_small_sessions", lambda e: graph.cochange(e, min_weight=1, most_targets=3, top=5), ST0.replace("between 2 and 60", "between 2 and 3") + """
select * from (select co.*, row_number() over (partition by src order by weight desc, dst) as rank from co) where rank <= 5""")
on_events("cochange_meta", lambda e: graph.cochange_meta(e, 6), """,
x as (select session_id, count(distinct target_id) as t from m group by 1)
select count(*) as total_sessions, count(*) filter (t > 6) as skipped_mega_sessions from x""")

SIGNALS = ["blast_radius", "event_volume", "recency", "valence_intensity", "concern_weight"]
CRIT = EDGES + ST + """,
br as (select src as target_id, count(*)::double as blast_radius from edges group by 1),
pt as (select target_id, sum(n)::double as event_volume, max(date_diff('day', date '1970-01-01', date))::double as recency,
         avg((valence in ('frustrated', 'confident', 'negative', 'positive', 'urgent'))::int::double) as valence_intensity, avg(concern::int::double) as concern_weight from st group by 1),
x as (select * from pt full outer join br using (target_id)),
z as (select target_id, """ + ", ".join(f"round(case when {c} is null then 0.0 when max({c}) over () = min({c}) over () then 0.5 else ({c} - min({c}) over ()) / (max({c}) over () - min({c}) over ()) end, 4)::double as {c}" for c in SIGNALS) + """ from x),
crit as (select *, floor((round(blast_radius * 10000)::bigint * 30 + round(event_volume * 10000)::bigint * 20 + round(recency * 10000)::bigint * 15 + round(valence_intensity * 10000)::bigint * 15 + round(concern_weight * 10000)::bigint * 20 + 50) / 100.0::double) / 10000.0::double as score,
  coalesce((select string_agg(name, ',' order by v desc, i) from (select * from (values (blast_radius, 0, 'blast_radius'), (event_volume, 1, 'event_volume'), (recency, 2, 'recency'), (valence_intensity, 3, 'valence_intensity'), (concern_weight, 4, 'concern_weight')) t(v, i, name) where v > 0.5 order by v desc, i limit 4)), '') as reasons
  from z)"""

on_events("criticality", lambda e: graph.criticality(e, graph.cochange(e)), CRIT + "\nselect * from crit")
on_events("criticality_top10", lambda e: graph.ranked(graph.criticality(e, graph.cochange(e)), 10).select("rank", "target_id", "score"), CRIT + """
select row_number() over (order by score desc, target_id) as rank, target_id, score from crit order by score desc, target_id limit 10""")
on_events("components", lambda e: graph.components(graph.cochange(e)), EDGES.replace(",\nsz as", ",\nsz as", 1) + """,
reach as (select * from (with recursive w(node, other) as (select src, src from edges union select w.node, edges.dst from w join edges on w.other = edges.src) select node, min(other) as component from w group by node))
select node, component from reach""")
on_events("ripple", lambda e: _ripple(e), CRIT + """
select src as target_id, string_agg(dst || ':' || weight, ',' order by rank) as neighbours, any_value(score) as score from edges left join crit on src = target_id group by src""")


def _ripple(events: DataFrame) -> DataFrame:
    edges = graph.cochange(events)
    near = F.array_join(F.transform("neighbours", lambda n: F.concat(n["target"], F.lit(":"), n["weight"].cast("string"))), ",")
    return graph.ripple(edges, graph.criticality(events, edges)).select("target_id", near.alias("neighbours"), "score")


@query("communities_louvain")
def communities_louvain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.louvain(graph.cochange(views.mention_events(spark, sf_dir)))


@query("modularity_of_parity", EDGES.replace(",\nsz as", "with M,\nsz as", 1).replace("with M", f"with {M_SQL.strip()}") + """,
c as (select src, dst, weight, src[2:]::varchar <> '' as x, ascii(right(src, 1)) % 2 as cs, ascii(right(dst, 1)) % 2 as cd from edges),
t as (select sum(2 * weight)::double as total, sum(case when cs = cd then 2 * weight else 0 end)::double as inside from c),
g as (select k, sum(w)::double as d from (select cs as k, weight as w from c union all select cd, weight from c) group by k)
select (select inside / total from t) - (select sum(d * d) from g) / (select total * total from t) as modularity""")
def modularity_of_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Modularity of a given partition: targets by the parity of their name's last character."""
    edges = graph.cochange(views.mention_events(spark, sf_dir))
    nodes = edges.select(F.col("src").alias("node")).unionByName(edges.select(F.col("dst").alias("node"))).distinct()
    return graph.modularity(edges, nodes.withColumn("community", F.ascii(F.substring("node", -1, 1)) % 2))


@query("communities_modularity")
def communities_modularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = graph.cochange(views.mention_events(spark, sf_dir))
    return graph.modularity(edges, graph.louvain(edges))


from . import catalogue_compiled, catalogue_files, catalogue_more, catalogue_scale, catalogue_state  # noqa: E402,F401  register the rest
