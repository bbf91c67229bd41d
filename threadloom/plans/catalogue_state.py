"""Registered queries: brain state, pages and their index, names of sessions' objects, project slices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import slugs
from ..operators import brain_state, profile, vault
from . import views
from .catalogue import CO, D_SQL, M_SQL, R_SQL, on_events, query
from .views import NOW

MARKERS = {"frustrated": "frustration", "negative": "concern"}
TRIGGERS = {"frustrated": "self_catch", "negative": "tool_failure"}


def rich_profile(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """A profile with every kind of object, made of the driver tables: concern events stand for affect and drifts."""
    e = views.mention_events(spark, sf_dir)
    d = views.decisions(spark, sf_dir)
    named = lambda table: F.coalesce(F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[F.col("valence")], F.col("valence"))
    c = e.where("mention_type like 'concern%'")
    r = views.rules(spark, sf_dir)
    moves = r.withColumnsRenamed({"rule_text": "move", "provider": "owner"}).withColumn("session_id", (F.col("seq") % 50).cast("string"))
    objects = {"rules": r, "affect": c.select(named(MARKERS).alias("marker"), "valence"), "stances": d, "mental_moves": moves, "drifts": c.select("seq", named(TRIGGERS).alias("trigger"), F.col("target_id").alias("trigger_detail"))}
    return profile.full_profile(e, d, objects)


REGION_ROWS = ", ".join(f"('{k}', '{v}')" for k, v in brain_state.REGION_OF.items())
STATE = f"""with {M_SQL.strip()}, {D_SQL.strip()}, {R_SQL.strip()},
rm(kind, region) as (values {REGION_ROWS}),
top as (select target_id, min_by(target_type, seq) as kind, count(*) as n from m group by 1 order by n desc, min(seq) limit 30),
cl as (select target_id, count(*) filter (mention_type = 'concern_resolved') as resolved from m group by 1 having count(*) filter (mention_type = 'concern_raised') > 0),
lb as (select entity from d group by 1 having count(distinct session_id) >= 3),
cf as (select 1 as x from r group by substring(rule_text, 1, 100), coalesce(provider, '?'), coalesce(level, '?') having count(*) >= 2),
ev as (select coalesce(region, 'sensory') as region, top.kind, n::bigint as n from top left join rm on rm.kind = top.kind
  union all select 'prefrontal', 'Decisions', (select count(*) from lb) union all select 'anterior_cingulate', 'Concern', (select count(*) from cl)
  union all select 'amygdala', 'Affect', (select count(*) from m where mention_type like 'concern%' and valence = 'frustrated')
  union all select 'anterior_cingulate', 'Concern', (select count(*) from m where mention_type like 'concern%' and valence = 'negative')
  union all select 'sensory', 'MentalMove', (select count(*) from cf) union all select 'anterior_cingulate', 'Rule', (select count(*) from r) union all select 'prefrontal', 'Decisions', (select count(*) from d0)),
al(region) as (values {", ".join(f"('{x}')" for x in brain_state.REGIONS)}),
rg as (select region, round(case when t > 0 then least(1.0::double, ln(1 + t) / ln(1 + greatest((select count(distinct session_id) from m) * 0.5::double, 1))) else 0.05::double end, 3)::double as density, round((w - c) / greatest(w + c, 1)::double, 3)::double as color_temp
  from (select region, coalesce(sum(n), 0)::double as t, coalesce(sum(n) filter (kind in ('Concern', 'Affect')), 0)::double as w, coalesce(sum(n) filter (kind in ('Plans', 'ToolCall')), 0)::double as c from al left join ev using (region) group by 1))"""


@query("brain_state_regions", STATE + "\nselect * from rg")
def brain_state_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brain_state.regions(rich_profile(spark, sf_dir))


@query("brain_state_fibers", STATE + f""",
f(from_region, to_region) as (values {", ".join(f"('{a}', '{b}')" for a, b in brain_state.FIBERS)})
select from_region, to_region, round(sqrt(a.density * b.density), 3) as weight, sqrt(a.density * b.density) > 0.15 as active from f join rg a on a.region = from_region join rg b on b.region = to_region""")
def brain_state_fibers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brain_state.fibers(brain_state.regions(rich_profile(spark, sf_dir)))


@query("brain_state_hypotheses", STATE + """,
k as (select (select count(distinct session_id) from m) as s, (select count(*) from (select 1 from m group by target_id having min_by(target_type, seq) = 'Decision' and count(*) >= 2)) as dc, (select count(*) from cl) as c, (select count(*) from cl where resolved = 0) as l,
  (select count(*) from top where kind = 'Project') as p, (select coalesce(sum(n), 0)::bigint from top where kind in ('Tool', 'ToolCall')) as t, (select count(*) from (select 1 from m group by target_id having count(distinct provider) >= 2)) as x,
  (select count(*) from (select provider from m group by 1 having count(*) filter (mention_type like 'concern%') > 0)) as pr, (select count(*) from r) as ru, (select count(*) from cf) as mv,
  (select count(*) from m where mention_type like 'concern%' and valence = 'frustrated') as sc, (select count(*) from m where mention_type like 'concern%' and valence = 'negative') as tf)
select 'rehearsal_vs_commitment' as id, 'collab' as grp, 'prefrontal=0.000' as firing, 'committed' as verdict, 'revised=0' as evidence, dc > 3 as sufficient_data from k
union all select 'concern_debt', 'collab', 'anterior_cingulate=' || printf('%.3f', least(1, c / 10.0::double)), case when c > 5 then 'in debt' when c > 0 then 'manageable' else 'none' end, 'concerns=' || c, c > 2 from k
union all select 'affect_before_abandonment', 'collab', 'amygdala=0.000', 'none', 'abandoned=0', s > 10 from k
union all select 'drift_by_session_time', 'cogload', 'prefrontal=' || printf('%.3f', least(1, sc / greatest(tf, 1)::double / 3)) || ',motor=' || printf('%.3f', least(1, sc / 50.0::double)), case when sc / greatest(tf, 1)::double > 1.2 then 'self-catch prevails' else 'balanced' end, 'self_catch=' || sc || ',tool_failure=' || tf, s > 5 from k
union all select 'concurrent_project_pressure', 'cogload', 'prefrontal=' || printf('%.3f', least(1, p / 5.0::double)), case when p > 3 then 'pressure' else 'healthy' end, 'projects=' || p, p > 0 from k
union all select 'tool_storm', 'cogload', 'brainstem=' || printf('%.3f', least(1, t / 100.0::double)), case when t > 50 then 'storm' else 'normal' end, 'tools=' || t, s > 3 from k
union all select 'cross_pollination_vs_bleed', 'cross', 'corpus_callosum=' || printf('%.3f', least(1, x / 20.0::double)), case when x > 5 then 'to be checked' else 'low' end, 'shared=' || x, x > 0 from k
union all select 'provider_specific_cognition', 'cross', 'sensory=' || printf('%.3f', least(1, pr / 5.0::double)), case when pr > 1 then 'several providers' else 'one provider' end, 'providers=' || pr, pr > 0 from k
union all select 'rule_firing_under_pressure', 'toolfit', 'prefrontal=' || printf('%.3f', least(1, (ru + mv) / 50.0::double)) || ',anterior_cingulate=' || printf('%.3f', least(1, (ru + mv) / 50.0::double) * 0.7::double), case when ru + mv > 5 then 'tracked' else 'too few' end, 'rules=' || ru || ',moves=' || mv, ru + mv > 3 from k
union all select 'silent_failure', 'toolfit', 'prefrontal=' || printf('%.3f', least(1, l / 5.0::double)), case when l > 0 then 'possible' else 'none' end, 'latent=' || l, dc > 2 from k""")
def brain_state_hypotheses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brain_state.hypotheses(rich_profile(spark, sf_dir))


on_events("brain_state_timeline", brain_state.timeline, f""",
rm(kind, region) as (values {REGION_ROWS}),
f as (select session_id, min(ts) as a from m group by 1 order by a desc, session_id desc limit 50),
x as (select f.session_id, f.a, coalesce(region, 'sensory') as region, min(struct_pack(t := ts, s := seq)) as met from m join f using (session_id) left join rm on rm.kind = m.target_type group by 1, 2, 3)
select session_id, strftime(a, '%Y-%m-%dT%H:%M:%S.%f') as ts_raw, string_agg(region, ',' order by met) as fired from x group by 1, 2""")

PAGES = CO + """,
e as (select *, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as raw from m),
tv as (select target_id, valence from (select target_id, valence, row_number() over (partition by target_id order by count(*) desc, min(ts), min(seq)) as rn from m group by 1, 2) where rn = 1),
tt as (select target_id, target_type from (select target_id, target_type, row_number() over (partition by target_id order by count(*) desc, min(ts), min(seq)) as rn from m group by 1, 2) where rn = 1),
cm as (select src as target_id, string_agg(dst, ', ' order by r) as near from (select *, row_number() over (partition by src order by weight desc, dst) as r from co) where r <= 6 group by 1),
lg as (select target_id, string_agg('- ' || raw[:10] || ' — [[session_' || session_id || ']] — ' || mention_type || ' (' || authorship || ')', chr(10) order by ts, seq) as log, count(*) as n, min(raw) as a, max(raw) as b, max(ts) as last, string_agg(distinct provider, ', ' order by provider) as provs from e group by 1),
cc as (select target_id, string_agg('- [[session_' || session_id || ']] — **' || mention_type || '** — ', chr(10) order by ts, seq) as c from (select *, row_number() over (partition by target_id order by ts, seq) as r from e where mention_type like 'concern%') where r <= 20 group by 1),
s as (select *, case when epoch_us(timestamp '2024-03-01') - epoch_us(last) <= 30 * 86400000000 then 'active' when epoch_us(timestamp '2024-03-01') - epoch_us(last) <= 180 * 86400000000 then 'dormant' else 'archived' end as status from lg)
select target_id, target_id as name, '---' || chr(10) || 'target_id: ' || target_id || chr(10) || 'target_type: ' || target_type || chr(10) || 'aliases: []' || chr(10) || 'first_seen: "' || a || '"' || chr(10) || 'last_seen: "' || b || '"' || chr(10)
  || 'mention_count: ' || n || chr(10) || 'providers: [' || provs || ']' || chr(10) || 'co_mentioned_top: [' || coalesce(near, '') || ']' || chr(10) || 'status: ' || status || chr(10) || '---' || chr(10) || chr(10) || '# ' || target_id || chr(10)
  || '## Summary' || chr(10) || 'Dominant valence: **' || valence || '**. Seen across providers: ' || provs || '. Status: **' || status || '** (last seen ' || b || ').' || chr(10) || chr(10)
  || case when c is not null then '## Concerns' || chr(10) || c || chr(10) || chr(10) else '' end || '## Mention log' || chr(10) || log || chr(10) || chr(10) as page
from s join tv using (target_id) join tt using (target_id) left join cm using (target_id) left join cc using (target_id)"""
on_events("vault_pages", lambda e: vault.pages(e, F.lit(NOW).cast("timestamp")), PAGES)

on_events("vault_index", lambda e: vault.index_page(vault.file_names(e)), """,
t as (select distinct target_id from m)
select 'INDEX' as name, '# Vault index' || chr(10) || '_' || count(*) || ' entities_' || chr(10) || chr(10) || string_agg('- [[' || target_id || ']] — `' || target_id || '`' || chr(10), '' order by lower(target_id), target_id) as page from t""")


@query("yaml_scalars", """select page_id, case when url is null then 'null' when regexp_matches(url, '[:#\\[\\]{}&*!|>''"%@`\\n]') then to_json(url)::varchar else url end as scalar from pages""")
def yaml_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "pages").select("page_id", vault.yaml_scalar(F.col("url")).alias("scalar"))


@query("session_objects", f"""with {D_SQL.strip()},
a(alias, canonical) as (values ('brand#11', 'house'), ('brand#12', 'house')),
x as (select seq, entity, coalesce(canonical, entity) as name from d left join a on alias = entity),
l as (select seq, string_agg(name, ',' order by entity) as related from x group by 1)
select seq, 'p-x' || session_id as target_id, 'P x' || session_id || ' Core v2' as mentioned_as, coalesce(related, '') as related from d0 left join l using (seq)""")
def session_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions with a name of their own as written, and brands of which two are aliases of one."""
    aliases = spark.createDataFrame([("brand#11", "house"), ("brand#12", "house")], "alias string, canonical string")
    d = views.decisions(spark, sf_dir).withColumn("target_id", F.concat(F.lit("P x"), "session_id", F.lit(" Core v2"))).withColumn("mentioned_as", F.lit(None).cast("string"))
    return slugs.canonical_objects(d, aliases).select("seq", "target_id", "mentioned_as", F.array_join("related_entities", ",").alias("related"))
