"""More registered queries: vault, log, text, profile and stream operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import slugs, text
from ..operators import brain, dedup, event_log, profile, sanitize, vault
from ..operators import decisions as dec
from ..streaming import incremental
from . import views
from .catalogue import CO, D_SQL, M_SQL, R_SQL, on_events, query
from .views import NOW

on_events("vault_entities", lambda e: vault.entities(e, F.lit(NOW).cast("timestamp")), CO + """,
tv as (select target_id, valence from (select target_id, valence, row_number() over (partition by target_id order by count(*) desc, min(ts)) as rn from m group by 1, 2) where rn = 1),
tt as (select target_id, target_type from (select target_id, target_type, row_number() over (partition by target_id order by count(*) desc, min(ts)) as rn from m group by 1, 2) where rn = 1),
cm as (select src as target_id, string_agg(dst, ',' order by r) as co_mentioned from (select *, row_number() over (partition by src order by weight desc, dst) as r from co) where r <= 6 group by 1)
select p.*, target_type, valence, coalesce(co_mentioned, '') as co_mentioned,
  case when date_diff('day', last_seen, timestamp '2024-03-01') <= 30 and epoch_us(timestamp '2024-03-01') - epoch_us(last_seen) <= 30 * 86400000000 then 'active' when epoch_us(timestamp '2024-03-01') - epoch_us(last_seen) <= 180 * 86400000000 then 'dormant' else 'archived' end as status
from (select target_id, min(ts) as first_seen, max(ts) as last_seen, count(*) as mention_count, string_agg(distinct provider, ',' order by provider) as providers, '' as aliases from m group by 1) p
  join tv using (target_id) join tt using (target_id) left join cm using (target_id)""")

on_events("events_by_month", event_log.by_month, """
select strftime(ts, '%Y-%m') as ym, count(*) as events, count(distinct session_id) as sessions, count(distinct target_id) as targets from m group by 1""")

on_events("event_index", lambda e: event_log.index(e).select("target_id", F.array_join(F.transform("refs", lambda r: F.concat(r["file"], F.lit(":"), r["line"].cast("string"))), ",").alias("refs")), """,
l as (select *, row_number() over (partition by strftime(ts, '%Y-%m') order by ts, session_id, seq) - 1 as line from m)
select target_id, string_agg(strftime(ts, '%Y-%m') || '.jsonl:' || line, ',' order by ts, line) as refs from l group by 1""")

on_events("event_log_meta", event_log.meta, """
select count(distinct session_id) as sessions_read, count(*) as events_total, count(distinct target_id) as distinct_targets, count(distinct strftime(ts, '%Y-%m')) as months, max_by(session_id, ts) as last_session from m""")

on_events("commit_history", lambda e: event_log.commits(e).select("session_id", "date", F.array_join("files", ",").alias("files")), """
select session_id, strftime(min(ts), '%Y-%m-%d') as date, string_agg(distinct target_id, ',' order by target_id) as files from m group by 1""")

on_events("diversity_sample", lambda e: vault.diverse(e, 5).select("target_id", "seq", "place"), """,
g as (select *, row_number() over (partition by target_id, provider, valence order by ts, seq) as turn, min(ts) over (partition by target_id, provider, valence) as first from m),
h as (select *, row_number() over (partition by target_id order by turn, first, seq) as place from g)
select target_id, seq, place from h where place <= 5""")


@query("vault_decisions", f"""with {M_SQL.strip()}, {D_SQL.strip()},
e as (select seq, 'brand#' || (seq % 25 + 11) as target_id, (seq % 1500)::varchar as session_id from m),
x as (select e.target_id, e.session_id, min(e.seq) as a0 from e group by 1, 2),
j as (select x.target_id, x.session_id, d.proposition as line, min(x.a0) as a0, min(d.seq) as ds from x join d on x.session_id = d.session_id and x.target_id = d.entity group by 1, 2, 3)
select target_id, session_id, line, place from (select *, row_number() over (partition by target_id order by a0, ds, session_id, line) as place from j) where place <= 15""")
def vault_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions of brands in customers' sessions against the decisions of the same session that relate to them."""
    e = views.mention_events(spark, sf_dir).select("seq", F.lit("").alias("ts_raw"), F.concat(F.lit("brand#"), (F.col("seq") % 25 + 11).cast("string")).alias("target_id"), (F.col("seq") % 1500).cast("string").alias("session_id"))
    return vault.decisions_of(e, views.decisions(spark, sf_dir, e))


@query("vault_rules", f"""with {R_SQL.strip()},
e as (select distinct role as target_id, conv_id::varchar as session_id, min(turn) as a0 from conversations group by 1, 2),
x as (select seq, (seq % 200)::varchar as session_id, level || ' user of ' || provider as rule_text, case when seq % 3 = 0 then 'system' else '' end as applies_to from r),
j as (select target_id, session_id, rule_text as line, min(a0) as a0, min(seq) as ds from e join x using (session_id) where contains(applies_to, target_id) or contains(rule_text, target_id) group by 1, 2, 3)
select target_id, session_id, line, place from (select *, row_number() over (partition by target_id order by a0, ds, session_id, line) as place from j) where place <= 15""")
def vault_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = views.turns(spark, sf_dir).select(F.col("index").alias("seq"), F.lit("").alias("ts_raw"), F.col("role").alias("target_id"), "session_id")
    r = views.rules(spark, sf_dir).select("seq", (F.col("seq") % 200).cast("string").alias("session_id"), F.concat("level", F.lit(" user of "), "provider").alias("rule_text"), F.when(F.col("seq") % 3 == 0, "system").otherwise("").alias("applies_to"))
    return vault.rules_of(t, r)


ENDINGS = "(-bridge|-core|-mcp|-service|-svc|-daemon|-server)$"


#: Names lose a version, then a filler, again and again until nothing goes.
STEP = f"regexp_replace(regexp_replace(a, '[-_ ]v?[0-9]+([._-][0-9]+)*$', ''), '^(.{{2,}}){ENDINGS}', '\\1')"
MANY = "".join(f"-core-v{i}" for i in range(6)) + "-svc-server" * 5


@query("slug_canonical", f"""with recursive s as (select distinct p_name || case p_partkey % 5 when 0 then ' MCP v2' when 1 then '-core-server' when 2 then ' the Bridge' when 3 then '-v1.2.3' else '{MANY}' end as name from part),
w as (select name, regexp_replace(lower(trim(name)), '\\s+', '-', 'g') as a, 0 as i from s union all select name, {STEP}, i + 1 from w where {STEP} <> a),
n as (select name, arg_max(a, i) as a from w group by name)
select name, regexp_replace(regexp_replace(regexp_replace(a, '(^|[-_ ])the([-_ ]|$)', '\\1\\2', 'g'), '[-_]{{2,}}', '-', 'g'), '^[-_]+|[-_]+$', '', 'g') as canonical from n""")
def slug_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 5
    tail = F.when(k == 0, " MCP v2").when(k == 1, "-core-server").when(k == 2, " the Bridge").when(k == 3, "-v1.2.3").otherwise(MANY)
    names = views.table(spark, sf_dir, "part").select(F.concat("p_name", tail).alias("name")).distinct()
    return slugs.canonical(names, "name")


@query("slug_aliases", f"""with {M_SQL.strip()}
select seq, case when target_id in ('k1-u1', 'k2-u2') then 'joined' else target_id end as target_id, case when target_id in ('k1-u1', 'k2-u2') then target_id end as mentioned_as from m""")
def slug_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names whose canonical form is themselves, two of them aliases of one."""
    aliases = spark.createDataFrame([("k1-u1", "joined"), ("k2-u2", "joined")], "alias string, canonical string")
    return slugs.canonical_events(views.mention_events(spark, sf_dir), aliases).select("seq", "target_id", "mentioned_as")


@query("strip_fences", f"""select conv_id::varchar as session_id, turn::int as index, case when turn % 2 = 0 then text else trim(text || chr(10) || chr(9), '{text.BLANKS}') end as kept from conversations""")
def strip_fences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns to half of which a fenced block was added."""
    t = views.turns(spark, sf_dir)
    fenced = F.when(F.col("index") % 2 == 0, F.col("text")).otherwise(F.concat("text", F.lit("\n```sql\nselect 1\nfrom t\n```\t")))
    return t.select("session_id", "index", text.strip_fences(fenced).alias("kept"))


@query("approx_tokens", "select doc_id, greatest(1, length(text) // 4)::int as tokens from documents")
def approx_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "documents").select("doc_id", text.approx_tokens(F.col("text")).alias("tokens"))


@query("escape_xml", "select page_id, replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;') as escaped from pages")
def escape_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "pages").select("page_id", text.escape(F.col("html")).alias("escaped"))


@query("rule_bucket_counts", f"with {R_SQL.strip()} select bucket, count(*) as rules from r group by 1")
def rule_bucket_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.rules(spark, sf_dir).groupBy("bucket").agg(F.count("*").alias("rules"))


@query("rule_scopes", f"with {R_SQL.strip()} select level as scope, count(*) as rules from r where bucket = 'project_domain' group by 1")
def rule_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.rules(spark, sf_dir).where("bucket = 'project_domain'").groupBy(F.col("level").alias("scope")).agg(F.count("*").alias("rules"))


@query("verdict_filter", """select doc_id from documents left join labels using (doc_id)
where lower(coalesce(nullif(case when toxic = 1 then 'Unsupported' when quality = 1 then 'SUPPORTED' when quality = 0 then '' end, ''), 'supported')) = 'supported'""")
def verdict_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.extract import keep_supported

    d = views.table(spark, sf_dir, "documents").select("doc_id").join(views.table(spark, sf_dir, "labels"), "doc_id", "left")
    v = F.when(F.col("toxic") == 1, "Unsupported").when(F.col("quality") == 1, "SUPPORTED").when(F.col("quality") == 0, "")
    return keep_supported(d.withColumn("verdict", v)).select("doc_id")


@query("slug_merge_dedup", f"""with {M_SQL.strip()},
p as (select target_id, count(*) as event_count, min(seq) as seq, list(distinct provider) as providers, min_by(target_type, seq) as target_type from m group by 1),
x as (select regexp_replace(target_id, '-u[0-9]$', '') as name, event_count, seq, target_type, unnest(providers) as p from p)
select name, (select sum(event_count)::bigint from p where regexp_replace(target_id, '-u[0-9]$', '') = x.name) as event_count, string_agg(distinct p, ',' order by p) as providers, min_by(target_type, seq) as target_type, (select count(*) from p where regexp_replace(target_id, '-u[0-9]$', '') = x.name) as merged
from x group by name""")
def slug_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = views.mention_events(spark, sf_dir)
    per = e.groupBy("target_id").agg(F.count("*").alias("event_count"), F.min("seq").alias("seq"), F.collect_set("provider").alias("providers"), F.min_by("target_type", "seq").alias("target_type"))
    out = dedup.merge_by_name(per, F.regexp_replace("target_id", "-u[0-9]$", ""), ["event_count"], ["providers"], ["target_type"])
    return out.select("name", "event_count", F.array_join("providers", ",").alias("providers"), "target_type", "merged")


@query("move_merge")
def move_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confirmed moves by their whole texts, near copies merged."""
    whole = views.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq"), F.col("text").alias("move"), F.col("lang").alias("owner"), F.col("source").alias("level"))
    confirmed = whole.groupBy("move", "owner", "level").agg(F.count("*").alias("occurrences"), F.min("seq").alias("seq")).where("occurrences >= 2")
    return dedup.merge_moves(confirmed, order=["seq"])


@query("move_keys", """select doc_id, trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g')) as key from documents""")
def move_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "documents").select("doc_id", text.move_key(F.col("text")).alias("key"))


@query("common_prefixes", """with p as (select p_partkey, p_name as a, lag(p_name) over (order by p_name, p_partkey) as b from part)
select p_partkey, (select coalesce(max(i), 0) from range(1, 1 + least(length(a), length(b))) r(i) where left(a, i) = left(b, i))::int as shared from p where b is not null""")
def common_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part's name with the one before it in order."""
    from pyspark.sql import Window

    p = views.table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("a"), F.lag("p_name").over(Window.orderBy("p_name", "p_partkey")).alias("b")).where("b is not null")
    return p.select("p_partkey", text.common_prefix(F.col("a"), F.col("b")).alias("shared"))


def _profile(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    e = views.mention_events(spark, sf_dir)
    p = profile.full_profile(e, views.decisions(spark, sf_dir))
    p["idea_resurrection"] = profile.resurrection(e, gap_days=7)
    p["affect"] = e.where("mention_type like 'concern%'").select("valence")
    p["drifts"] = profile.drift_recurrence(e.where("mention_type like 'concern%'"), "valence", "target_id")
    r = views.rules(spark, sf_dir)
    p["rules"] = r
    p["moves"] = profile.moves(r.withColumnsRenamed({"rule_text": "move", "provider": "owner"}).withColumn("session_id", (F.col("seq") % 50).cast("string")))
    return p


COUNTED = f"""with {M_SQL.strip()}, {D_SQL.strip()}, {R_SQL.strip()},
g as (select *, (epoch_us(ts) - epoch_us(lag(ts) over (partition by target_id order by ts, seq))) / 8.64e10::double as gap from m),
ir as (select target_id from g group by 1 having count(*) >= 3 and max(gap) >= 7 and abs(epoch_us((select max(ts) from m)) - epoch_us(max(ts))) / 8.64e10::double <= 14),
cl as (select target_id, count(*) filter (mention_type = 'concern_raised') as raised, count(*) filter (mention_type = 'concern_resolved') as resolved from m group by 1 having count(*) filter (mention_type = 'concern_raised') > 0),
lb as (select entity, count(distinct session_id) as sessions from d group by 1),
cp as (select target_id, count(distinct provider) as n from m group by 1 having count(distinct provider) >= 2),
mv as (select count(*) as n from r group by substring(rule_text, 1, 100), provider, level),
tp as (select target_id, count(*) as n from m group by 1 order by n desc, min(seq) limit 30)"""


@query("sanitize_aggregated", COUNTED + """
select (select count(*) from mv where n >= 2) as confirmed_moves, (select count(*) from r) as rules, (select count(*) from cl where resolved = 0) as latent_concerns, (select count(*) from lb where sessions >= 3) as load_bearing_decisions,
  (select count(*) from cp) as cross_provider_entities, (select count(*) from ir) as resurrected_ideas, (select count(*) from (select valence from m where mention_type like 'concern%' group by 1 having count(*) >= 2)) as recurring_drifts""")
def sanitize_aggregated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitize.sanitise(_profile(spark, sf_dir), "aggregated")["counts"]


@query("sanitize_named")
def sanitize_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitize.sanitise(_profile(spark, sf_dir), "named_stripped")["top_entities"]


REGIONS = COUNTED + """,
af as (select case when valence in ('positive', 'confident') then 1 when valence in ('frustrated', 'negative') then -1 else 0 end as v from m where mention_type like 'concern%'),
rc as (select * from (values ('prefrontal', (select sum(sessions)::bigint from lb)), ('motor', (select count(*) // 3 from tp)), ('sensory', (select sum(n)::bigint from (select n from tp order by n desc, target_id limit 10))),
  ('anterior_cingulate', (select sum(raised + resolved)::bigint from cl)), ('hippocampus', (select 3 * (select count(*) from ir) + (select count(*) from r))), ('amygdala', (select count(*) from af)),
  ('brainstem', (select count(distinct valence) from m where mention_type like 'concern%')), ('corpus_callosum', (select sum(n)::bigint from cp))) t(region, count)),
rg as (select region, count, round(count / greatest(max(count) over (), 1)::double, 3) as density, round(case when region = 'amygdala' then (select greatest(-1.0::double, least(1.0::double, avg(v))) from af) else 0.0::double end, 3) as color_temp,
  case when region in ('motor', 'brainstem') then 'ai' when region in ('hippocampus', 'amygdala') then 'founder' else 'shared' end as attribution from rc)"""


@query("brain_regions", REGIONS + "\nselect * from rg")
def brain_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brain.regions(_profile(spark, sf_dir))


FIBER_ROWS = ", ".join(f"('{a}', '{b}', '{k}', '{s}')" for a, b, k, s in brain.FIBERS)


@query("fibers", REGIONS + f""",
f(from_region, to_region, kind, backing) as (values {FIBER_ROWS}),
w as (select f.*, case when backing = 'real' then round(sqrt(a.density * b.density), 3) else 0.2::double end as weight from f join rg a on a.region = from_region join rg b on b.region = to_region)
select from_region, to_region, kind, weight, backing = 'real' and weight > 0.4 as active, backing from w""")
def fibers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brain.fibers(spark, brain.regions(_profile(spark, sf_dir)))


@query("hypotheses")
def hypotheses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brain.hypotheses(_profile(spark, sf_dir))


on_events("timeline", brain.timeline, """,
e as (select max(ts)::date as e from m),
s as (select unnest(generate_series(e - interval 29 day, e::timestamp, interval 1 day))::date as day from e),
p as (select ts::date as day, count(*) as events, count(distinct session_id) as sessions from m group by 1)
select day, coalesce(events, 0) as events, coalesce(sessions, 0) as sessions from s left join p using (day)""")

on_events("tumbling", incremental.tumbling, """
select date_trunc('day', ts) as start, count(*) as events, count(distinct target_id) as targets from m group by 1""")

on_events("sliding", incremental.sliding, """
select start, provider, count(*) as events from (select unnest([date_trunc('day', ts), date_trunc('day', ts) - interval 1 day]) as start, provider from m) group by 1, 2""".replace("date_trunc('day', ts) as start", "date_trunc('day', ts) as start"))

on_events("session_windows", lambda e: incremental.sessions(e, "7 days"), """,
g as (select *, case when ts - lag(ts) over (partition by target_id order by ts) < interval 7 day then 0 else 1 end as new from m),
s as (select *, sum(new) over (partition by target_id order by ts rows unbounded preceding) as run from g)
select target_id, min(ts) as start, count(*) as events from s group by target_id, run""")


@query("cube_mentions", f"with {M_SQL.strip()} select provider, target_type, mention_type, count(*) as events from m group by cube (provider, target_type, mention_type)")
def cube_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.mention_events(spark, sf_dir).cube("provider", "target_type", "mention_type").agg(F.count("*").alias("events"))


@query("incremental_equals_full", f"with {M_SQL.strip()} select target_id, min_by(target_type, seq) as target_type, count(*) as event_count, string_agg(distinct provider, ',' order by provider) as providers from m group by 1 order by event_count desc, min(seq) limit 30")
def incremental_equals_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top entities over a state appended in two halves, the second run twice."""
    import uuid

    from ..staging import scratch

    e = views.mention_events(spark, sf_dir)
    half = F.pmod(F.xxhash64("session_id"), F.lit(2))
    first, second = e.where(half == 0), e.where(half == 1)
    return incremental.incremental(spark, [first, second, second], f"{scratch(spark)}/state-{uuid.uuid4().hex}", profile.entity_frequency)


@query("sampled_turns", """select conv_id::varchar as session_id, count(*) as turns, sum(length(text))::bigint as chars from conversations group by 1""")
def sampled_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.sample_turns(views.turns(spark, sf_dir)).groupBy("session_id").agg(F.count("*").alias("turns"), F.sum(F.length("text")).alias("chars"))


LONG_TURNS = """t as (select 's' || (conv_id % 3) as session_id, row_number() over (partition by conv_id % 3 order by conv_id, turn) as index,
        repeat(text, case conv_id % 3 when 0 then 1 when 1 then 12 else 40 end) as text from conversations where length(text) > 0)"""


@query("sampled_long_sessions", f"""with {LONG_TURNS},
n as (select *, length(text) as len, row_number() over (partition by session_id order by index) - 1 as i, count(*) over (partition by session_id) as n from t),
e as (select *, greatest(1, n // 10) as side from n),
f as (select *, i < side as head, n > side and i >= n - side as tail, i - side as j, greatest(2, (n - 2 * side) // 4 + 1) as most from e),
s as (select session_id, sum(len) + 2 * (count(*) - 1) as whole, 240000 - 200 - (sum(len) filter (head) + 2 * (count(*) filter (head) - 1)) - (coalesce(sum(len) filter (tail), 0) + 2 * greatest(0, count(*) filter (tail) - 1)) as room, any_value(most) as most from f group by 1),
d as (select session_id, room, unnest(range(1, most + 1)) as d from s where whole > 240000 and room > 0),
fit as (select d.session_id, d.d from d join f on d.session_id = f.session_id and not head and not tail and j % d.d = 0 group by d.session_id, d.d, room having sum(len) + 2 * (count(*) - 1) <= room),
g as (select session_id, min(d) as stride from fit group by 1)
select session_id, index, len as chars, case when whole <= 240000 then 1 else stride end::int as stride from f join s using (session_id) left join g using (session_id)
where whole <= 240000 or head or tail or j % stride = 0""")
def sampled_long_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations strung together into three sessions, two of them far over the budget; each is many tasks' work."""
    from ..operators.ordering import numbered_within

    t = views.table(spark, sf_dir, "conversations").where(F.length("text") > 0)
    t = t.select("conv_id", "turn", F.concat(F.lit("s"), (F.col("conv_id") % 3).cast("string")).alias("session_id"), F.length(F.expr("repeat(text, case conv_id % 3 when 0 then 1 when 1 then 12 else 40 end)")).alias("chars"))
    t = numbered_within(t, ["session_id"], [F.col("conv_id"), F.col("turn")], "index").select("session_id", F.col("index").cast("int").alias("index"), "chars")
    return text.sample_turns(t, size=F.col("chars")).select("session_id", "index", "chars", "stride")


@query("open_per_provider", f"with {D_SQL.strip()} select provider, count(*) filter (status = 'proposed') as open, count(*) as decisions from d0 group by 1")
def open_per_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = views.decisions(spark, sf_dir)
    return d.groupBy("provider").agg(F.count_if(F.col("status").isin(dec.OPEN)).alias("open"), F.count("*").alias("decisions"))
