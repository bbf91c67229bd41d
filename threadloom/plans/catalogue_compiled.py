"""Registered queries of compiled artifacts, a line a row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalogue import D_SQL, M_SQL, R_SQL, query
from .catalogue_state import rich_profile
from .compilers import SCHEMA, Profile, compile_profile


def _compiled(spark: SparkSession, sf_dir: str, name: str, tokens: int) -> DataFrame:
    """The artifact's text, within a budget that nothing has to go for."""
    p = Profile(rich_profile(spark, sf_dir), "src1")
    return spark.createDataFrame([(compile_profile(p, name, tokens),)], "artifact string").select(F.explode(F.split("artifact", "\n")).alias("line"))


def esc(x: str) -> str:
    return f"replace(replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"


#: Rules of a bucket in their first order, equal texts once; confirmed moves; recurring drifts.
BASE = f"""with {M_SQL.strip()}, {D_SQL.strip()}, {R_SQL.strip()},
ru as (select bucket, trim(rule_text, ' ') as t, min(seq) as seq, min_by(level, seq) as level from r where trim(rule_text, ' ') <> '' group by 1, 2),
mv as (select substring(rule_text, 1, 100) as move, coalesce(provider, '?') as owner, coalesce(level, '?') as level, count(*) as n from r group by 1, 2, 3 having count(*) >= 2),
dr as (select case valence when 'frustrated' then 'self_catch' when 'negative' then 'tool_failure' else valence end as trigger, count(*) as n from m where mention_type like 'concern%' group by 1 having count(*) >= 2),
cl as (select target_id, count(*) filter (mention_type = 'concern_raised') as raised, count(*) filter (mention_type = 'concern_resolved') as resolved from m group by 1 having count(*) filter (mention_type = 'concern_raised') > 0),
x as ("""
MOVES = f"""select unnest(string_split('<mm l="' || {esc('level')} || '" o="' || {esc('owner')} || '">' || {esc('move')} || '</mm>', chr(10))) as line from (select * from mv where move <> '' order by n desc, move limit NUMBER)"""
DRIFTS = f"""select '<drift t="' || {esc('trigger')} || '">count=' || n || '</drift>' as line from (select * from dr order by n desc, trigger limit NUMBER)"""


def rules_sql(tag: str, bucket: str, n: int) -> str:
    return f"select unnest(string_split('<{tag}>' || {esc('t')} || '</{tag}>', chr(10))) as line from (select * from ru where bucket = '{bucket}' order by seq limit {n})"


@query("compiled_global", BASE + f"""select '<global-brain v="{SCHEMA}">' as line union all {MOVES.replace('NUMBER', '15')} union all {rules_sql('obs', 'meta_user', 12)} union all {DRIFTS.replace('NUMBER', '8')} union all select '</global-brain>')
select line from x""")
def compiled_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compiled(spark, sf_dir, "light_ir_global", 10_000_000)


@query("compiled_personal", BASE + f"""select '<personal-brain v="{SCHEMA}">' as line union all {rules_sql('collab', 'meta_assistant', 20)} union all select '</personal-brain>')
select line from x""")
def compiled_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """None of the tables' concerns is of the general kinds."""
    return _compiled(spark, sf_dir, "light_ir_personal", 10_000_000)


@query("compiled_rules_file", BASE + """select '# Moves, rules and open concerns distilled from many sessions.' as line union all select '' union all select '## Mental moves to honor' union all select unnest(string_split('- ' || trim(move, ' '), chr(10))) from (select * from mv where move <> '' order by n desc, move limit 8)
  union all select '' union all select '## Standing rules' union all select unnest(string_split('- ' || t, chr(10))) from (select t, min(seq) as seq from ru group by 1 order by 2 limit 8) union all select ''
  union all select unnest(['## Open concerns (do not silently introduce regressions here)', '']) where exists (select 1 from cl where resolved = 0) union all select '- `' || target_id || '`' from (select * from cl where resolved = 0 order by raised desc, target_id limit 6))
select line from x""")
def compiled_rules_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compiled(spark, sf_dir, "cursor_rules", 10_000_000)
