"""URL filters: host-suffix and path-prefix expressions, equi-joined with the rules on short hash prefixes.

The form follows public safe-browsing lookups: each URL is expanded into the expressions a rule could be written as,
a digest prefix of each is equi-joined with the rules' prefixes, and only then are full digests compared and precedence
decided. Rules of any number fit: Catalyst broadcasts them if their statistics allow, else it shuffles both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, free

#: Fixed values: (verdict, host, path) of the contract's rules.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
RULE_SCHEMA = "verdict string, host string, path string"


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", prefix_digits: int = 8) -> DataFrame:
    """pages with host, path, rule (host + path of the rule that decides, else null) and verdict added.

    A rule fits its host and all subdomains where the url's path starts with the rule's. The longest rule wins, of equal
    ones that with the longer host, then block before allow. No rule: `default`. A null url or one without "://" has an
    empty host and path and no rule. Repeated rows keep their number; columns of the same names are replaced, others may have any name.
    Empty rules or pages give no rule or no row. Only expressions that some rule's shape allows are made (its number of
    labels, its path length), so very long hosts and paths stay linear."""
    rules = rules.where("host is not null and path is not null and verdict is not null").select("verdict", ascii_lower(F.col("host")).alias("host"), "path").distinct()
    shape = rules.agg(F.max(F.size(F.split("host", r"\."))).alias("labels"), F.collect_set(F.length("path")).alias("lengths")).first()
    labels, lengths = shape["labels"] or 1, sorted(shape["lengths"] or [])
    digest = F.sha2(F.col("expression"), 256)
    r = rules.withColumn("expression", F.concat("host", "path")).select(
        "verdict", F.concat("host", "path").alias("rule"), F.length("host").alias("host_length"), digest.alias("rule_digest"), F.substring(digest, 1, prefix_digits).alias("prefix")
    )
    urls = pages.select(F.col(url).alias("_url")).where(F.col("_url").isNotNull()).distinct().select("_url", host_of(F.col("_url")).alias("h"), path_of(F.col("_url")).alias("p"))
    parts = F.split("h", r"\.")
    first = F.greatest(F.lit(1), F.size(parts) - F.lit(labels - 1))
    urls = urls.withColumn("hosts", F.transform(F.sequence(first, F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), ".")))
    paths = F.transform(F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("p")), lambda n: F.col("p").substr(F.lit(1), n))
    asked = urls.select("_url", F.explode("hosts").alias("eh"), paths.alias("paths")).select("_url", "eh", F.explode("paths").alias("ep")).select("_url", F.concat("eh", "ep").alias("expression"))
    asked = asked.select("_url", digest.alias("digest"), F.substring(digest, 1, prefix_digits).alias("prefix"))
    found = asked.join(r, "prefix").where(F.col("digest") == F.col("rule_digest"))
    rank = F.struct(F.length("rule"), "host_length", (F.col("verdict") == "block").cast("int"))
    own = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    key, decided = free(pages, "_url", "_best")
    best = found.groupBy(F.col("_url").alias(key)).agg(F.max_by(F.struct("rule", "verdict"), rank).alias(decided))
    out = pages.where(F.col(url).isNotNull()).join(best, F.col(url) == F.col(key), "left")
    nothing = F.lit(None).cast("struct<rule: string, verdict: string>").alias(decided)
    out = out.select(*pages.columns, decided).unionByName(pages.where(F.col(url).isNull()).select(*pages.columns, nothing))  # null urls meet no rule, and no other row
    return out.select(*own, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), F.col(decided)["rule"].alias("rule"), F.coalesce(F.col(decided)["verdict"], F.lit(default)).alias("verdict"))


def contract_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, RULE_SCHEMA)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return filter_urls(pages, contract_rules(spark)).select("page_id", "host", "path", "rule", "verdict")


OP7_SQL = """
with rules(verdict, rhost, rpath) as (values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
p as (select row_number() over () as rid, page_id,
        translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
      from pages),
m as (select p.rid, rhost || rpath as rule, verdict,
        row_number() over (partition by p.rid order by length(rhost || rpath) desc, length(rhost) desc, verdict desc) as rn
      from p join rules on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath))
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict
from p left join (select * from m where rn = 1) using (rid)
"""
