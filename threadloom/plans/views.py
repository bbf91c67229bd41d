"""The driver tables seen as the engine's model: mention events, decisions, turns and rules (FIXTURES.md, part B)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import stage

#: The day that pages and ages are told from.
NOW = "2024-03-01"
#: Kinds of target by k % 7, mention types by event type.
TARGET_TYPES = ["Project", "Tool", "Technology", "Concept", "Artifact", "Error", "Decision"]
MENTION_TYPES = {"signup": "first_introduction", "view": "reference", "click": "revisit", "error": "concern_raised", "purchase": "concern_resolved"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mention_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View M: one mention event a row of events. No shuffle; each column is a projection of the scan."""
    ts = F.col("ts").cast("timestamp")
    k = F.get_json_object("props", "$.k").cast("int")
    value = F.col("value")
    valence = F.when(value < 10, "frustrated").when(value < 20, "negative").when(value < 40, "neutral").when(value < 70, "confident").otherwise("positive")
    kinds = F.array(*[F.lit(x) for x in TARGET_TYPES])
    mention = F.col("event_type")
    for old, new in MENTION_TYPES.items():
        mention = F.when(F.col("event_type") == old, new).otherwise(mention)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"), ts.alias("ts"), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts_raw"),
        F.concat(F.col("user_id").cast("string"), F.lit("-"), F.date_format(ts, "yyyyMMdd")).alias("session_id"),
        F.concat(F.lit("p"), ((F.col("user_id") + F.dayofmonth(ts)) % 5).cast("string")).alias("provider"),
        F.concat(F.lit("k"), k.cast("string"), F.lit("-u"), (F.col("user_id") % 10).cast("string")).alias("target_id"),
        F.element_at(kinds, k % 7 + 1).alias("target_type"), mention.alias("mention_type"), valence.alias("valence"),
        F.when(F.col("event_id") % 2 == 0, "writer").otherwise("reader").alias("authorship"),
    )


M_SQL = """
m as (select event_id as seq, ts, user_id || '-' || strftime(ts, '%Y%m%d') as session_id, 'p' || ((user_id + day(ts)) % 5) as provider,
        'k' || (props->>'$.k') || '-u' || (user_id % 10) as target_id,
        ['Project', 'Tool', 'Technology', 'Concept', 'Artifact', 'Error', 'Decision'][((props->>'$.k')::int % 7 + 1)] as target_type,
        case event_type when 'signup' then 'first_introduction' when 'view' then 'reference' when 'click' then 'revisit' when 'error' then 'concern_raised' when 'purchase' then 'concern_resolved' else event_type end as mention_type,
        case when value < 10 then 'frustrated' when value < 20 then 'negative' when value < 40 then 'neutral' when value < 70 then 'confident' else 'positive' end as valence,
        case when event_id % 2 = 0 then 'writer' else 'reader' end as authorship
      from events)
"""


def decisions(spark: SparkSession, sf_dir: str, sessions: DataFrame | None = None) -> DataFrame:
    """View D: one decision an order; related_entities are the distinct lower-case brands of its lines. Where sessions
    (session_id) are given, the decisions of those alone, whose lines are told apart before their brands are gathered."""
    o, li, p = (table(spark, sf_dir, t) for t in ("orders", "lineitem", "part"))
    if sessions is not None:
        o = o.join(sessions.select("session_id").distinct(), F.col("o_custkey").cast("string") == F.col("session_id"), "left_semi")
        li = li.join(o.select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    brands = li.select("l_orderkey", "l_partkey").join(p.select("p_partkey", F.lower("p_brand").alias("brand")), F.col("l_partkey") == F.col("p_partkey"))
    brands = brands.groupBy("l_orderkey").agg(F.array_sort(F.collect_set("brand")).alias("related_entities"))
    status = F.when(F.col("o_orderstatus") == "P", "proposed").when(F.col("o_orderstatus") == "O", "locked").when(F.col("o_orderstatus") == "F", "reverted").otherwise(F.col("o_orderstatus"))
    return o.join(brands, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").alias("seq"), F.col("o_orderkey").alias("decision_id"), F.col("o_custkey").cast("string").alias("session_id"), F.col("o_orderpriority").alias("provider"),
        F.col("o_orderdate").cast("timestamp").alias("ts"), F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts_raw"), status.alias("status"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("proposition"), F.coalesce("related_entities", F.array().cast("array<string>")).alias("related_entities"),
    )


D_SQL = """
d0 as (select o_orderkey as seq, o_custkey::varchar as session_id, o_orderpriority as provider, o_orderdate as ts,
         case o_orderstatus when 'P' then 'proposed' when 'O' then 'locked' when 'F' then 'reverted' else o_orderstatus end as status, 'order ' || o_orderkey as proposition from orders),
de as (select distinct l_orderkey as seq, lower(p_brand) as entity from lineitem join part on l_partkey = p_partkey),
d as (select d0.*, de.entity from d0 join de using (seq))
"""


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View T: one turn a row of conversations."""
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("session_id"), F.col("turn").cast("int").alias("index"), "role", "text")


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules over documents and their labels, with the bucket each falls in; unlabelled ones fall in project_domain. Texts are whole; what
    needs a key of them cuts it."""
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "l_doc_id")
    q, t = F.col("quality"), F.col("toxic")
    bucket = F.when((q == 1) & (t == 0), "meta_user").when((q == 1) & (t == 1), "meta_assistant").when((q == 0) & (t == 1), "debugging_recipe").otherwise("project_domain")
    return d.join(lab, F.col("doc_id") == F.col("l_doc_id"), "left").select(F.col("doc_id").alias("seq"), F.col("text").alias("rule_text"), F.col("lang").alias("provider"), F.col("source").alias("level"), bucket.alias("bucket"))


def rule_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as rules without a bucket, and each one's place: its file and its row there."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("seq"), F.col("text").alias("rule_text"), F.col("lang").alias("provider"), F.col("source").alias("level"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"))


def rules_in_place(spark: SparkSession, sf_dir: str, domain: bool = False) -> DataFrame:
    """The rows of rules() without the bucket; `domain`: of bucket project_domain alone. Texts are not shuffled: labels meet
    keys and places alone, and texts meet a bit a document (which are left out) and the few places that labels repeat."""
    r = rule_texts(spark, sf_dir)
    other = (F.col("quality").isin(0, 1) & F.col("toxic").isin(0, 1) & ~((F.col("quality") == 0) & (F.col("toxic") == 0))) if domain else F.lit(False)
    n = table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("seq")).agg(F.count(F.when(other, None).otherwise(1)).alias("_n")).where("_n <> 1")
    odd = stage(r.select("seq", "_file", "_at").join(n, "seq").select("_file", "_at", "_n"))
    many = stage(odd.where("_n > 1"))
    place = F.col("_at") + 1
    bit = F.bitmap_bit_position(place)
    gone = stage(odd.where("_n = 0").groupBy("_file", F.bitmap_bucket_number(place).alias("_block")).agg(F.bitmap_construct_agg(bit).alias("_bits")))
    byte = F.conv(F.hex(F.substring("_bits", (bit / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    left = r.withColumn("_block", F.bitmap_bucket_number(place)).join(F.broadcast(gone), ["_file", "_block"], "left")  # a bit a document
    left = left.where(F.coalesce(F.getbit(byte, (bit % 8).cast("int")), F.lit(0)) == 0).join(many, ["_file", "_at"], "left")
    return left.select("seq", "rule_text", "provider", "level", F.explode(F.array_repeat(F.lit(0), F.coalesce("_n", F.lit(1)).cast("int")))).drop("col")


R_SQL = """
r as (select d.doc_id as seq, text as rule_text, lang as provider, source as level,
        case when quality = 1 and toxic = 0 then 'meta_user' when quality = 1 and toxic = 1 then 'meta_assistant' when quality = 0 and toxic = 1 then 'debugging_recipe' else 'project_domain' end as bucket
      from documents d left join labels l on d.doc_id = l.doc_id)
"""
