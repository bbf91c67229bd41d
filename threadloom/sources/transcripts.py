"""Transcripts of five providers and of terminals, as turns or artifacts; a registry of readers.

Files of lines are read in ranges (see lines), documents as whole files, and taken apart as VARIANT, so that one malformed
element or file drops alone. Nothing is collected; a session of lines may be of any size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import coerce_time, flatten_blocks, strip, strip_ansi, strip_fences
from .lines import PLACE, lines, running

#: Roles and message types that are tools' and not people's; longest texts.
TOOL_ROLES = ["tool", "tool_result", "function"]
TOOL_TYPES = ["tool", "command", "command_output", "api_req_started", "api_req_finished", "api_req_retried", "browser_action", "browser_action_result", "mcp_server_request_started", "mcp_server_response", "use_mcp_server"]
CLINE_TEXT, ARTIFACT_TEXT, TERMINAL_TEXT = 5_000, 15_000, 8_000

READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str) -> Callable:
    """Make a reader known under a provider's name."""

    def keep(f: Callable) -> Callable:
        READERS[name] = f
        return f

    return keep


def reader(name: str) -> Callable[[SparkSession, str], DataFrame]:
    if name not in READERS:
        raise KeyError(f"no reader {name!r}; there are {sorted(READERS)}")
    return READERS[name]


def providers() -> list[str]:
    return sorted(READERS)


def _lines(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(path, block, n, v) of each line that is JSON; files are read in ranges, block and n order the lines of a file."""
    return lines(spark, path, glob).where("trim(line) <> ''").select(*PLACE, F.try_parse_json("line").alias("v")).where("v is not null")


def _documents(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(path, v) of each file that is JSON."""
    t = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(path, wholetext=True)
    return t.select(F.col("_metadata.file_path").alias("path"), F.try_parse_json("value").alias("v")).where("v is not null")


def _get(v: str, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(F.col(v), path, kind)


def _elements(frame: DataFrame, array: Column) -> DataFrame:
    """A row an element of a variant array; elements that are no objects are dropped."""
    return frame.withColumn("_a", F.try_variant_get(array, "$", "array<variant>")).select("*", F.posexplode("_a").alias("n", "e")).drop("_a").where(F.schema_of_variant("e").startswith("OBJECT"))


def _time(value: Column, coerce: bool) -> Column:
    """A time as ISO text, or as it is written."""
    return coerce_time(value) if coerce else F.try_variant_get(value, "$", "string")


def stem(path: str = "path") -> Column:
    return F.regexp_replace(F.regexp_extract(path, r"([^/]+?)(\.[^./]+)?$", 1), "local_", "")


def clean_id(name: Column) -> Column:
    """A session's id from a file or folder name."""
    return F.regexp_replace(F.regexp_replace(name, r"\.(jsonl|json)$", ""), "^local_", "")


def _turns(frame: DataFrame, provider: str, session: Column, role: Column, ts: Column, text: Column, thinking: Column, raw_type: Column | None = None, tokens: Column | None = None, of_lines: bool = False) -> DataFrame:
    """Turns with a text or a thought, numbered anew in each file: rows of lines by their splits, rows of a document (one
    row a file before it was taken apart) by a window."""
    none = F.lit(None).cast("string")
    own = ["block"] if of_lines else []
    t = frame.select(*own, session.alias("session_id"), F.lit(provider).alias("provider"), F.col("path").alias("source_path"), "n", role.alias("role"), ts.alias("timestamp"), text.alias("text"), thinking.alias("thinking"), (raw_type if raw_type is not None else none).alias("raw_type"), (tokens if tokens is not None else none).alias("tokens"))
    t = t.where("text <> '' or thinking <> ''")
    if own:
        return running(t.withColumnRenamed("source_path", "path"), F.lit(1), "index").withColumnRenamed("path", "source_path").withColumn("index", F.col("index").cast("int")).drop("block", "n")
    index = F.row_number().over(Window.partitionBy("source_path").orderBy("n")) - 1
    return t.withColumn("index", index).drop("n")


def _chat_lines(spark: SparkSession, path: str, glob: str, provider: str, session: Column, ts: Column) -> DataFrame:
    x = _lines(spark, path, glob).withColumn("type", _get("v", "$.type")).where("type in ('user', 'assistant')")
    role = F.coalesce(_get("v", "$.message.role"), F.col("type"))
    x = x.withColumn("role", role).where(~F.col("role").isin(TOOL_ROLES)).withColumn("c", _get("v", "$.message.content", "variant"))
    text, thinking = (flatten_blocks(F.col("c"), k) for k in ("text", "thinking"))
    return _turns(x, provider, session, F.col("role"), ts, text, thinking, of_lines=True)


@register("claude_code")
def claude_code(spark: SparkSession, path: str, coerce: bool = True) -> DataFrame:
    """A JSON line a message; tool roles go."""
    return _chat_lines(spark, path, "*.jsonl", "claude_code", stem(), _time(_get("v", "$.timestamp", "variant"), coerce))


@register("claude_desktop")
def claude_desktop(spark: SparkSession, path: str, coerce: bool = True) -> DataFrame:
    """<session>/audit.jsonl; the audit's own time comes first."""
    ts = F.coalesce(_time(_get("v", "$._audit_timestamp", "variant"), coerce), _time(_get("v", "$.timestamp", "variant"), coerce))
    return _chat_lines(spark, path, "audit.jsonl", "claude_desktop", F.regexp_replace(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1), "local_", ""), ts)


@register("gemini_cli")
def gemini_cli(spark: SparkSession, path: str, coerce: bool = True) -> DataFrame:
    """A document of messages; thoughts are a text or a list of texts."""
    x = _elements(_documents(spark, path, "*.json"), _get("v", "$.messages", "variant")).withColumn("type", _get("e", "$.type")).where("type in ('user', 'gemini')")
    blocks = F.try_variant_get("e", "$.content", "array<variant>")
    listed = F.array_join(F.filter(F.transform(blocks, lambda b: F.try_variant_get(b, "$.text", "string")), lambda t: t.isNotNull() & (t != "")), "\n")
    plain = F.when(F.schema_of_variant(_get("e", "$.content", "variant")).startswith("STRING"), _get("e", "$.content"))
    thoughts = F.try_variant_get("e", "$.thoughts", "array<variant>")
    thought = F.array_join(F.transform(thoughts, lambda b: F.coalesce(F.try_variant_get(b, "$.text", "string"), b.try_cast("string"))), "\n")
    said = F.when(F.schema_of_variant(_get("e", "$.thoughts", "variant")).startswith("STRING"), _get("e", "$.thoughts"))
    text = strip_fences(strip(F.coalesce(plain, listed, F.lit(""))))
    thinking = strip_fences(strip(F.coalesce(said, thought, F.lit(""))))
    role = F.when(F.col("type") == "user", "user").otherwise("assistant")
    return _turns(x, "gemini_cli", stem(), role, _time(_get("e", "$.timestamp", "variant"), coerce), text, thinking, tokens=F.to_json(_get("e", "$.tokens", "variant")))


@register("cline")
def cline(spark: SparkSession, path: str, coerce: bool = True) -> DataFrame:
    """A list of messages in the shape of the interface (ui_messages files) or of the API."""
    d = _documents(spark, path, "*.json")
    e = _elements(d, F.col("v"))
    ui = e.where(F.regexp_extract("path", r"([^/]+)$", 1).contains("ui_messages"))
    kind = F.coalesce(*[F.nullif(_get("e", f"$.{k}"), F.lit("")) for k in ("type", "say", "ask")], F.lit("msg"))
    ui = ui.withColumn("type", kind).where(~F.col("type").isin(TOOL_TYPES))
    shown = F.coalesce(strip_fences(_get("e", "$.text")), F.lit(""))
    ui = _turns(ui, "cline", stem(), F.when(F.col("type").isin("ask", "text"), "user").otherwise("assistant"), _time(_get("e", "$.ts", "variant"), coerce), F.when(strip(shown) == "", "").otherwise(F.substring(shown, 1, CLINE_TEXT)), F.lit(""), raw_type=F.col("type"))
    api = e.where(~F.regexp_extract("path", r"([^/]+)$", 1).contains("ui_messages")).withColumn("role", F.coalesce(_get("e", "$.role"), F.lit("?"))).where(~F.col("role").isin(TOOL_ROLES))
    c = _get("e", "$.content", "variant")
    text, thinking = (flatten_blocks(c, k) for k in ("text", "thinking"))
    return ui.unionByName(_turns(api, "cline", stem(), F.col("role"), F.lit(None).cast("string"), F.substring(text, 1, CLINE_TEXT), thinking))


@register("antigravity")
def antigravity(spark: SparkSession, path: str) -> DataFrame:
    """(session_id, provider, artifacts): the Markdown files of each folder, by name, long ones cut."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", "*.md").option("recursiveFileLookup", "true").load(path)
    a = f.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("session_id"), F.struct(F.regexp_extract("path", r"([^/]+)$", 1).alias("filename"), F.substring(F.col("content").cast("string"), 1, ARTIFACT_TEXT).alias("content"), F.col("length").alias("size")).alias("a"))
    return a.groupBy("session_id").agg(F.array_sort(F.collect_list("a")).alias("artifacts")).select("session_id", F.lit("antigravity").alias("provider"), "artifacts")


@register("structured")
def structured(spark: SparkSession, path: str, coerce: bool = True) -> DataFrame:
    """<session>.json that holds turns already."""
    x = _elements(_documents(spark, path, "*.json"), _get("v", "$.turns", "variant"))
    return _turns(x, "structured", F.coalesce(_get("v", "$.session_id"), stem()), F.coalesce(_get("e", "$.role"), F.lit("?")), _time(_get("e", "$.timestamp", "variant"), coerce), F.coalesce(_get("e", "$.text"), F.lit("")), F.coalesce(_get("e", "$.thinking"), F.lit("")))


@register("terminal")
def terminal(spark: SparkSession, path: str) -> DataFrame:
    """A raw terminal log: control sequences out, blocks between blank lines are turns, prompts mark the user's."""
    t = spark.read.option("pathGlobFilter", "*.log").option("recursiveFileLookup", "true").text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.regexp_replace(strip_ansi(F.col("value")), "\r", "").alias("value"))
    x = t.select("path", F.posexplode(F.split("value", r"\n\s*\n")).alias("n", "block")).withColumn("block", strip(F.col("block")))
    user = F.col("block").rlike(r"^(>|❯|\$|User:|Human:)\s?")
    text = F.substring(F.regexp_replace("block", r"^(>|❯|\$|User:|Human:|Assistant:|⏺)\s?", ""), 1, TERMINAL_TEXT)
    return _turns(x, "terminal", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1), F.when(user, "user").otherwise("assistant"), F.lit(None).cast("string"), text, F.lit(""))


def load_session(spark: SparkSession, jsonl: str | None = None, session_json: str | None = None, session_dir: str | None = None) -> DataFrame:
    """The turns of one session from the best input there is: its lines of JSON, a document of turns, or in its folder
    session.json before raw.log. ValueError if nothing is given or the folder has neither."""
    from pyspark.errors import AnalysisException

    if jsonl:
        return claude_code(spark, jsonl)
    if session_json:
        return structured(spark, session_json)
    if not session_dir:
        raise ValueError("one of jsonl, session_json and session_dir is needed")
    for read, name in ((structured, "session.json"), (terminal, "raw.log")):
        try:
            return read(spark, f"{session_dir.rstrip('/')}/{name}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
    raise ValueError(f"no session.json or raw.log under {session_dir}")


def normalised(turns: DataFrame) -> DataFrame:
    """(session_id, provider, source_path, input_type, turns): a row a session, its turns in order."""
    t = F.struct("index", "role", "timestamp", "text", "thinking", "raw_type")
    return turns.groupBy("session_id", "provider", "source_path").agg(F.array_sort(F.collect_list(t)).alias("turns")).withColumn("input_type", F.lit("dialog"))


def to_json(sessions: DataFrame) -> DataFrame:
    """(session_id, json): turns or artifacts, whichever a session has; nulls left out."""
    return sessions.select("session_id", F.to_json(F.struct(*sessions.columns)).alias("json"))


def unprocessed(sessions: DataFrame, done: DataFrame, key: str = "session_id") -> DataFrame:
    """Sessions without an extraction yet."""
    return sessions.join(done.select(key).distinct(), key, "left_anti")
