"""Text expressions: fences, content blocks, times, escapes, token budgets, lenient JSON, briefs and samples.

All are column expressions, but for shrinking code blocks and repairing JSON, which call back into Python by Arrow batch.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

FENCE = r"(?s)```[^\n]*\n.*?```"
#: Terminal control sequences, and what a scrubbed turn loses.
ANSI = r"\x1B(?:\[[0-?]*[ -/]*[@-~]|\][^\x07]*\x07|[@-Z\\-_])"
TOOL_RESULT = r"\[tool_result:[^\]]*+\][^\n]*+\n?"
#: Fixed value: white space as Python's strip takes it.
BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends (trim takes spaces alone)."""
    return F.btrim(text, F.lit(BLANKS))


def strip_fences(text: Column) -> Column:
    """Fenced code taken out and the rest stripped; texts without fences stay as they are."""
    return F.when(text.contains("```"), strip(F.regexp_replace(text, FENCE, ""))).otherwise(text)


@F.pandas_udf(StringType())
def shrink_code(text: pd.Series, most_lines: pd.Series) -> pd.Series:
    """Fenced code of over most_lines lines keeps half of them, at its start and its end, around a note of what went."""

    def one(t: str | None, most: int) -> str | None:
        def cut(m: re.Match) -> str:
            lines, half = m.group(2).splitlines(), most // 2
            if len(lines) <= most:
                return m.group(0)
            last = lines[-(most - half) :]
            return "\n".join([f"```{m.group(1).strip()}", "\n".join(lines[:half]), f"\u2026 [{len(lines) - most} lines elided] \u2026", *last, "```"])

        return None if t is None else re.sub(r"```([^\n]*)\n(.*?)```", cut, t, flags=re.S)

    return pd.Series([one(t, n) for t, n in zip(text, most_lines, strict=True)])


def flatten_blocks(content: Column, kind: str = "text", code: bool = False) -> Column:
    """Of a variant that is a string or a list of content blocks: the text (or thinking) of its blocks, a line each, each
    without fenced code unless `code`. A thought may lie in its block's text. What is no block is left out."""
    bare = (lambda t: t) if code else strip_fences
    shape = F.schema_of_variant(content)
    blocks = F.try_variant_get(content, "$", "array<variant>")
    own = F.filter(blocks, lambda b: F.schema_of_variant(b).startswith("OBJECT") & (F.try_variant_get(b, "$.type", "string") == kind))
    texts = F.transform(own, lambda b: bare(F.coalesce(*[F.try_variant_get(b, f"$.{k}", "string") for k in dict.fromkeys([kind, "text"])])))
    joined = strip(F.array_join(F.filter(texts, lambda t: t.isNotNull() & (t != "")), "\n"))
    whole = bare(F.try_variant_get(content, "$", "string")) if kind == "text" else F.lit("")
    return F.when(shape.startswith("ARRAY"), joined).otherwise(F.coalesce(F.when(shape.startswith("STRING"), whole), F.lit("")))


def coerce_time(value: Column) -> Column:
    """A variant time as a string: numbers are epoch milliseconds over 10**12, else seconds; strings stay."""
    number = F.when(F.schema_of_variant(value).rlike("^(BIGINT|DOUBLE|DECIMAL|FLOAT|INT|TINYINT|SMALLINT)"), F.try_variant_get(value, "$", "double"))
    at = F.when(number > 1e12, F.timestamp_millis(number.cast("long"))).otherwise(F.timestamp_seconds(number))
    return F.when(number.isNotNull(), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(F.try_variant_get(value, "$", "string"))


def parse_time(raw: Column) -> Column:
    """ISO time or null; a bare year or month is none."""
    return F.when(raw.rlike(r"^\d{4}-\d{2}-\d{2}"), raw.try_cast("timestamp"))


def month(raw: Column) -> Column:
    return F.when(F.length(raw) >= 7, F.substring(raw, 1, 7)).otherwise("unknown")


def activity(last_seen: Column, now: Column) -> Column:
    """active within 30 days, dormant within 180, else archived; unknown times are archived."""
    age = F.coalesce((F.unix_micros(now) - F.unix_micros(last_seen)) / F.lit(8.64e10), F.lit(1e9))
    return F.when(age <= 30, "active").when(age <= 180, "dormant").otherwise("archived")


def escape(text: Column) -> Column:
    """For XML text and attributes."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def approx_tokens(text: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(text) / 4)).cast("int")


def truncate_tokens(text: Column, most: int) -> Column:
    """At most so many approximate tokens, cut back to a line's end."""
    start = F.substring(text, 1, 4 * most)
    whole = F.when(start.contains("\n"), F.regexp_extract(start, r"(?s)^(.*)\n", 1)).otherwise(start)
    return F.when(F.length(text) <= 4 * most, text).otherwise(F.concat(whole, F.lit("\n")))


def scrub(text: Column, thinking: bool = False) -> Column:
    """A turn's text without results of tools and fenced code, stripped; of its thinking fences alone go."""
    return strip_fences(text) if thinking else strip(F.regexp_replace(F.regexp_replace(text, TOOL_RESULT, ""), FENCE, ""))


def strip_ansi(text: Column) -> Column:
    return F.regexp_replace(text, ANSI, "")


def lenient_json(text: Column) -> Column:
    """A variant from a model's answer: the text without fence marks, else its first { to last }; null if neither parses."""
    bare = strip(F.regexp_replace(text, r"(?m)^\s*```[a-zA-Z]*\s*$", ""))
    braces = F.regexp_extract(bare, r"(?s)(\{.*\})", 1)
    return F.coalesce(F.try_parse_json(bare), F.try_parse_json(F.when(braces != "", braces)))


def repair_json(text: Column) -> Column:
    """JSON text as it is where it parses; else mended (see mended), null if it stays unreadable. Python sees only what the
    parser refuses."""
    sound = F.try_parse_json(text).isNotNull()
    return F.coalesce(F.when(sound, text), _mend(F.when(~sound, text)))


@F.pandas_udf(StringType())
def _mend(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else mended(t))


#: What ends a string in single quotes, and a bare word.
ENDS, WORD = re.compile(r"\s*(?:[,:}\]]|$)"), re.compile(r"[\w.+-]+|.", re.S)
#: Words of another language for JSON's.
WORDS = {"True": "true", "False": "false", "None": "null"}


def mended(text: str) -> str | None:
    """JSON from its first bracket on with comments and needless commas gone, strings in single quotes and words of Python
    rewritten, and what is open at the end closed; null if that doesn't parse. Strings are told by their quotes: a single one
    ends at a quote before a comma, colon, bracket or the end."""
    start = min((i for i in map(text.find, "{[") if i >= 0), default=len(text))
    out, open_, comma, i, n = [], [], False, start, len(text)
    while i < n:
        c = text[i]
        if c in "\"'":
            out.append(",") if comma else None
            comma, body, i = False, [], i + 1
            while i < n:
                d = text[i]
                if d == "\\" and i + 1 < n:
                    body.append(text[i + 1] if text[i + 1] == "'" else text[i : i + 2])
                    i += 2
                    continue
                if d == c and (c == '"' or ENDS.match(text, i + 1)):
                    break
                body.append('\\"' if d == '"' else json.dumps(d)[1:-1] if d < " " else d)
                i += 1
            out.append('"' + "".join(body) + '"')
        elif text.startswith("//", i):
            i = text.find("\n", i) if text.find("\n", i) >= 0 else n
        elif text.startswith("/*", i):
            i = text.find("*/", i) + 1 if text.find("*/", i) >= 0 else n
        elif c == ",":
            comma = bool(out)
        elif c in "]}":
            comma = False
            if open_ and open_[-1] == c:
                out.append(open_.pop())
                if not open_:
                    break
        elif not c.isspace():
            out.append(",") if comma else None
            comma = False
            if c in "[{":
                open_.append("]" if c == "[" else "}")
                out.append(c)
            else:
                word = WORD.match(text, i)[0]
                out.append(WORDS.get(word, word))
                i += len(word) - 1
        i += 1
    try:
        return json.dumps(json.loads("".join(out) + "".join(reversed(open_))), ensure_ascii=False)
    except ValueError:
        return None


def move_key(text: Column) -> Column:
    """A move's text for comparison: lower case, each run of other than a-z and 0-9 a blank."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", " "))


def common_prefix(a: Column, b: Column) -> Column:
    """Length of the longest common prefix."""
    letters = lambda t: F.filter(F.split(t, ""), lambda c: c != "")
    same = F.zip_with(letters(a), letters(b), lambda x, y: F.coalesce(x == y, F.lit(False)))
    at = F.array_position(same, F.lit(False)).cast("int")
    return F.when(at > 0, at - 1).otherwise(F.size(same))


def project_slug(name: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(name)), r"[^a-z0-9]+", "-")


def summary_line(page: Column) -> Column:
    """The line that says what a page's entity is."""
    return F.nullif(F.regexp_extract(page, r"(?m)^\*\*What:\*\*\s*(.+)$", 1), F.lit(""))


def merge_summary(page: Column, summary: Column) -> Column:
    """A page with its semantic summary replaced, or put before the mention log, or at the end."""
    block = F.concat(F.lit("## Semantic summary\n"), summary, F.lit("\n\n"))
    has = page.rlike(r"(?m)^## Semantic summary$")
    swapped = F.concat(F.regexp_extract(page, r"(?s)^(.*?)## Semantic summary\n", 1), block, F.regexp_extract(page, r"(?s)## Semantic summary\n.*?(## .*)$", 1))
    before = F.concat(F.substring_index(page, "## Mention log", 1), block, F.lit("## Mention log"), F.regexp_extract(page, r"(?s)## Mention log(.*)$", 1))
    return F.when(has, swapped).when(page.contains("## Mention log"), before).otherwise(F.concat(page, F.lit("\n"), block))


def brief(title: str, items: Column, most: int = 12) -> Column:
    """A titled list of at most `most` items, empty without items."""
    lines = F.array_join(F.transform(F.slice(items, 1, most), lambda i: F.concat(F.lit("- "), i)), "\n")
    return F.when(F.size(items) > 0, F.concat(F.lit(f"## {title}\n"), lines, F.lit("\n"))).otherwise("")


def compact_markdown(pages: DataFrame, key: str = "name", text: str = "text") -> DataFrame:
    """(name, xml): Markdown pages as compact XML: blanks, rules, italics and first headings go, second headings make
    sections, bullets rules; prose is dropped but for a section named environment, which keeps 600 characters."""
    lines = pages.select(key, F.posexplode(F.split(text, "\n")).alias("n", "line")).withColumn("line", strip(F.col("line")))
    by = Window.partitionBy(key).orderBy("n")
    head = F.when(F.col("line").startswith("## "), F.struct("n", F.regexp_replace("line", r"^##\s+", "").alias("title")))
    lines = lines.withColumn("section", F.last(head, ignorenulls=True).over(by))
    drop = (F.col("line") == "") | F.col("line").rlike(r"^([-*_]{3,}|_[^_].*_|\*[^*].*\*|#\s.*|##\s.*)$")
    body = lines.where(~drop)
    clean = F.regexp_replace(F.regexp_replace(F.col("line"), r"^([-*+]|\d+\.)\s+", ""), r"[*`]{1,2}", "")
    rule = F.when(F.col("line").rlike(r"^([-*+]|\d+\.)\s+"), F.concat(F.lit("<r>"), escape(clean), F.lit("</r>")))
    prose = F.when(F.lower("section.title").startswith("env"), escape(clean))
    per = body.select(key, "section", "n", F.coalesce(rule, prose).alias("out")).where("out is not null").groupBy(key, "section").agg(F.array_sort(F.collect_list(F.struct("n", "out"))).alias("o"), F.min("n").alias("first"))
    inner = F.array_join(F.transform("o", lambda x: x["out"]), "\n")
    inner = F.when(F.lower("section.title").startswith("env"), F.substring(inner, 1, 600)).otherwise(inner)
    per = per.select(key, "first", F.concat(F.lit('<s t="'), escape(F.coalesce("section.title", F.lit(""))), F.lit('">\n'), inner, F.lit("\n</s>")).alias("s"))
    return per.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", "s"))), lambda x: x["s"]), "\n").alias("xml"))


def render_turn(index: Column, role: Column, ts: Column, text: Column, thinking: Column, most: int = 1500) -> Column:
    """A turn as a prompt shows it: place, role, time to the second, then text and thinking, cut; empty without either."""
    body, mind = (F.substring(strip(F.coalesce(c, F.lit(""))), 1, most) for c in (text, thinking))
    head = F.concat(F.lit("[t"), index.cast("string"), F.lit("] "), role, F.lit(" @"), F.substring(F.coalesce(ts, F.lit("")), 1, 19))
    line = lambda name, c: F.when(c != "", F.concat(F.lit(f"\n  {name}: "), c)).otherwise("")
    return F.when((body == "") & (mind == ""), "").otherwise(F.concat(head, line("text", body), line("thinking", mind)))


def _divisors(n: Column, most: Column) -> Column:
    """The divisors of a positive number up to most, found in pairs below its root."""
    low = F.filter(F.sequence(F.lit(1).cast("long"), F.greatest(F.lit(1), F.floor(F.sqrt(n.cast("double"))))), lambda d: n % d == 0)
    return F.filter(F.array_distinct(F.concat(low, F.transform(low, lambda d: F.floor(n / d)))), lambda d: d <= most)


def sample_turns(turns: DataFrame, most_chars: int = 240_000, shown: str = "text", note: int = 200, size: Column | None = None) -> DataFrame:
    """The turns of each session that fit a prompt of most_chars, with the `stride` they were taken at: all if they fit
    (joined by two line breaks); else the first and last tenth, and of the middle each n-th from its first on, n the smallest
    stride up to a quarter of the middle with which it fits beside them and a note; else no middle at all. Turns without
    text are left out. `size`: the length of what is shown, where its text isn't wanted itself.

    A session of any length is many ranges of turns, and its sums are taken from a row a range. Sums of all strides come from
    one aggregate: a turn counts for the divisors of its place, so a session of m turns makes some m log m rows, and only
    sessions over the budget make any."""
    from ..operators.ordering import numbered_within, same_place
    from ..staging import stage

    key, by = ["session_id"], Window.partitionBy("session_id")
    sized = turns.withColumn("_len", F.length(shown) if size is None else size).where("_len > 0")
    t = numbered_within(sized, key, [F.col("index")], "_i", 0)
    per = t.groupBy("_part", *key).agg(F.count("*").alias("_c"), F.sum(F.col("_len") + 2).alias("_l"))
    per = per.select("_part", *key, F.sum("_c").over(by).alias("_n"), (F.sum("_l").over(by) - 2).alias("_all"))  # a row a range
    per = per.withColumn("_side", F.greatest(F.lit(1), F.floor(F.col("_n") / 10)))
    per = stage(per.withColumn("_most", F.greatest(F.lit(2), F.floor((F.col("_n") - 2 * F.col("_side")) / 4) + 1)))
    head, tail = F.col("_i") < F.col("_side"), (F.col("_i") >= F.col("_n") - F.col("_side")) & (F.col("_n") > F.col("_side"))
    joined = lambda c: F.sum(F.when(c, F.col("_len") + 2).otherwise(0))
    less = lambda c: F.greatest(F.lit(0), F.sum(c).over(by) - 2)
    edges = same_place(t, per, key).groupBy("_part", *key).agg(joined(head).alias("_h"), joined(tail).alias("_t"))
    edges = edges.select("_part", *key, (F.lit(most_chars - note) - less("_h") - less("_t")).alias("_room"))  # a row a range
    per = stage(same_place(per, edges, key))
    j = F.col("_i") - F.col("_side")
    middle = same_place(t, per, key).where(~(head | tail) & (F.col("_all") > most_chars) & (F.col("_room") > 0)).withColumn("_j", j)
    first = middle.where("_j = 0").select("session_id", F.col("_len").alias("first"), "_room", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_most").cast("long"))).alias("d"))
    later = middle.where("_j > 0").select(F.col("session_id").alias("_s"), F.explode(_divisors(F.col("_j").cast("long"), F.col("_most"))).alias("_d"), "_len").groupBy("_s", "_d").agg(F.sum(F.col("_len") + 2).alias("more"))
    fits = first.join(later, F.col("session_id").eqNullSafe(F.col("_s")) & (F.col("d") == F.col("_d")), "left").where(F.col("first") + F.coalesce("more", F.lit(0)) <= F.col("_room"))
    strides = fits.groupBy(F.col("session_id").alias("_s")).agg(F.min("d").alias("stride"))
    per = stage(per.join(strides, F.col("session_id").eqNullSafe(F.col("_s")), "left").drop("_s"))
    t = same_place(t, per, key).withColumn("stride", F.when(F.col("_all") <= most_chars, 1).otherwise(F.col("stride")).cast("int"))
    kept = (F.col("_all") <= most_chars) | head | tail | F.coalesce(j % F.col("stride") == 0, F.lit(False))
    return t.where(kept).select(*turns.columns, "stride")
