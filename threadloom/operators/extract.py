"""Extraction from transcripts by a pluggable model, its prompts, and the filters of its verdicts.

A model is any callable from (system, user) to text. There is no network here, so the one that ships is rule-based: it
finds names in turns and is deterministic; the surface, retries and filters are what a real model would use.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import lenient_json, merge_summary, strip

Model = Callable[[str, str], str]
#: A model that is told how long its answer may be: (system, user, tokens) to (text, reason for its end); "length" is an overrun.
BudgetModel = Callable[[str, str, int], tuple[str, str]]
#: Kinds of object by phase of the extraction.
PHASES = {"mentions": ["mention_events"], "decisions": ["decisions", "artifacts", "unresolved"], "drifts": ["drifts"], "moves": ["mental_moves", "affect"], "stances": ["stances", "rules", "meta_moments"]}
KINDS = [k for kinds in PHASES.values() for k in kinds]
#: What each phase looks for, and the fields of its objects.
TASKS = {
    "mentions": "Name every project, tool, technology, concept, artifact, error or decision that a turn refers to, once a reference. Fields: target_id, target_type, mention_type, authorship, valence, timestamp, evidence_quote.",
    "decisions": "List decisions that this session made, revisited or overturned, not those it only mentions; files it produced; and questions it leaves open. Decisions have decision, why, status, decided_by, related_entities.",
    "drifts": "List each point where one side corrected the other's course. Fields: trigger, trigger_detail, proposed, corrected_to, rule_generated.",
    "moves": "List ways of reasoning that recur (move, owner, level, evidence) and marks of feeling (marker, valence, owner, trigger, implication).",
    "stances": "List standpoints (proposition, stance, target, reason), rules stated for later work (rule_text, applies_to, level) and remarks on the collaboration itself (observation). The drifts found so far are given first.",
    "verify": "Against the turns, add to each object a field _verdict: supported, unsupported or partial. Return all objects in the same arrays.",
    "critique": "As a sceptical reader, add to each object a field _critique_verdict: keep or drop. Return all objects in the same arrays.",
}
BUCKETS = ["meta_user", "meta_assistant", "project_domain", "debugging_recipe"]
#: The lenses a session is read through.
LENSES = ["decisions", "concerns", "drift", "moves", "open questions", "next steps"]
#: Tokens of an answer, of one about whole sessions, and the most a retry may ask for.
BUDGET, DENSE, MOST = 16_384, 32_768, 65_536


def prompt(phase: str, body: Column) -> Column:
    """The user prompt of a phase."""
    return F.concat(F.lit(task(phase)), body)


def task(phase: str) -> str:
    kinds = ", ".join(PHASES.get(phase, KINDS if phase in TASKS else [phase]))
    return f"{TASKS.get(phase, '')} Return one JSON object with the arrays: {kinds}. Quote evidence word for word; leave out what the text does not say.\n\n".lstrip()


def rule_based(system: str, user: str) -> str:
    """A stand-in for a model: capitalised compounds and code names in the text become mentions."""
    names = dict.fromkeys(re.findall(r"\b(?:[A-Z][a-z]+[A-Z]\w*|[a-z]+-[a-z0-9-]+|[A-Z]{3,})\b", user.split("\n\n", 1)[-1]))
    return json.dumps({"mention_events": [{"target_id": n, "target_type": "Concept", "mention_type": "reference", "valence": "neutral"} for n in names]})


def call(model: Model, system: str, user: str, retries: int = 2) -> str | None:
    """The model's answer; null once every try has failed."""
    for _ in range(retries + 1):
        try:
            return model(system, user)
        except Exception:
            continue
    return None


def extract(sessions: DataFrame, model: Model = rule_based, system: str = "You extract structured facts.", phases: list[str] | None = None) -> DataFrame:
    """(session_id, provider, phase, answer): each session's text (column text) through each phase's prompt; answers are
    JSON text for lenient_json. Rows are independent, so tasks retry alone."""
    chosen = phases or list(PHASES)
    x = sessions.select("session_id", "provider", F.explode(F.create_map(*[c for p in chosen for c in (F.lit(p), prompt(p, F.col("text")))])).alias("phase", "prompt"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(answer=[call(model, system, p) for p in b["prompt"]])[["session_id", "provider", "phase", "answer"]]

    return x.mapInPandas(run, "session_id string, provider string, phase string, answer string")


def budgeted(model: Model) -> BudgetModel:
    """A plain model as one with a budget that it never overruns."""
    return lambda system, user, tokens: (model(system, user), "stop")


def _object(text: str) -> dict | None:
    """The JSON object in an answer, fenced or with prose around it; None if there is none."""
    bare = "\n".join(x for x in text.strip().splitlines() if not x.lstrip().startswith("```"))
    for t in (bare, bare[bare.find("{") : bare.rfind("}") + 1]):
        try:
            found = json.loads(t)
        except ValueError:
            continue
        return found if isinstance(found, dict) else None
    return None


def _kept(objects, verdict: str, good: str) -> list[dict]:
    """Objects whose verdict is good or missing, without it and its reason."""
    own = [o for o in objects if isinstance(o, dict)] if isinstance(objects, list) else []
    fields = (verdict, verdict.replace("verdict", "reason"))
    return [{k: v for k, v in o.items() if k not in fields} for o in own if str(o.get(verdict) or good).lower() == good]


def run_session(text: str, model: BudgetModel, system: str = "You extract structured facts.", fast: bool = False) -> tuple[dict, list[dict]]:
    """(objects by kind, a log entry a call) of one session's text: five extractions, then all objects are verified against
    the text and, unless fast, criticised; what fails either goes. An answer that is empty because it ran out of its budget
    is asked for again with twice as much; an unreadable check leaves the objects as they were."""
    log: list[dict] = []

    def ask(phase: str, body: str, tokens: int) -> dict | None:
        answer, end = model(system, task(phase) + body, tokens)
        if end == "length" and not answer:
            log.append({"phase": phase, "retry": min(2 * tokens, MOST)})
            answer, end = model(system, task(phase) + body, min(2 * tokens, MOST))
        found = _object(answer or "")
        log.append({"phase": phase, "parsed": found is not None, "chars": len(answer or ""), "end": end})
        return found

    objects: dict[str, list] = {k: [] for k in KINDS}
    for phase, kinds in PHASES.items():
        before = "Drifts: " + json.dumps(objects["drifts"], ensure_ascii=False) + "\n\n" if phase == "stances" else ""
        found = ask(phase, before + text, DENSE if phase == "mentions" else BUDGET) or {}
        for k in kinds:
            objects[k] = found[k] if isinstance(found.get(k), list) else []
    for phase, verdict, good in (("verify", "_verdict", "supported"), ("critique", "_critique_verdict", "keep")):
        if phase == "critique" and fast:
            break
        shown = json.dumps(objects, ensure_ascii=False) + ("\n\n" + text if phase == "verify" else "")
        checked = ask(phase, shown, DENSE)
        checked = objects if checked is None else checked
        objects = {k: _kept(checked.get(k), verdict, good) for k in KINDS}
    return objects, log


def run_sessions(sessions: DataFrame, model: BudgetModel | None = None, fast: bool = False, extractor: str = "rule_based") -> DataFrame:
    """(session_id, provider, document, log, error): the extraction document of each session (column text) as JSON, in the
    shape that sources.extractions reads. A session whose model fails has an error and no document; the others go on. Rows
    are independent, so a lost task runs its own sessions again."""
    chosen = model or budgeted(rule_based)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for sid, provider, text in zip(b["session_id"], b["provider"], b["text"], strict=True):
                try:
                    objects, log = run_session(text or "", chosen, fast=fast)
                except Exception as e:
                    rows.append((sid, provider, None, None, f"{type(e).__name__}: {e}"))
                    continue
                doc = {"session_id": sid, "provider": provider, "extractor": extractor, "schema_version": "0.2.1", "session_meta": {"input_type": "dialog"}, **objects}
                rows.append((sid, provider, json.dumps(doc, ensure_ascii=False), json.dumps({"phases": log, "object_counts": {k: len(v) for k, v in objects.items()}}), None))
            yield pd.DataFrame(rows, columns=["session_id", "provider", "document", "log", "error"])

    return sessions.select("session_id", "provider", "text").mapInPandas(run, "session_id string, provider string, document string, log string, error string")


def keep_supported(objects: DataFrame, verdict: str = "verdict") -> DataFrame:
    """Objects that the verifier supports; no verdict counts as support."""
    return objects.where(F.lower(F.coalesce(F.nullif(F.col(verdict), F.lit("")), F.lit("supported"))) == "supported")


def keep_after_critique(objects: DataFrame, verdict: str = "critique") -> DataFrame:
    """Objects that the critique keeps; no verdict keeps."""
    return objects.where(F.lower(F.coalesce(F.nullif(F.col(verdict), F.lit("")), F.lit("keep"))) == "keep")


def classify(rules: DataFrame, model: Model | None = None) -> DataFrame:
    """rules with bucket: the model's where it is one of the four, else project_domain. Without a model nothing leaves the JVM."""
    if model is None:
        return rules.withColumn("bucket", F.lit("project_domain"))

    @F.pandas_udf("string")
    def ask(text: pd.Series) -> pd.Series:
        answers = text.map(lambda t: (call(model, "Answer with one bucket: " + ", ".join(BUCKETS), t or "") or "").strip().strip('"'))
        return answers.where(answers.isin(BUCKETS), "project_domain")

    return rules.withColumn("bucket", ask("rule_text"))


def lenses(briefs: DataFrame, model: Model = rule_based) -> DataFrame:
    """(session_id, lens, answer): each session's brief (column brief) through every lens."""
    x = briefs.select("session_id", F.explode(F.array(*[F.lit(n) for n in LENSES])).alias("lens"), "brief")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(answer=[call(model, f"Read through the lens of {lens}.", text) for lens, text in zip(b["lens"], b["brief"], strict=True)])[["session_id", "lens", "answer"]]

    return x.mapInPandas(run, "session_id string, lens string, answer string")


def _ask_all(frame: DataFrame, model: Model) -> DataFrame:
    """frame with the model's answer to its columns system and user."""

    @F.pandas_udf("string")
    def ask(system: pd.Series, user: pd.Series) -> pd.Series:
        return pd.Series([call(model, s, u) for s, u in zip(system, user, strict=True)], dtype="object")

    return frame.withColumn("answer", ask("system", "user"))


ENRICH = 'Summarise an entity that recurs in a history of conversations. Answer with one JSON object: {"what": one sentence, "how_used": one sentence, "status": active, dormant, superseded or experimental, "representative_quotes": up to three of {"quote", "provider", "why"}}. No Markdown.'


def enrich_prompts(entities: DataFrame, events: DataFrame, most: int = 12) -> DataFrame:
    """(target_id, contexts, system, user): what a model is asked about each entity that was quoted: at most `most` quotes,
    taken in turn from its providers and valences. Entities without a quote are left out."""
    from .vault import diverse

    quoted = events.where(strip(F.col("evidence_quote")) != "").join(entities.select("target_id").distinct(), "target_id", "left_semi")
    line = F.concat(F.lit("  ["), F.coalesce("provider", F.lit("?")), F.lit("/"), F.coalesce("valence", F.lit("?")), F.lit('] "'), F.substring("evidence_quote", 1, 200), F.lit('"'))
    per = diverse(quoted, most).groupBy("target_id").agg(F.count("*").alias("contexts"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", line.alias("l")))), lambda x: x["l"]), "\n").alias("quotes"))
    said = F.concat(F.lit("Entity: "), "target_id", F.lit("\nType: "), F.coalesce("target_type", F.lit("Unknown")), F.lit("\nMentions: "), F.col("event_count").cast("string"), F.lit("\nProviders: "), F.coalesce("providers", F.lit("")), F.lit("\n\nQuotes:\n"), "quotes", F.lit("\n"))
    return entities.join(per, "target_id").select("target_id", "contexts", F.lit(ENRICH).alias("system"), said.alias("user"))


def render_summary(answer: Column, contexts: Column) -> Column:
    """A model's JSON answer as the body of a semantic summary; null where it cannot be read."""
    v = lenient_json(answer)
    field = lambda f: F.coalesce(F.try_variant_get(v, f"$.{f}", "string"), F.lit("\u2014"))
    quotes = F.slice(F.coalesce(F.try_variant_get(v, "$.representative_quotes", "array<variant>"), F.array().cast("array<variant>")), 1, 3)
    part = lambda q, f, none: F.coalesce(F.try_variant_get(q, f"$.{f}", "string"), F.lit(none))
    lines = F.array_join(F.transform(quotes, lambda q: F.concat(F.lit("- ["), part(q, "provider", "?"), F.lit('] "'), strip(part(q, "quote", "")), F.lit('" \u2014 _'), part(q, "why", ""), F.lit("_"))), "\n")
    shown = F.when(F.size(quotes) > 0, F.concat(F.lit("\n\n**Representative quotes:**\n"), lines)).otherwise("")
    body = F.concat(F.lit("**What:** "), field("what"), F.lit("\n\n**How used:** "), field("how_used"), F.lit("\n\n**Status:** "), field("status"), shown, F.lit("\n\n_Enriched from "), contexts.cast("string"), F.lit(" sampled mentions._"))
    return F.when(v.isNotNull(), body)


def enrich(entities: DataFrame, events: DataFrame, pages: DataFrame, model: Model, most: int = 12) -> DataFrame:
    """(target_id, contexts, status, page): each entity's page (columns target_id, page) with its summary in place: merged,
    parse_failed, no_vault_page, or skipped_no_contexts for entities that were never quoted."""
    asked = _ask_all(enrich_prompts(entities, events, most), model).withColumn("summary", render_summary(F.col("answer"), F.col("contexts")))
    x = entities.select("target_id").join(asked, "target_id", "left").join(pages.select("target_id", F.col("page").alias("_page")), "target_id", "left")
    status = F.when(F.col("contexts").isNull(), "skipped_no_contexts").when(F.col("summary").isNull(), "parse_failed").when(F.col("_page").isNull(), "no_vault_page").otherwise("merged")
    return x.select("target_id", F.coalesce("contexts", F.lit(0)).alias("contexts"), status.alias("status"), F.when(status == "merged", merge_summary(F.col("_page"), F.col("summary"))).otherwise(F.col("_page")).alias("page"))


def reflection(answers: DataFrame, sessions: DataFrame, user: str = "?", project: str = "?") -> DataFrame:
    """(session_id, page): the lenses' answers (as lenses() gives them) to each session (session_id, provider) as one Markdown
    page, in the order of the lenses; an answer without a heading gets its lens's, an empty one is left out."""
    place = F.array_position(F.array(*[F.lit(x) for x in LENSES]), F.col("lens"))
    body = F.regexp_replace("answer", r"\s+$", "")
    headed = F.when(F.ltrim(F.col("answer")).startswith("###"), body).otherwise(F.concat(F.lit("### "), F.initcap("lens"), F.lit("\n\n"), body))
    own = answers.where((strip(F.col("answer")) != "") & (place > 0)).groupBy("session_id").agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(place.alias("p"), headed.alias("t")))), lambda x: x["t"]), "\n\n").alias("body"))
    x = sessions.select("session_id", "provider").join(own, "session_id", "left")
    head = F.concat(F.lit("---\nsession_id: "), "session_id", F.lit(f"\nproject: {project}\nuser_id: {user}\nprovider: "), F.coalesce("provider", F.lit("?")), F.lit("\nlens_count: "), F.coalesce("n", F.lit(0)).cast("string"), F.lit("\n---\n\n# Session reflection\n\n"))
    return x.select("session_id", F.concat(head, F.coalesce("body", F.lit("")), F.lit("\n")).alias("page"))
