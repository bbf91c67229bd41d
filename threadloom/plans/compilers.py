"""Compact artifacts of a profile: XML, Markdown and JSON texts within a token budget.

A profile is a handful of frames; each artifact takes the top rows it shows (a bounded sort in Spark) and renders them on
the driver. An artifact is a list of sections, each the kind of line that goes when the text is over budget.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from html import escape

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.drafts import project_rules, touches

SCHEMA = "0.2.1"


@dataclass
class Profile:
    """Frames of a profile (as profile.full_profile makes them) and what the project artifacts need."""

    frames: dict[str, DataFrame]
    project: str | None = None
    summaries: dict[str, str] = field(default_factory=dict)

    def top(self, name: str, n: int, *order: Column, where: Column | None = None) -> list[dict]:
        f = self.frames.get(name)
        if f is None:
            return []
        f = f if where is None else f.where(where)
        return [r.asDict() for r in f.orderBy(*order).limit(n).collect()]

    def moves(self, n: int) -> list[dict]:
        return self.top("moves", n, F.col("occurrences").desc(), F.col("move"), where=F.col("state") == "confirmed")

    def rules(self, n: int, *buckets: str) -> list[dict]:
        f = self.frames.get("rules")
        if f is None:
            return []
        if buckets:
            f = f.where(F.col("bucket").isin(*buckets)) if "bucket" in f.columns else f.limit(0)
        first = f.where("trim(rule_text) <> ''").groupBy(F.trim("rule_text").alias("rule_text")).agg(F.min_by("level", "seq").alias("level"), F.min("seq").alias("seq"))
        return [r.asDict() for r in first.orderBy("seq").limit(n).collect()]

    def concerns(self, n: int) -> list[dict]:
        return self.top("concern_lifecycle", n, F.col("raised").desc(), F.col("target_id"), where=F.col("status") == "latent_unresolved")

    def drifts(self, n: int, least: int = 2) -> list[dict]:
        return [d for d in self.top("drifts", n, F.col("count").desc(), F.col(self.frames["drifts"].columns[0]) if "drifts" in self.frames else F.lit(1)) if d["count"] >= least]

    def decisions(self, n: int) -> list[dict]:
        return self.top("load_bearing", n, F.col("sessions").desc(), F.col("entity"), where=F.col("load_bearing"))

    def entities(self, n: int) -> list[dict]:
        return self.top("top_entities", n, F.col("event_count").desc(), F.col("target_id"))

    def scale(self) -> dict:
        return self.frames["scale"].first().asDict() if "scale" in self.frames else {}


def tokens(text: str) -> int:
    return max(1, len(text) // 4)


def fit(lines: list[str], most: int, drop: list[str]) -> str:
    """The lines as a text; over budget, lines that start with the first prefix go, then those of the next, until it fits."""
    for prefix in drop:
        if tokens("\n".join(lines)) <= most:
            break
        lines = [x for x in lines if not x.strip().startswith(prefix)]
    return "\n".join(lines)


def cut(text: str, most: int) -> str:
    if tokens(text) <= most or len(text) <= 4 * most:
        return text
    return text[: 4 * most].rsplit("\n", 1)[0] + "\n"


TARGETS: dict[str, tuple[Callable[[Profile, int], str], int]] = {}


def target(name: str, budget: int) -> Callable:
    def keep(f: Callable[[Profile, int], str]) -> Callable:
        TARGETS[name] = (f, budget)
        return f

    return keep


def compile_profile(profile: Profile, name: str, max_tokens: int | None = None) -> str:
    if name not in TARGETS:
        raise KeyError(f"no artifact {name!r}; there are {sorted(TARGETS)}")
    f, budget = TARGETS[name]
    return f(profile, max_tokens or budget)


def _trigger(d: dict) -> str:
    return str(next(v for k, v in d.items() if k not in ("count", "examples")))


def _moves(p: Profile, n: int) -> list[str]:
    return [f'<mm l="{escape(m["level"] or "gen")}" o="{escape(m["owner"] or "user")}">{escape(m["move"])}</mm>' for m in p.moves(n) if m["move"]]


def _drifts(p: Profile, n: int) -> list[str]:
    return [f'<drift t="{escape(_trigger(d))}">count={d["count"]}</drift>' for d in p.drifts(n)]


@target("light_ir", 2000)
def light_ir(p: Profile, most: int) -> str:
    """Moves, rules (where they are classified the first of both meta buckets, in the pool's order), concerns, drifts, decisions and entities."""
    classified = "rules" in p.frames and "bucket" in p.frames["rules"].columns
    rules = p.rules(12, *(("meta_user", "meta_assistant") if classified else ()))
    lines = [f'<user-profile v="{SCHEMA}">', *_moves(p, 12), *[f"<rule>{escape(r['rule_text'])}</rule>" for r in rules]]
    for c in p.concerns(6):
        last = (c["raised_in"] or "").rpartition(",")[2]
        note = f" [t_last: {escape(last)}, n_raised: {c['raised']}]" if last else f" [n_raised: {c['raised']}]"
        lines.append(f'<concern r="{"recurring" if c["raised"] >= 2 else "latent"}">{escape(c["target_id"])}{note}</concern>')
    lines += _drifts(p, 6)
    lines += [f'<decision-active tid="{escape(d["entity"])}">refs={d["sessions"]}</decision-active>' for d in p.decisions(6)]
    if top := p.entities(10):
        lines += [f'<ent-top n="{len(top)}">', "  " + " ".join(f"{escape(e['target_id'])}:{escape(e.get('target_type') or '?')}" for e in top), "</ent-top>"]
    return fit([*lines, "</user-profile>"], most, ["<ent-top", "<decision-active", "<drift", "<concern", "<rule", "<mm "])


@target("light_ir_global", 1500)
def light_ir_global(p: Profile, most: int) -> str:
    lines = [f'<global-brain v="{SCHEMA}">', *_moves(p, 15), *[f"<obs>{escape(r['rule_text'])}</obs>" for r in p.rules(12, "meta_user")], *_drifts(p, 8), "</global-brain>"]
    return fit(lines, most, ["<drift", "<obs", "<mm"])


#: Signs of a concern that belongs to no single project.
GENERIC = ["oom", "api-error", "quota-exhaustion", "permissions", "web-fetch", "webfetch", "lite-llm", "curl", "bash"]


@target("light_ir_personal", 1500)
def light_ir_personal(p: Profile, most: int) -> str:
    lines = [f'<personal-brain v="{SCHEMA}">', *[f"<collab>{escape(r['rule_text'])}</collab>" for r in p.rules(20, "meta_assistant")]]
    lines += [f'<anticipate r="{c["raised"]}">{escape(c["target_id"].lower())}</anticipate>' for c in p.concerns(8) if c["raised"] >= 3 and any(g in c["target_id"].lower() for g in GENERIC)]
    return fit([*lines, "</personal-brain>"], most, ["<anticipate", "<collab"])


@target("light_ir_project", 2500)
def light_ir_project(p: Profile, most: int) -> str:
    name = p.project or "?"
    lines = [f'<project-brain v="{SCHEMA}" p="{escape(name)}">']
    if own := p.top("top_entities", 10, F.col("event_count").desc(), F.col("target_id"), where=touches(F.col("target_id"), name)):
        lines += ["<entities>", *[f'  <ent tid="{escape(e["target_id"])}" ev="{e["event_count"]}">{escape(p.summaries.get(e["target_id"], "")[:280])}</ent>' for e in own], "</entities>"]
    if (rules := p.frames.get("rules")) is not None:
        lines += [f"<rule>{escape(r['rule_text'])}</rule>" for r in project_rules(rules, name).orderBy("seq").limit(15).collect() if r["rule_text"]]
    lines += [f'<decision refs="{d["sessions"]}">{escape((d["sample_propositions"] or "")[:200])}</decision>' for d in p.top("load_bearing", 10, F.col("sessions").desc(), F.col("entity"), where=touches(F.col("entity"), name))]
    return fit([*lines, "</project-brain>"], most, ["<decision", "<rule", "  <ent", "<entities", "</entities"])


def _section(title: str, rows: list[str]) -> list[str]:
    return [f"## {title}", *rows, ""] if rows else []


@target("claude_md", 4000)
def claude_md(p: Profile, most: int, heading: str = "User meta-profile") -> str:
    s = p.scale()
    parts = ["---", "source: threadloom", f"schema: {SCHEMA}", f"sessions: {s.get('sessions', 0)}", f"mentions: {s.get('events', 0)}", f"providers: {s.get('providers', 0)}", "---", "", f"# {heading}", "", "_Compiled from many sessions: honor the moves, rules, concerns and decisions below._", ""]
    parts += _section("Mental moves (confirmed, ≥2 occurrences)", [f"- **[{m['level'] or 'gen'}/{m['owner'] or 'user'}]** {m['move'].strip()}  _(×{m['occurrences']})_" for m in p.moves(10)])
    parts += _section("Standing rules", [f"- {r['rule_text']}" for r in p.rules(10)])
    parts += _section("Latent/unresolved concerns", [f"- `{c['target_id']}` (raised ×{c['raised']})" for c in p.concerns(8)])
    parts += _section("Load-bearing decisions (active)", [f"- `{d['entity']}` — referenced in {d['sessions']} sessions" for d in p.decisions(8)])
    parts += _section("Recurring drift triggers", [f"- `{_trigger(d)}` — seen ×{d['count']}" for d in p.drifts(6)])
    ents = p.entities(12)
    parts += _section("Top entities", ["", "| entity | type | events |", "|---|---|---:|", *[f"| `{e['target_id']}` | {e.get('target_type', '?')} | {e['event_count']} |" for e in ents]] if ents else [])
    parts += _section("Concerns open longest", [f"- `{c['target_id']}` — open {c['lifetime_days']} days" for c in p.top("concern_lifetime", 5, F.col("lifetime_days").desc(), F.col("target_id"), where=F.col("kind") == "still_open")])
    parts += _section("Ideas recently resurrected", [f"- `{r['target_id']}` — gap {r['gap_days']} days, last seen {str(r['last_seen'])[:10]}" for r in p.top("idea_resurrection", 5, F.col("gap_days").desc(), F.col("target_id"))])
    parts += _section("Decisions showing thrashing", [f"- `{d['target_id']}` — half-life {d['half_life_days']} days, events {d['event_count']}" for d in p.top("decision_half_life", 5, F.col("half_life_days"), F.col("target_id"), where=F.col("thrashing"))])
    return cut("\n".join(parts), most)


@target("gemini_md", 4000)
def gemini_md(p: Profile, most: int) -> str:
    return claude_md(p, most, "Operator meta-profile")


@target("cursor_rules", 2000)
def cursor_rules(p: Profile, most: int) -> str:
    parts = ["# Moves, rules and open concerns distilled from many sessions.", "", "## Mental moves to honor", *[f"- {m['move'].strip()}" for m in p.moves(8)], "", "## Standing rules", *[f"- {r['rule_text']}" for r in p.rules(8)], ""]
    parts += _section("Open concerns (do not silently introduce regressions here)", [f"- `{c['target_id']}`" for c in p.concerns(6)])
    return cut("\n".join(parts), most)


@target("boot_context", 8000)
def boot_context(p: Profile, most: int) -> str:
    """Six lists of cards as JSON; never cut."""
    cards = {
        "mental_moves": [{k: m[k] for k in ("move", "level", "owner", "occurrences")} for m in p.moves(10)],
        "rules": [{"rule": r["rule_text"], "level": r["level"]} for r in p.rules(10)],
        "latent_concerns": [{"target_id": c["target_id"], "raised_count": c["raised"]} for c in p.concerns(8)],
        "drift_warnings": [{"trigger": _trigger(d), "count": d["count"]} for d in p.drifts(6)],
        "load_bearing_decisions": [{"target_id": d["entity"], "sessions_referenced": d["sessions"]} for d in p.decisions(8)],
        "top_entities": [{"target_id": e["target_id"], "type": e.get("target_type", "?"), "events": e["event_count"]} for e in p.entities(12)],
    }
    return json.dumps({"schema": SCHEMA, "source": "threadloom", "scale": p.scale(), "cards": cards}, indent=2, ensure_ascii=False, default=str)


@target("brain_view", 32000)
def brain_view(p: Profile, most: int) -> str:
    """Regions, fibers and hypotheses as JSON."""
    from ..operators import brain

    areas = brain.regions(p.frames)
    rows = lambda f: [r.asDict() for r in f.collect()]  # noqa: E731  8, 22 and 6 rows
    return json.dumps({"schema": SCHEMA, "regions": rows(areas), "fibers": rows(brain.fibers(areas.sparkSession, areas)), "pills": rows(brain.hypotheses(p.frames))}, indent=2, ensure_ascii=False, default=str)


def compile_projects(profile: Profile, min_rules: int = 2, most: int | None = None) -> dict[str, str]:
    """light_ir_project of every scope that at least min_rules rules (of bucket project_domain, where they are classified) name."""
    rules = profile.frames.get("rules")
    if rules is None:
        return {}
    scope = "scope" if "scope" in rules.columns else "level"
    own = rules.where("bucket = 'project_domain'") if "bucket" in rules.columns else rules
    scopes = own.select(F.trim(scope).alias("level")).where("level <> ''").groupBy("level").agg(F.count("*").alias("n")).where(F.col("n") >= min_rules).orderBy(F.col("n").desc(), "level")
    return {r["level"]: compile_profile(Profile(profile.frames, r["level"], profile.summaries), "light_ir_project", most) for r in scopes.toLocalIterator()}
