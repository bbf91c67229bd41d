"""python -m threadloom.cli COMMAND: the pipeline over a folder of extraction documents."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions import slugs, text
from .operators import decisions as dec
from .operators import brain_state, domain, drafts, event_log, extract, graph, profile, reliability, sanitize, vault
from .plans.compilers import TARGETS, Profile, compile_profile, compile_projects
from .session import get_session
from .sources import extractions, profiles, rewriting, transcripts
from .sources.writing import write_texts


def frames(spark, args) -> dict[str, DataFrame]:
    """The typed frames of the input folders, names made canonical, events cached for the actions that follow."""
    docs = extractions.scan(spark, args.sessions, args.providers)
    aliases = slugs.load_aliases(spark, args.aliases) if args.aliases else None
    events = slugs.canonical_events(extractions.mention_events(docs), aliases).cache()
    return {"docs": docs, "events": events, "decisions": slugs.canonical_objects(extractions.decisions(docs), aliases)}


def whole_profile(f: dict[str, DataFrame]) -> dict[str, DataFrame]:
    kinds = {k: extractions.objects(f["docs"], k) for k in profile.DELTAS}
    return profile.full_profile(f["events"], f["decisions"], kinds)


def write_vault(f: dict[str, DataFrame], folder: str) -> DataFrame:
    """The entity pages and their index as Markdown files; (path, bytes) of what was written."""
    rules = extractions.objects(f["docs"], "rules")
    pages = vault.pages(f["events"], F.current_timestamp(), f["decisions"], rules).select("name", "page")
    every = pages.unionByName(vault.index_page(vault.file_names(f["events"])))
    return write_texts(every, folder, "name", "page", ".md")


def sessions(turns: DataFrame) -> DataFrame:
    """(session_id, provider, text): each session's turns, scrubbed, sampled to the budget and rendered for a model."""
    t = turns.select("session_id", "provider", "index", text.render_turn(F.col("index"), F.col("role"), F.col("timestamp"), text.scrub(F.col("text")), text.scrub(F.col("thinking"), True)).alias("text"))
    kept = text.sample_turns(t).groupBy("session_id", "provider").agg(F.array_sort(F.collect_list(F.struct("index", "text"))).alias("t"))
    return kept.select("session_id", "provider", F.array_join(F.transform("t", lambda x: x["text"]), "\n\n").alias("text"))


def show(df: DataFrame, n: int = 50) -> None:
    for r in df.limit(n).collect():
        print(json.dumps(r.asDict(recursive=True), default=str, ensure_ascii=False))


def main(argv: list[str] | None = None) -> int:
    a = argparse.ArgumentParser(prog="threadloom")
    a.add_argument("command", choices=["status", "ingest", "extract", "reflect", "events", "vault", "aggregate", "compile", "compile-projects", "brain", "draft", "index", "ripple", "open", "history", "supersession", "reliability", "domain", "canonicalize", "canvas", "pipeline"])
    a.add_argument("sessions", nargs="+", help="folders of extraction documents (ingest, extract, reflect: of transcripts; domain, draft: a project; canvas: its nodes)")
    a.add_argument("--out")
    a.add_argument("--providers", nargs="*")
    a.add_argument("--aliases")
    a.add_argument("--target", default="light_ir", choices=sorted(TARGETS))
    a.add_argument("--sanitize", default="none", choices=sanitize.LEVELS)
    a.add_argument("--max-tokens", type=int)
    a.add_argument("--provider", default="claude_code")
    a.add_argument("--entity")
    a.add_argument("--limit", type=int, default=30)
    a.add_argument("--profile", help="compile, draft and brain: a stored profile instead of --sessions' documents")
    a.add_argument("--project", default="?")
    a.add_argument("--apply", action="store_true", help="canonicalize, canvas: write the files in place")
    a.add_argument("--force", action="store_true", help="canvas: look at nodes that have a name already")
    a.add_argument("--fast", action="store_true", help="extract: no critique")
    args = a.parse_args(argv)
    spark = get_session()
    if args.command == "ingest":
        turns = transcripts.reader(args.provider)(spark, args.sessions[0])
        out = transcripts.normalised(turns)
        out.write.mode("overwrite").json(args.out) if args.out else show(out)
        return 0
    if args.command == "domain":
        seen = domain.inspect(domain.load(spark, args.sessions[0]))
        show(domain.coverage(seen))
        show(domain.gaps(seen))
        return 0
    if args.command in ("extract", "reflect"):
        read = sessions(transcripts.reader(args.provider)(spark, args.sessions[0]))
        if args.command == "extract":
            out = extract.run_sessions(read, fast=args.fast)
            show(out.drop("document")) if not args.out else show(write_texts(out.withColumn("name", F.concat("provider", F.lit("/"), "session_id")), args.out, "name", "document", ".json"), args.limit)
            return 0
        answers = extract.lenses(read.select("session_id", F.col("text").alias("brief")))
        page = extract.reflection(answers, read, project=args.project)
        show(write_texts(page, args.out, "session_id", "page", ".md") if args.out else page, args.limit)
        return 0
    aliases = slugs.load_aliases(spark, args.aliases) if args.aliases else None
    if args.command == "canvas":
        nodes = rewriting.canvas_slugs(spark, args.sessions[0], aliases, args.force)
        show(write_texts(nodes.where("outcome = 'rewritten'"), None, "path", "text") if args.apply else nodes.drop("text"), args.limit)
        return 0
    if args.command == "canonicalize" and args.apply:
        for folder in args.sessions:
            show(write_texts(rewriting.canonical_documents(spark, folder, aliases), None, "path", "text"), args.limit)
        return 0
    stored = profiles.load(spark, args.profile) if args.profile else None
    if args.command == "draft":
        asked = drafts.prompts(spark, args.sessions[0], args.project, stored or {"top_entities": spark.createDataFrame([], "target_id string, event_count long, providers string")})
        show(drafts.draft(asked, extract.rule_based, args.project), args.limit)
        return 0
    f = frames(spark, args) if stored is None else {}
    e = f.get("events")
    if args.command in ("compile", "compile-projects", "brain"):
        every = stored if stored is not None else whole_profile(f)
        if args.command == "brain":
            print(brain_state.state_json(every, e))
            return 0
        p = Profile(sanitize.sanitise(every, args.sanitize))
        print(compile_profile(p, args.target, args.max_tokens) if args.command == "compile" else json.dumps(compile_projects(p), ensure_ascii=False, indent=1))
        return 0
    if stored is not None:
        a.error(f"{args.command} takes no --profile")
    if args.command == "status":
        show(event_log.meta(e))
    elif args.command == "canonicalize":
        show(e.where("mentioned_as is not null").select("mentioned_as", "target_id").distinct().orderBy("mentioned_as"), args.limit)
    elif args.command == "open":
        show(dec.open_items(f["decisions"], args.limit))
    elif args.command == "history":
        show(dec.history(f["decisions"], args.entity or "", args.limit))
    elif args.command == "supersession":
        show(dec.supersession(f["decisions"]).orderBy(F.col("links").desc(), "entity"), args.limit)
    elif args.command == "reliability":
        kinds = ["mention_events", "decisions", "drifts", "rules", "mental_moves", "stances", "unresolved"]
        m = reliability.per_provider(extractions.session_counts(f["docs"]), kinds)
        show(m)
        show(reliability.skew(m, "mention_events_mean"))
    else:
        if not args.out:
            a.error(f"{args.command} needs --out")
        if args.command in ("events", "pipeline"):
            event_log.write_months(e, f"{args.out}/events")
            event_log.file_index(e.sparkSession, f"{args.out}/events").write.mode("overwrite").json(f"{args.out}/events_index")
        if args.command in ("vault", "pipeline"):
            write_vault(f, f"{args.out}/entities").agg(F.sum("bytes")).collect()
        if args.command in ("aggregate", "pipeline"):
            profiles.save(whole_profile(f), f"{args.out}/profile")
        if args.command == "ripple":
            edges = graph.cochange(e)
            write_texts(graph.shards(graph.ripple(edges, graph.criticality(e, edges))), f"{args.out}/ripple", suffix=".json").agg(F.sum("bytes")).collect()
        if args.command == "index":
            for name, frame in graph.bundle(e).items():
                frame.write.mode("overwrite").json(f"{args.out}/graph/{name}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
