"""The command line: prepare, build, refine, enrich, rebuild, repair. Each command is a stage; run folders hand over between them."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sedimenta.functions.ordering import walk_order
from sedimenta.operators import enrich as enrichment
from sedimenta.operators import forum, inventory, knowledge, repair, signatures
from sedimenta.plans.build import build
from sedimenta.session import build_session
from sedimenta.sources import archive, sinks, tables

TABLES = ("posts", "topics", "users", "post_salvage", "merged_identities", "knowledge_posts")
ORDER = {"topics": "topic_key", "users": "user_key", "post_salvage": "salvage_key", "merged_identities": "merged_identity_key"}


def _finish(spark: SparkSession, stage: str, out: str, summary: dict, manifest: dict) -> None:
    """The two documents and the last audit row that every stage leaves."""
    sinks.write_document(summary, f"{out}/summary.json")
    sinks.write_document(manifest | {"generated_at": sinks.now(), "stage": stage}, f"{out}/manifest.json")
    sinks.note(spark, stage, "done: " + ", ".join(f"{k}={v}" for k, v in summary.items()), out, f"{out}/audit")


def prepare(spark: SparkSession, archive_root: str, sources: list[str], out: str, copy: bool = False) -> dict:
    """The inventory of a raw archive, its kept files as a table (or as files), and the manifest."""
    roots = {s: f"{archive_root}/{s}" for s in sources}
    sinks.note(spark, "prepare", "start", archive_root, f"{out}/audit")
    files = archive.inventory_sources(spark, roots)
    entries, directories = inventory.inventory(files).persist(), archive.directories(files, roots).persist()
    sinks.write_jsonl(entries, f"{out}/files.jsonl")
    sinks.write_jsonl(directories, f"{out}/directories.jsonl")
    sinks.write_jsonl(inventory.exceptions(entries), f"{out}/exceptions.jsonl")
    if copy:
        sinks.copy_files(entries, files, f"{out}/normalized").count()
    else:
        sinks.materialize(entries, files, f"{out}/normalized.parquet")
    warned = entries.select("original_relative_path", F.explode("warnings").alias("w"))
    sinks.write_audit(sinks.audit_rows(warned, "WARNING", "prepare", F.col("w").cast("string"), "original_relative_path"), f"{out}/audit")
    sinks.write_audit(sinks.audit_rows(inventory.exceptions(entries), "ERROR", "prepare", F.concat_ws(": ", "reason", "exception"), "original_relative_path"), f"{out}/audit")
    found = sinks.counters(spark, inventory.summary(entries)) | {"directories_scanned": directories.count()}
    # Directories and files are tables of their own, however many there are; the manifest says where.
    manifest = {"manifest_version": 2, "sources": [{"source_key": k, "root_path": r} for k, r in roots.items()], "summary": found, "directories": "directories.jsonl", "files": "files.jsonl"}
    _finish(spark, "prepare", out, found, manifest)
    entries.unpersist()
    directories.unpersist()
    return found


def build_tables(spark: SparkSession, input_root: str, out: str, kinds: str | None = None, read_limit: int = 0, compat: bool = True) -> dict:
    """The warehouse of a normalised tree, in a new run folder."""
    run = os.path.join(out, sinks.run_id())
    sinks.note(spark, "build", "start", input_root, f"{run}/audit")
    pages = archive.read_pages(spark, input_root, archive.parse_kinds(kinds), read_limit, repair=not compat).persist()
    house = build(archive.usable(pages), compat)
    for name in TABLES:
        folder = "knowledge" if name == "knowledge_posts" else "warehouse"
        sinks.write_jsonl(getattr(house, name), f"{run}/{folder}/{name}.jsonl", ORDER.get(name))
    nameless = house.nameless.persist()
    sinks.write_audit(sinks.audit_rows(pages.filter("error is not null"), "ERROR", "build", F.col("error"), "rel"), f"{run}/audit")
    sinks.write_audit(sinks.audit_rows(nameless, "WARNING", "build", F.concat(F.lit("no id: "), "kind"), "rel"), f"{run}/audit")
    suspect = pages.filter("mojibake and not repaired")
    sinks.write_audit(sinks.audit_rows(suspect, "WARNING", "build", F.concat_ws(" ", F.lit("perhaps a wrong encoding:"), "decoder", "charset"), "rel"), f"{run}/audit")
    sinks.write_audit(sinks.audit_rows(pages.filter("repaired"), "INFO", "build", F.lit("encoding repaired"), "rel"), f"{run}/audit")
    counts = pages.agg(
        F.count("*").alias("processed_files"), F.count_if(F.col("error").isNull()).alias("parsed_files"), F.count_if(F.col("error").isNotNull()).alias("errors"), F.count_if(F.col("mojibake") & ~F.col("repaired")).alias("suspect")
    )
    found = sinks.counters(spark, counts)
    rows = {name: spark.read.text(f"{run}/{'knowledge' if name == 'knowledge_posts' else 'warehouse'}/{name}.jsonl").count() for name in TABLES}
    warnings = nameless.count() + found.pop("suspect")
    html = archive.read_files(spark, input_root, "*.[hH][tT][mM][lL]").count()
    found |= rows | {
        "skipped_files": html - found["processed_files"], "posts_emitted": rows["posts"], "salvage_records": rows["post_salvage"], "salvage_promoted": 0, "topic_stubs_skipped": house.topic_stubs.count(), "warnings": warnings,
    }
    _finish(spark, "build", run, found, {"input_root": input_root, "output_root": run, "kinds": archive.parse_kinds(kinds), "read_limit": read_limit, "compat": compat})
    pages.unpersist()
    nameless.unpersist()
    return found | {"run": run}


def refine(spark: SparkSession, run: str, options: signatures.Options = signatures.Options(), read_limit: int = 0) -> dict:
    """Posts without the signatures that their authors repeat, and the signatures; of the first posts in the order of pages only if there is a limit."""
    out = f"{run}/signature_refine/{sinks.run_id()}"
    sinks.note(spark, "refine", "start", run, f"{out}/audit")
    posts = tables.read_jsonl(spark, f"{run}/warehouse/posts.jsonl", tables.POST_SCHEMA)
    order = F.struct(walk_order(F.col("first_source_file")).alias("page"), F.col("source_position").alias("pos"), "post_key")
    if read_limit:
        posts = posts.orderBy(order).limit(read_limit)
    posts = posts.persist()
    told = posts.filter("architecture = 'asp' and source_page_kind = 'topic' and author_key is not null").select(
        "post_key", F.col("author_key").alias("user_key"), F.coalesce("body_text", F.lit("")).alias("body"), "author_display", order.alias("ord")
    )
    endings, authors = signatures.candidates(told, options)
    found = signatures.profiles(endings, authors, options).persist()
    clean = signatures.strip_signatures(told, found, options=options)
    full = posts.join(clean.select("post_key", "clean", "signature"), "post_key", "left")
    full = full.withColumns(
        {"body_text_full": F.col("body_text"), "signature_text": F.col("signature"), "signature_rule": F.when(F.col("signature").isNotNull(), "repeated_user_suffix"), "body_text": F.coalesce("clean", "body_text")}
    ).drop("clean", "signature")
    sinks.write_jsonl(full, f"{out}/posts_clean.jsonl")
    documents = knowledge.knowledge_posts(full).join(full.select("post_key", F.col("signature_text").isNotNull().alias("signature_removed")), "post_key")
    sinks.write_jsonl(documents, f"{out}/knowledge_posts_clean.jsonl")
    sinks.write_jsonl(signatures.signature_profiles(found), f"{out}/signature_profiles.jsonl", "signature_profile_key")
    counts = full.agg(F.count("*").alias("posts"), F.count("signature_text").alias("signatures_removed"))
    result = sinks.counters(spark, counts) | {"profiles": found.count()}
    summary = {
        "posts_scanned": result["posts"], "users_considered": authors.count(), "users_with_signature_profiles": found.select("user_key").distinct().count(), "posts_with_signature_removed": result["signatures_removed"],
        "signature_profiles_written": result["profiles"], "warnings": 0, "errors": 0,
    }
    _finish(spark, "refine", out, summary, {"run_root": run, "read_limit": read_limit} | vars(options))
    found.unpersist()
    posts.unpersist()
    return result | {"run": out}


def enrich(spark: SparkSession, run: str, read_limit: int = 0, refined: str | None = None) -> dict:
    """Users with the signatures that a refinement (the last one, if none is named) and the pages' footers tell of."""
    refined = refined or tables.latest_run(f"{run}/signature_refine")
    if refined is None:
        raise FileNotFoundError(f"{run}/signature_refine")
    out = f"{run}/user_signature_enrich/{sinks.run_id()}"
    sinks.note(spark, "enrich", "start", refined, f"{out}/audit")
    users = tables.read_jsonl(spark, f"{run}/warehouse/users.jsonl", tables.USER_SCHEMA)
    profiles = tables.read_jsonl(spark, f"{refined}/signature_profiles.jsonl", tables.PROFILE_SCHEMA)
    input_root = tables.read_manifest(run)["input_root"]
    pages = archive.read_pages(spark, input_root, ["phpbb_viewtopic"], read_limit, mode="declared_first").persist()
    full, some, added = enrichment.enrich(users, profiles, forum.phpbb_footers(archive.usable(pages)))
    some, counts = some.persist(), {r.source: r.added for r in added.collect()}  # a row for each of two sources
    sinks.write_jsonl(some, f"{out}/user_signatures.jsonl", "user_key")
    sinks.write_audit(sinks.audit_rows(pages.filter("error is not null"), "ERROR", "enrich", F.col("error"), "rel"), f"{out}/audit")
    result = {"users_with_signatures": some.count()} | counts
    read = sinks.counters(spark, pages.agg(F.count("*").alias("phpbb_files_scanned"), F.count("error").alias("errors")))
    summary = {"users_loaded": users.count(), "asp_signatures_added": counts.get(enrichment.SOURCES[0], 0), "phpbb_signatures_added": counts.get(enrichment.SOURCES[1], 0), "users_with_signatures": result["users_with_signatures"], "warnings": 0} | read
    sinks.replace_table(full, f"{run}/warehouse/users.jsonl")
    _finish(spark, "enrich", out, summary, {"run_root": run, "input_root": input_root, "signature_refine_root": refined, "read_limit": read_limit})
    some.unpersist()
    pages.unpersist()
    return result


def rebuild(spark: SparkSession, run: str) -> int:
    """The documents of posts anew."""
    rows = knowledge.knowledge_posts(tables.read_jsonl(spark, f"{run}/warehouse/posts.jsonl", tables.POST_SCHEMA))
    sinks.write_jsonl(rows, f"{run}/knowledge/knowledge_posts.jsonl")
    found = rows.count()
    sinks.note(spark, "rebuild", f"done: documents={found}", run, f"{run}/audit")
    return found


def repair_topics(spark: SparkSession, run: str, input_root: str) -> dict:
    """Topics and posts with the forums and titles that breadcrumbs tell of. Tables may be JSON lines or objects that go over lines."""
    read = {name: tables.read_objects(spark, f"{run}/warehouse/{name}.jsonl", schema) for name, schema in (("topics", tables.TOPIC_SCHEMA), ("posts", tables.POST_SCHEMA))}
    pages = archive.read_pages(spark, input_root, ["asp_topic"], mode="no_hint").select(F.col("rel").alias("path"), "html")
    patches = repair.topic_patches(read["topics"], pages).persist()
    checked = read["topics"].filter(repair.needs_repair()).count()
    result = {"topics_patched": patches.count()}
    patched_posts = read["posts"].join(patches.select("topic_key"), "topic_key", "left_semi").count()
    for name, rows in read.items():
        sinks.replace_table(repair.patched(rows, patches), f"{run}/warehouse/{name}.jsonl")
    _finish(spark, "repair", f"{run}/metadata_repair/{sinks.run_id()}", {"topics_checked": checked, **result, "posts_patched": patched_posts}, {"run_root": run, "input_root": input_root})
    patches.unpersist()
    return result


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="sedimenta")
    parser.add_argument("--master", default="local[*]")
    commands = parser.add_subparsers(dest="command", required=True)
    p = commands.add_parser("prepare")
    p.add_argument("archive_root")
    p.add_argument("out")
    p.add_argument("--sources", nargs="+", required=True, help="folders below archive_root, in the order in which they count")
    p.add_argument("--copy", action="store_true")
    p = commands.add_parser("build")
    p.add_argument("input_root")
    p.add_argument("out")
    p.add_argument("--kinds")
    p.add_argument("--read-limit", type=int, default=0)
    p.add_argument("--fixed", action="store_true", help="read accented labels and addresses too")
    p.add_argument("--progress-every", type=int, default=200, help="accepted, without effect: Spark shows progress itself")
    p = commands.add_parser("refine")
    p.add_argument("run")
    for name, kind in (("min-user-posts", int), ("min-repeats", int), ("min-coverage", float), ("strong-repeats", int), ("max-chars", int), ("per-user", int)):
        p.add_argument(f"--{name}", type=kind, default=getattr(signatures.Options, name.replace("-", "_")))
    p.add_argument("--read-limit", type=int, default=0)
    p = commands.add_parser("enrich")
    p.add_argument("run")
    p.add_argument("--refined", help="the folder of a refinement; the last one if there is none")
    p.add_argument("--read-limit", type=int, default=0)
    commands.add_parser("rebuild").add_argument("run")
    p = commands.add_parser("repair")
    p.add_argument("run")
    p.add_argument("input_root")
    args = parser.parse_args(argv)
    spark = build_session(args.master)
    if args.command == "prepare":
        print(prepare(spark, args.archive_root, args.sources, args.out, args.copy))
    elif args.command == "build":
        print(build_tables(spark, args.input_root, args.out, args.kinds, args.read_limit, not args.fixed))
    elif args.command == "refine":
        names = ("min_user_posts", "min_repeats", "min_coverage", "strong_repeats", "max_chars", "per_user")
        print(refine(spark, args.run, signatures.Options(**{n: getattr(args, n) for n in names}), args.read_limit))
    elif args.command == "enrich":
        print(enrich(spark, args.run, args.read_limit, args.refined))
    elif args.command == "rebuild":
        print(rebuild(spark, args.run))
    else:
        print(repair_topics(spark, args.run, args.input_root))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
