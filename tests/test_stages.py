"""What the stages of the command line leave besides their tables: manifests, counters, audit rows, entries of folders."""

import json
from pathlib import Path

from mini import PAGES
from pyspark.sql import functions as F

from sedimenta import cli
from sedimenta.session import BATCH_BYTES, bounded_batches
from sedimenta.sources import archive, sinks, tables


def test_prepare_leaves_a_manifest_and_all_folders(spark, tmp_path):
    root, out = tmp_path / "raw", tmp_path / "out"
    for name, body in {"one/a/b/topic.asp%3FTOPIC_ID=1": "x", "one/logo.gif": "y", "two/a/members.asp": "z"}.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(body)
    (root / "two/empty/within").mkdir(parents=True)
    found = cli.prepare(spark, str(root), ["one", "two"], str(out))
    assert (found["files_scanned"], found["files_materialized"], found["directories_scanned"]) == (3, 2, 5)
    manifest = json.loads((out / "manifest.json").read_text())
    assert [s["source_key"] for s in manifest["sources"]] == ["one", "two"] and manifest["sources"][1]["root_path"].endswith("/raw/two")
    assert manifest["summary"] == found and manifest["generated_at"] and manifest["stage"] == "prepare"
    rows = spark.read.json(f"{out}/{manifest['directories']}").collect()
    assert sorted((r.source_key, r.relative_path, r.parent_relative_path, r.status) for r in rows) == [
        ("one", "a", "", "scanned"), ("one", "a/b", "a", "scanned"), ("two", "a", "", "scanned"), ("two", "empty", "", "scanned"), ("two", "empty/within", "empty", "scanned"),
    ]
    assert spark.read.json(f"{out}/audit").filter("level = 'INFO'").count() == 2


def test_build_counts_and_warns(spark, tmp_path):
    root = tmp_path / "normalized"
    stub = "site_a/asp/page/topic/no_number.html"
    for name, html in {**{n: h for n, h in PAGES.items() if "/post/" in n or "TOPIC_ID_7.html" in n}, stub: "<p>what? no</p>", "site_a/other/x.html": "skipped"}.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(html, encoding="utf-8")
    found = cli.build_tables(spark, str(root), str(tmp_path / "runs"))
    assert (found["processed_files"], found["skipped_files"], found["topic_stubs_skipped"], found["warnings"]) == (5, 1, 1, 2)
    audit = spark.read.json(f"{found['run']}/audit")
    assert sorted((r.message, r.path) for r in audit.filter("level = 'WARNING'").collect()) == [("no id: asp_topic", stub), ("perhaps a wrong encoding: utf-8 ", stub)]
    assert tables.read_manifest(found["run"])["read_limit"] == 0


def test_tables_may_be_objects_over_lines(spark, tmp_path):
    rows = spark.createDataFrame([("t1", "asp"), ("t2", None)], "topic_key string, architecture string")
    sinks.write_concatenated(rows, f"{tmp_path}/objects")
    sinks.write_jsonl(rows, f"{tmp_path}/lines")
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty/part-0").write_text("\n")
    for name, n in (("objects", 2), ("lines", 2), ("empty", 0)):
        read = tables.read_objects(spark, f"{tmp_path}/{name}", tables.TOPIC_SCHEMA)
        assert sorted(r.topic_key for r in read.collect()) == ["t1", "t2"][:n] and "forum_id" in read.columns


def test_replace_table_may_read_what_it_replaces(spark, tmp_path):
    path = f"{tmp_path}/t.jsonl"
    sinks.write_jsonl(spark.range(3).select("id"), path)
    sinks.replace_table(spark.read.json(path).select((F.col("id") + 1).alias("id")), path)
    assert sorted(r.id for r in spark.read.json(path).collect()) == [1, 2, 3] and [p.name for p in Path(tmp_path).iterdir()] == ["t.jsonl"]


def test_decoded_pages_tell_repair_and_suspicion(spark):
    pages = spark.createDataFrame([("a", "FÃ³rum".encode()), ("b", b"why? no"), ("c", b"plain")], "rel string, content binary").selectExpr("rel", "'k' AS kind", "'d' AS domain", "rel AS ord", "content")
    rows = {r.rel: r for r in archive.decode_pages(pages, repair=True).collect()}
    assert [(rows[k].html, rows[k].repaired, rows[k].mojibake) for k in "abc"] == [("Fórum", True, False), ("why? no", False, True), ("plain", False, False)]


def test_batches_are_bounded_unless_a_smaller_bound_is_named(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        for named, bound in (("64m", str(BATCH_BYTES)), ("16k", "16k")):
            spark.conf.set(name, named)
            assert bounded_batches(spark).conf.get(name) == bound
    finally:
        spark.conf.set(name, before)
