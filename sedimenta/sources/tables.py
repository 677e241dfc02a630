"""JSON lines, concatenated JSON, run folders."""

from __future__ import annotations

import json
import posixpath
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.sources.sinks import exists, file_system

PROFILE_SCHEMA = "signature_profile_key string, user_key string, author_display string, signature_text_example string, match_count long, user_post_count long, coverage_ratio double, block_count int, heuristic string"

POST_SCHEMA = (
    "post_key string, architecture string, source_page_kind string, observed_domains array<string>, topic_key string, topic_id string, topic_title string, forum_key string, forum_id string, forum_title string,"
    " author_key string, author_display string, role_label string, role_classification string, deleted_or_guest boolean, location_raw string, posted_at string, posted_at_raw string, body_text string, links array<string>, first_source_file string, source_position int"
)
TOPIC_SCHEMA = (
    "topic_key string, architecture string, topic_id string, forum_key string, forum_id string, forum_title string, topic_title string, post_count long, unique_author_count long, author_keys array<string>, author_display_names array<string>,"
    " observed_domains array<string>, first_seen_at string, first_seen_at_raw string, last_seen_at string, last_seen_at_raw string, first_source_file string, source_page_count long"
)
USER_SCHEMA = (
    "user_key string, architecture string, user_id string, merged_identity_key string, primary_display_name string, aliases array<string>, role_labels array<string>, role_classes array<string>, locations array<string>, homepages array<string>,"
    " emails array<string>, occupations array<string>, interests array<string>, member_since string, member_since_raw string, post_count_observed long, profile_count long, observed_domains array<string>, first_seen_at string, first_seen_at_raw string,"
    " last_seen_at string, last_seen_at_raw string, first_source_file string, source_page_count long"
)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str, limit: int = 0) -> DataFrame:
    """JSON lines with a given schema; blank lines count for nothing, a broken one is an error."""
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return rows.limit(limit) if limit else rows


def objects(text: str) -> Iterator[str]:
    """The JSON values that follow one another in a text, white space between them."""
    decoder, at = json.JSONDecoder(), 0
    while True:
        while at < len(text) and text[at].isspace():
            at += 1
        if at == len(text):
            return
        value, at = decoder.raw_decode(text, at)
        yield json.dumps(value, ensure_ascii=False)


def read_concatenated(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON objects one after another, each over any number of lines. A file is read by one task, as nothing else tells where objects begin."""

    def parts(batches):
        import pyarrow as pa

        for batch in batches:
            for text in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(list(objects(text)), pa.string())], ["value"])

    values = spark.read.text(path, wholetext=True).mapInArrow(parts, "value string")
    ddl = schema if isinstance(schema, str) else schema.simpleString()
    return values.select(F.from_json("value", ddl, {"mode": "FAILFAST"}).alias("v")).select("v.*")


def read_objects(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines, or objects that go over lines; the first line that is not blank tells which."""
    first = spark.read.text(path).filter("trim(value) <> ''").first()
    try:
        lines = first is None or isinstance(json.loads(first.value), dict)
    except ValueError:
        lines = False
    return read_jsonl(spark, path, schema) if lines else read_concatenated(spark, path, schema)


def read_manifest(run_root: str) -> dict:
    return json.loads(SparkSession.active().read.text(f"{run_root}/manifest.json", wholetext=True).first().value)


def latest_run(folder: str) -> str | None:
    """The run folder that sorts last, their names being times; null if there is none."""
    spark = SparkSession.active()
    system, where = file_system(spark, folder)
    names = sorted(s.getPath().getName() for s in system.listStatus(where) if s.isDirectory()) if exists(spark, folder) else []
    return posixpath.join(folder, names[-1]) if names else None
