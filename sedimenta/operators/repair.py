"""Topic titles and forums that are missing, from the breadcrumb of the page that a topic was seen on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions import text
from sedimenta.operators import forum

FIELDS = ("forum_key", "forum_id", "forum_title", "topic_title")


def breadcrumb(html: Column) -> Column:
    """struct(forum_key, forum_id, forum_title, topic_title) of a page; null without a breadcrumb, or if both titles are empty."""
    number, title, topic = (F.regexp_extract(html, forum.ASP_CRUMB, k) for k in (1, 2, 3))
    title, topic = text.html_to_line(title), text.html_to_line(topic)
    found = F.struct(F.concat(F.lit("asp:forum:"), number).alias("forum_key"), number.alias("forum_id"), title.alias("forum_title"), topic.alias("topic_title"))
    return F.when((number != "") & ((title != "") | (topic != "")), found)


def needs_repair() -> Column:
    lacks = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    return (F.col("architecture") == "asp") & (lacks("forum_id") | lacks("topic_title")) & ~lacks("first_source_file")


def topic_patches(topics: DataFrame, pages: DataFrame) -> DataFrame:
    """(topic_key, patch) for topics that need it; pages is (path, html), paths with '/' or '\\'. Missing pages give no patch."""
    lost = topics.filter(needs_repair()).select("topic_key", F.translate("first_source_file", "\\", "/").alias("path"))
    met = lost.join(pages.select(F.translate("path", "\\", "/").alias("path"), "html"), "path")
    return met.select("topic_key", breadcrumb(F.col("html")).alias("patch")).filter("patch is not null")


def patched(rows: DataFrame, patches: DataFrame, key: str = "topic_key", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """rows with the fields of their patch, empty ones too; rows without a patch as they are."""
    met = rows.join(patches.select(F.col(key), "patch"), key, "left")
    new = {f: F.when(F.col("patch").isNotNull(), F.col(f"patch.{f}")).otherwise(F.col(f)) for f in fields}
    return met.select(*(new.get(c, F.col(c)).alias(c) for c in rows.columns))
