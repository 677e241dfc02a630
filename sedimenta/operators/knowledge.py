"""Short documents for search and language models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions import text

# The headings of a document.
HEADINGS = {"topic_title": "Tópico: ", "forum_title": "Fórum: ", "author_display": "Autor: ", "posted_at": "Data: "}


def document_text(fields: dict[str, Column], body: Column) -> Column:
    """A line for each heading that has a value, an empty line, the body; stripped."""
    lines = [F.when(F.coalesce(fields[name], F.lit("")) != "", F.concat(F.lit(heading), fields[name])) for name, heading in HEADINGS.items() if name in fields]
    return text.strip(F.concat_ws("\n", *lines, F.lit(""), F.coalesce(body, F.lit(""))))


def knowledge_posts(posts: DataFrame) -> DataFrame:
    """The documents of posts."""
    shown = {name: F.coalesce(F.col(name), F.lit("")) for name in ("topic_title", "forum_title", "author_display")}
    return posts.select(
        F.col("post_key").alias("knowledge_key"),
        "post_key",
        "topic_key",
        F.col("author_key").alias("user_key"),
        "architecture",
        "source_page_kind",
        *(column.alias(name) for name, column in shown.items()),
        "posted_at",
        document_text(shown | {"posted_at": F.col("posted_at")}, F.col("body_text")).alias("text"),
        "first_source_file",
    )
