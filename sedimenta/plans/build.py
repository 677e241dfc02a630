"""From normalised pages to the tables of the warehouse: posts, topics, users, salvage, identities, documents."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.functions import classify, text
from sedimenta.functions.once import once
from sedimenta.operators import forum, identity, knowledge
from sedimenta.operators.reduce import first_filled, first_wins, last_filled, with_date_bounds, with_running_last
from sedimenta.session import cut_lineage


@dataclass
class Warehouse:
    posts: DataFrame
    topics: DataFrame
    users: DataFrame
    post_salvage: DataFrame
    merged_identities: DataFrame
    knowledge_posts: DataFrame
    #: Keys of topics that no post is known of, and (rel, kind) of pages whose kind needs an id that they haven't got.
    topic_stubs: DataFrame
    nameless: DataFrame


#: Kinds of pages that go if they name no topic or user.
NAMED = ("asp_topic", "asp_post", "phpbb_viewtopic", "asp_profile", "phpbb_profile")


def build(pages: DataFrame, compat: bool = True) -> Warehouse:
    """All tables of pages (rel, kind, domain, ord, html). With compat, fields that the archive's own labels never reach stay empty."""
    asp, phpbb, quotes = forum.asp_topic_pages(pages), forum.phpbb_topic_pages(pages), forum.asp_quote_pages(pages)
    seen_topics = reduce(DataFrame.unionByName, [t.select(forum.TOPIC_COLUMNS) for t in (asp, phpbb, quotes)])
    seen_posts = forum.asp_posts(asp).unionByName(forum.phpbb_posts(phpbb))
    # Written once: six tables are made of them, and pages are parsed no more.
    seen_topics, seen_posts = cut_lineage(seen_topics), cut_lineage(seen_posts)
    running = running_titles(seen_topics)

    posts = warehouse_posts(seen_posts, running)
    topics = warehouse_topics(seen_topics, seen_posts)
    profiles = [forum.asp_profiles(pages, compat), forum.phpbb_profiles(pages, compat)]
    sightings = [forum.post_authors(seen_posts), *profiles, forum.asp_members(pages), forum.phpbb_members(pages)]
    users, identities = warehouse_users(reduce(DataFrame.unionByName, sightings), compat)
    stubs = seen_topics.select("topic_key").distinct().join(seen_posts.select("topic_key"), "topic_key", "left_anti")
    named = reduce(DataFrame.unionByName, [p.select("rel") for p in (seen_topics, *profiles)])
    nameless = pages.filter(F.col("kind").isin(*NAMED)).select("rel", "kind").join(named, "rel", "left_anti")
    return Warehouse(posts, topics, users, salvage(quotes, running, posts, users), identities, knowledge.knowledge_posts(posts), stubs, nameless)


def running_titles(seen: DataFrame) -> DataFrame:
    """(rel, now_forum_id, now_forum_title, now_topic_title): what is known of a page's topic when that page has been read."""
    names = ("forum_id", "forum_title", "topic_title")
    told = with_running_last(seen.select("rel", "topic_key", "ord", *names), {f"now_{c}": c for c in names}, ["topic_key"], ["ord"])
    return told.select("rel", *(F.coalesce(f"now_{c}", F.lit("")).alias(f"now_{c}") for c in names))


def _forum(forum_id: str, architecture: str = "architecture"):
    filled = F.col(forum_id) != ""
    return F.when(filled, F.concat_ws(":", architecture, F.lit("forum"), forum_id)).alias("forum_key"), F.when(filled, F.col(forum_id)).alias("forum_id")


def warehouse_posts(seen: DataFrame, running: DataFrame) -> DataFrame:
    """The first sighting of each post, with its topic as it was known on that page."""
    first = first_wins(seen, "post_key", ["ord", "pos"]).join(running, "rel", "left")
    return first.select(
        "post_key", "architecture", "source_page_kind", F.array("domain").alias("observed_domains"), "topic_key", "topic_id", F.col("now_topic_title").alias("topic_title"), *_forum("now_forum_id"),
        F.col("now_forum_title").alias("forum_title"), "author_key", "author_display", "role_label", classify.role_class(F.col("role_label")).alias("role_classification"), "deleted_or_guest",
        "location_raw", F.col("posted.iso").alias("posted_at"), F.col("posted.raw").alias("posted_at_raw"), "body_text", "links", F.col("rel").alias("first_source_file"), F.col("pos").cast("int").alias("source_position"),
    )


def warehouse_topics(seen: DataFrame, posts: DataFrame) -> DataFrame:
    """Topics with posts. Counts are of sightings, repeated posts too."""
    order = F.col("ord")
    pages = seen.groupBy("topic_key", "architecture", "topic_id").agg(
        *(F.coalesce(last_filled(F.col(c), order), F.lit("")).alias(c) for c in ("forum_id", "forum_title", "topic_title")),
        F.collect_set("domain").alias("domains"),
        F.min_by("rel", "ord").alias("first_source_file"),
        F.count("*").alias("source_page_count"),
    )
    told = posts.groupBy("topic_key").agg(
        F.count("*").alias("post_count"), F.collect_set("author_key").alias("keys"), F.collect_set("author_display").alias("names")
    )
    timed = posts.select("topic_key", F.struct("ord", "pos").alias("at"), F.col("posted.iso").alias("iso"), F.col("posted.raw").alias("raw"))
    out = pages.join(told, "topic_key").join(with_date_bounds(timed, "topic_key", "iso", "raw", "at"), "topic_key", "left")
    return out.select(
        "topic_key", "architecture", "topic_id", *_forum("forum_id"), "forum_title", "topic_title", "post_count", F.size("keys").cast("long").alias("unique_author_count"),
        text.sort_values(F.col("keys")).alias("author_keys"), text.sort_values(F.col("names")).alias("author_display_names"), text.sort_values(F.col("domains")).alias("observed_domains"),
        "first_seen_at", "first_seen_at_raw", "last_seen_at", "last_seen_at_raw", "first_source_file", "source_page_count",
    )


def warehouse_users(seen: DataFrame, compat: bool = True) -> tuple[DataFrame, DataFrame]:
    """(users, merged identities)."""
    clean = seen.withColumn("at", F.struct("ord", "pos")).withColumn("name", text.display_name(F.col("name"))).withColumn("role", text.normalize_whitespace(F.col("role")))
    for c in ("location", "homepage", "occupation", "interests"):
        clean = clean.withColumn(c, text.normalize_whitespace(F.col(c)))
    clean = clean.withColumn("role_class", F.when(F.col("role") != "", classify.role_class(F.col("role"), compat)))
    sets = {"aliases": "name", "role_labels": "role", "role_classes": "role_class", "locations": "location", "homepages": "homepage", "occupations": "occupation", "interests_": "interests", "observed_domains": "domain"}
    member = F.min(F.when(F.col("member_since.iso").isNotNull(), F.struct(F.col("member_since.iso").alias("iso"), "at", F.col("member_since.raw").alias("raw"))))
    users = clean.groupBy("user_key", "architecture", "user_id").agg(
        first_filled(F.col("name"), F.col("at")).alias("primary_display_name"),
        *(F.collect_set(F.nullif(F.col(c), F.lit(""))).alias(k) for k, c in sets.items()),
        F.array_distinct(F.flatten(F.collect_set("emails"))).alias("emails"),
        member.alias("m"),
        F.max("post_count").alias("post_count_observed"),
        F.count_if("is_profile").alias("profile_count"),
        F.min_by("rel", "at").alias("first_source_file"),
        F.count("*").alias("source_page_count"),
    )
    timed = clean.select("user_key", "at", F.col("observed.iso").alias("iso"), F.col("observed.raw").alias("raw"))
    users = users.join(with_date_bounds(timed, "user_key", "iso", "raw", "at"), "user_key", "left")
    # Written once: identities read users several times, and each time pages would be parsed anew.
    users = cut_lineage(users)
    identities, merged = identity.merged_identities(users.select("user_key", "architecture", F.col("aliases").alias("names"), "primary_display_name"))
    listed = lambda c, name: text.sort_values(F.col(c)).alias(name)
    out = users.join(merged, "user_key", "left").select(
        "user_key", "architecture", "user_id", "merged_identity_key", "primary_display_name", *(listed(c, c.rstrip("_")) for c in ("aliases", "role_labels", "role_classes", "locations", "homepages", "emails", "occupations", "interests_")),
        F.col("m.iso").alias("member_since"), F.col("m.raw").alias("member_since_raw"), "post_count_observed", "profile_count", listed("observed_domains", "observed_domains"),
        "first_seen_at", "first_seen_at_raw", "last_seen_at", "last_seen_at_raw", "first_source_file", "source_page_count",
    )
    return out, identities


def salvage(quotes: DataFrame, running: DataFrame, posts: DataFrame, users: DataFrame) -> DataFrame:
    """Quoted texts that are not the text of the post that they quote; authors get the name that is known of them."""
    rows = once(quotes.drop("html", "fields"), {"body_text": F.col("body_text")}).filter("body_text <> ''").join(running, "rel", "left")
    rows = rows.withColumn("salvage_key", F.concat(F.lit("salvage:"), F.sha1(F.encode(F.concat_ws("|", "rel", "body_text"), "UTF-8"))))
    rows = first_wins(rows, "salvage_key", ["ord"])
    rows = rows.withColumn("candidate_post_key", F.when(F.col("reply_id") != "", F.concat(F.lit("asp:post:"), "reply_id"))).withColumn("author_key", F.when(F.col("author_id") != "", F.concat(F.lit("asp:user:"), "author_id")))
    rows = rows.withColumn("compared", text.normalize_whitespace(F.col("body_text")))
    # Post bodies are normalised when registered, and once more when compared.
    known = posts.select(F.col("post_key").alias("candidate_post_key"), text.normalize_whitespace(text.normalize_whitespace(F.col("body_text"))).alias("compared"))
    known = once(known, {"compared": F.col("compared")}).filter("compared <> ''")
    rows = rows.join(known, ["candidate_post_key", "compared"], "left_anti")
    rows = rows.join(users.select(F.col("user_key").alias("author_key"), F.col("primary_display_name").alias("author_display")), "author_key", "left")
    return rows.select(
        "salvage_key", "candidate_post_key", "architecture", F.lit("post_quote_salvage").alias("source_page_kind"), "topic_key", "topic_id", F.col("now_topic_title").alias("topic_title"),
        *_forum("now_forum_id"), F.col("now_forum_title").alias("forum_title"), "author_key", "author_display", "body_text", F.array().cast("array<string>").alias("links"), F.col("rel").alias("first_source_file"),
    )
