"""Users of several platforms who go by one name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.functions import text
from sedimenta.operators.components import components
from sedimenta.session import cut_lineage

CONFIDENCE = "high_exact_alias_cross_architecture"


def alias_index(users: DataFrame) -> DataFrame:
    """(alias, user_key, architecture), a row for each user and compared form of its names; users has user_key, architecture, name (an array)."""
    named = users.select("user_key", "architecture", F.explode("names").alias("name"))
    return named.select(text.normalize_alias(F.col("name")).alias("alias"), "user_key", "architecture").filter("alias <> ''").distinct()


def shared_aliases(index: DataFrame) -> DataFrame:
    """(alias, n_users, n_architectures, first_user) of names that several users on several platforms have.

    Counted without listing the users, so that a very common name stays a few numbers for each task.
    """
    shared = index.groupBy("alias").agg(F.countDistinct("user_key").alias("n_users"), F.countDistinct("architecture").alias("n_architectures"), F.min("user_key").alias("first_user"))
    return shared.filter("n_users >= 2 and n_architectures >= 2")


def merged_keys(index: DataFrame) -> DataFrame:
    """(user_key, root): users linked through shared names, root being the smallest key. Each name is a star around its first user, not a clique."""
    links = index.join(shared_aliases(index).select("alias", "first_user"), "alias").filter("user_key <> first_user").select(F.col("first_user").alias("a"), F.col("user_key").alias("b")).distinct()
    return components(links).select(F.col("node").alias("user_key"), F.col("component").alias("root"))


def merged_identities(users: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(identities, (user_key, merged_identity_key)) of users with user_key, architecture, names (array), primary_display_name.

    An identity has at least two users and two platforms; users of one platform who share its names belong to it too.
    """
    index = cut_lineage(alias_index(users))
    roots = merged_keys(index)
    # At most the users of one identity are listed.
    members = roots.join(users.select("user_key", "architecture", "primary_display_name"), "user_key")
    aliases = roots.join(index.select("user_key", "alias"), "user_key").groupBy("root").agg(F.collect_set("alias").alias("found"))
    grouped = members.groupBy("root").agg(
        F.collect_set("user_key").alias("users"), F.collect_set("architecture").alias("kinds"), F.collect_set("primary_display_name").alias("shown")
    ).filter((F.size("users") >= 2) & (F.size("kinds") >= 2))
    key = F.concat(F.lit("merged:"), F.replace(F.col("root"), F.lit(":"), F.lit("_")))
    identities = grouped.join(aliases, "root").select(
        key.alias("merged_identity_key"),
        F.lit(CONFIDENCE).alias("confidence"),
        text.sort_values(F.col("users")).alias("user_keys"),
        text.sort_values(F.col("kinds")).alias("architectures"),
        text.sort_values(F.col("shown")).alias("primary_display_names"),
        text.sort_values(F.col("found")).alias("normalized_aliases"),
    )
    return identities, roots.join(grouped.select("root"), "root", "left_semi").select("user_key", key.alias("merged_identity_key"))
