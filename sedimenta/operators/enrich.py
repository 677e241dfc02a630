"""Users with the signatures that were seen of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.operators import signatures

SOURCES = ("asp_repeated_suffix", "phpbb_footer_signature")


def observed_signatures(users: DataFrame, profiles: DataFrame, footers: DataFrame) -> DataFrame:
    """(user_key, signature, source) of known users: repeated endings (profiles: user_key, signature_text_example) and footers (user_key, signature)."""
    endings = profiles.select("user_key", F.col("signature_text_example").alias("signature"), F.lit(SOURCES[0]).alias("source")).filter("signature <> ''")
    both = endings.unionByName(footers.select("user_key", "signature", F.lit(SOURCES[1]).alias("source"))).distinct()
    return both.join(users.select("user_key"), "user_key", "left_semi")


def enrich(users: DataFrame, profiles: DataFrame, footers: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(users with their signatures, users who have any, (source, added) counters). What users had before is replaced."""
    seen = observed_signatures(users, profiles, footers)
    sets = signatures.signature_sets(seen)
    added = ["signatures_observed", "signature_sources", "signature_count_observed"]
    empty = F.array().cast("array<string>")
    full = users.drop(*added).join(sets, "user_key", "left").withColumns({c: F.coalesce(c, empty) for c in added[:2]} | {added[2]: F.coalesce(added[2], F.lit(0))})
    some = full.filter(F.col(added[2]) > 0).select("user_key", "architecture", "primary_display_name", "signature_count_observed", "signature_sources", "signatures_observed")
    return full, some, signatures.added_by_source(seen, SOURCES)
