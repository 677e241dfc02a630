"""Signatures that users repeat at the end of their posts: found by counting endings, then cut off."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions import text
from sedimenta.functions.once import once
from sedimenta.session import cut_lineage


#: Users with signatures (some 200 bytes each) that are broadcast at most.
BROADCAST_USERS = 100_000


@dataclass(frozen=True)
class Options:
    """Thresholds, and how a text splits into blocks."""

    min_user_posts: int = 4
    min_repeats: int = 3
    min_coverage: float = 0.2
    strong_repeats: int = 6
    max_chars: int = 280
    per_user: int = 2
    min_chars: int = 8
    min_words: int = 2
    min_prefix: int = 12
    max_lines: int = 8
    depths: tuple[int, ...] = (1, 2, 3)
    separator: str = r"\n\s*\n+"
    joint: str = "\n\n"


def is_candidate(candidate: Column, whole: Column, options: Options = Options()) -> Column:
    """Whether an ending has the shape of a signature."""
    return _shaped(text.squeeze(candidate), F.length(text.squeeze(whole)), options)


def _shaped(c: Column, whole_size: Column, options: Options) -> Column:
    """The same of a squeezed ending and the squeezed length of the whole text."""
    words = F.filter(F.split(text.collapse(c), " ", -1), lambda x: x != "")
    return (
        F.length(c).between(options.min_chars, options.max_chars)
        & (F.size(words) >= options.min_words)
        & (whole_size - F.length(c) >= options.min_prefix)
        & (F.regexp_count(c, F.lit("\n")) + 1 <= options.max_lines)
        & ~c.rlike(r"\A[-_=~. ]+\z")
    )


def endings(posts: DataFrame, options: Options = Options()) -> DataFrame:
    """posts with n_blocks and an array 'endings' of struct(depth, raw, squeezed), the last blocks of texts that have more; posts has a column body.

    squeezed is null for endings that are too long for a signature whatever white space they have.
    """
    blocks = text.split_blocks(F.col("body"), options.separator)
    # Texts are split once, and not again for the filters on what they are split into.
    posts = once(posts, {"blocks": blocks}).withColumn("n_blocks", F.size("blocks"))
    raws = [F.when(F.col("n_blocks") > n, F.struct(F.lit(n).alias("depth"), text.join_blocks(F.slice("blocks", -n, n), options.joint).alias("raw"))) for n in options.depths]
    posts = posts.withColumn("raws", F.array_compact(F.array(*raws)))
    short = lambda raw: F.length(F.translate(raw, " \t\n\r\xa0", "")) <= options.max_chars
    squeezed = lambda e: F.struct(e["depth"].alias("depth"), e["raw"].alias("raw"), F.when(short(e["raw"]), text.squeeze(e["raw"])).alias("squeezed"))
    return posts.withColumn("endings", F.transform("raws", squeezed)).drop("raws")


def candidates(posts: DataFrame, options: Options = Options()) -> tuple[DataFrame, DataFrame]:
    """(candidates (user_key, normalized, count, depth, raw, first_at), users (user_key, user_posts, author_display)).

    posts has user_key, body, author_display and ord, the order in which posts count; only posts with two blocks do.
    """
    told = endings(posts.filter("user_key is not null and user_key <> ''"), options).filter("n_blocks >= 2")
    users = told.groupBy("user_key").agg(F.count("*").alias("user_posts"), F.max(F.when(F.col("author_display") != "", F.struct("ord", "author_display")))["author_display"].alias("author_display"))
    # An inner explode would have the endings made again, to ask whether there are any.
    # The text is measured once, and stays behind: only endings go on, and of those only what can be a signature.
    each = told.select("user_key", "ord", F.length(text.squeeze(F.col("body"))).alias("whole_size"), F.explode_outer("endings").alias("e")).filter(F.col("e.squeezed").isNotNull() & _shaped(F.col("e.squeezed"), F.col("whole_size"), options))
    each = each.withColumn("normalized", text.normalize_signature(F.col("e.raw")))
    each = once(each, {"normalized": F.col("normalized")}).filter("normalized <> ''")
    first = F.min(F.struct("ord", F.col("e.depth").alias("depth"), F.col("e.raw").alias("raw")))
    counted = each.groupBy("user_key", "normalized").agg(F.count("*").alias("count"), first.alias("f"))
    return counted.select("user_key", "normalized", "count", F.col("f.depth").alias("depth"), F.col("f.raw").alias("raw"), F.struct(F.col("f.ord").alias("o"), F.col("f.depth").alias("d")).alias("first_at")), users


def profiles(counted: DataFrame, users: DataFrame, options: Options = Options()) -> DataFrame:
    """(user_key, rank, normalized, depth, raw, count, user_posts, author_display, coverage): the endings that are taken for signatures.

    Frequent enough ones by (count, length, depth); one that holds, or is held by, one taken before is passed over;
    per_user at most. A user has at most user_posts / min_repeats candidates left here.
    """
    share = F.col("count") / F.col("user_posts")
    able = counted.filter(F.col("count") >= options.min_repeats).join(users, "user_key").filter(F.col("user_posts") >= options.min_user_posts)
    able = able.filter((share >= options.min_coverage) | (F.col("count") >= options.strong_repeats))
    item = F.struct((-F.col("count")).alias("a"), (-F.length("raw")).alias("b"), F.col("depth").alias("c"), F.col("first_at").alias("d"), "normalized", "raw", "count", "depth")
    ranked = able.groupBy("user_key", "user_posts", "author_display").agg(F.array_sort(F.collect_list(item)).alias("items"))
    kind = ranked.schema["items"].dataType.simpleString()

    def take(kept: Column, x: Column) -> Column:
        clash = F.exists(kept, lambda k: F.contains(k["normalized"], x["normalized"]) | F.contains(x["normalized"], k["normalized"]))
        return F.when((F.size(kept) >= options.per_user) | clash, kept).otherwise(F.concat(kept, F.array(x)))

    chosen = ranked.withColumn("chosen", F.aggregate("items", F.array().cast(kind), take))
    chosen = chosen.select("user_key", "user_posts", "author_display", F.posexplode("chosen").alias("at", "x"))
    return chosen.select(
        "user_key", (F.col("at") + 1).alias("rank"), "x.normalized", "x.depth", "x.raw", "x.count", "user_posts", "author_display", text.ratio(F.col("x.count"), F.col("user_posts")).alias("coverage")
    )


def strip_signatures(posts: DataFrame, found: DataFrame, key: str = "post_key", options: Options = Options()) -> DataFrame:
    """(key, body, clean, signature): the text of each post without its user's signature; signature is null where none is at its end.

    The ending must equal a signature in compared form and leave something before it; deeper, longer, more frequent
    signatures go first. A post meets the few signatures of its user, as digests; no text but the post's own is moved,
    and that only if the signatures are too many to be sent to all executors (BROADCAST_USERS).
    """
    item = F.struct("depth", F.length("raw").alias("size"), "count", F.md5("normalized").alias("digest"))
    known = cut_lineage(found.groupBy("user_key").agg(F.collect_list(item).alias("known")))
    known = F.broadcast(known) if known.count() <= BROADCAST_USERS else known
    told = posts.select(F.col(key).alias("_key"), "user_key", "body").join(known, "user_key", "left")
    able = F.col("known").isNotNull()
    told = told.withColumn("blocks", F.when(able, text.split_blocks(F.col("body"), options.separator))).withColumn("n_blocks", F.size("blocks"))

    # Only where a user has a signature of that many blocks is an ending put together and compared.
    for n in options.depths:
        raw = text.join_blocks(F.slice("blocks", -n, n), options.joint)
        told = told.withColumn(f"_raw_{n}", F.when(able & (F.col("n_blocks") > n) & F.array_contains(F.col("known.depth"), n), raw))
    for n in options.depths:
        told = told.withColumn(f"_digest_{n}", F.when(F.col(f"_raw_{n}").isNotNull(), F.md5(text.normalize_signature(F.col(f"_raw_{n}")))))

    def match(n: int) -> Column:
        same = F.filter("known", lambda k: (k["depth"] == n) & (k["digest"] == F.col(f"_digest_{n}")))
        return F.array_max(F.transform(same, lambda k: F.struct(k["depth"].alias("depth"), k["size"].alias("size"), k["count"].alias("count"))))

    told = told.withColumn("depth", F.array_max(F.array(*(match(n) for n in options.depths)))["depth"])
    clean = text.join_blocks(F.slice("blocks", F.lit(1), F.col("n_blocks") - F.col("depth")), options.joint)
    signature = text.join_blocks(F.slice("blocks", -F.col("depth"), F.col("depth")), options.joint)
    cut = F.col("depth").isNotNull()
    return told.select(F.col("_key").alias(key), "body", F.when(cut, clean).otherwise(F.col("body")).alias("clean"), F.when(cut, signature).alias("signature"))


def signature_profiles(found: DataFrame) -> DataFrame:
    """The published form of profiles()."""
    return found.select(
        F.concat_ws(":", "user_key", F.lit("sig"), "rank").alias("signature_profile_key"),
        "user_key",
        "author_display",
        F.col("raw").alias("signature_text_example"),
        F.col("count").alias("match_count"),
        F.col("user_posts").alias("user_post_count"),
        F.col("coverage").alias("coverage_ratio"),
        F.col("depth").alias("block_count"),
        F.lit("repeated_suffix_blocks").alias("heuristic"),
    )


def signature_sets(observed: DataFrame) -> DataFrame:
    """(user_key, signatures_observed, signature_sources, signature_count_observed) of (user_key, signature, source)."""
    sets = observed.groupBy("user_key").agg(F.collect_set("signature").alias("s"), F.collect_set("source").alias("f"))
    return sets.select("user_key", text.sort_values(F.col("s")).alias("signatures_observed"), text.sort_values(F.col("f")).alias("signature_sources"), F.size("s").alias("signature_count_observed"))


def added_by_source(observed: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """(source, added): signatures that a source was the first to tell of, sources taken in order."""
    rank = F.array_position(F.array(*(F.lit(s) for s in order)), F.col("source"))
    first = observed.groupBy("user_key", "signature").agg(F.min_by("source", rank).alias("source"))
    return first.groupBy("source").agg(F.count("*").alias("added"))
