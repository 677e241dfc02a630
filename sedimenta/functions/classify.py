"""Classification of archived files and pages: engines, page types, roles, names, ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sedimenta.functions import text
from sedimenta.functions.once import let

# Extensions by nature.
PAGE_EXTENSIONS = [".asp", ".php", ".aspx", ".jsp", ".cfm", ".cgi", ".pl"]
IMAGE_EXTENSIONS = [".gif", ".jpg", ".jpeg", ".png", ".webp", ".bmp", ".svg", ".ico"]
#: Further images that file types are commonly known for.
MORE_IMAGE_EXTENSIONS = [".tif", ".tiff", ".pbm", ".pgm", ".ppm", ".pnm", ".ras", ".rgb", ".xbm", ".xpm", ".xwd", ".ief", ".jpe", ".avif", ".heic", ".heif"]
SCRIPT_EXTENSIONS, STYLE_EXTENSIONS = [".js"], [".css"]
OTHER_EXTENSIONS = [".swf", ".xml", ".txt", ".json", ".woff", ".woff2", ".ttf", ".eot"]

# Page types of file names, of profile modes, and what they are worth.
ASP_PAGES = {"default.asp": "index", "forum.asp": "forum", "topic.asp": "topic", "members.asp": "members", "pop_profile.asp": "profile", "post.asp": "post"}
PHPBB_PAGES = ["index", "viewforum", "viewtopic", "memberlist", "profile", "login", "search", "faq", "groupcp", "posting"]
PROFILE_MODES = {"viewprofile": "profile", "editprofile": "profile_edit", "register": "register", "sendpassword": "password_recovery"}
HIGH_TYPES = ["topic", "viewtopic", "forum", "viewforum", "profile", "profile_edit", "memberlist", "members", "index"]
LOW_TYPES = ["login", "register", "password_recovery", "faq", "groupcp", "search", "posting"]

# Query keys of ids.
ID_KEYS = {"topic_id": ["TOPIC_ID", "t"], "forum_id": ["FORUM_ID", "f"], "post_id": ["REPLY_ID", "p", "POST_ID"], "user_id": ["id", "u", "USER_ID", "userid"], "cat_id": ["CAT_ID", "c"]}

ASSET_BUCKETS = {"asset_image": "images", "asset_script": "scripts", "asset_stylesheet": "styles", "asset_other": "other", "unknown": "unknown"}


def _map(values: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))


def extension(name: Column) -> Column:
    """The last '.ext' of a name in lower case; none for names that begin with their only dot."""
    return F.lower(F.regexp_extract(name, r"[^.](\.[^./\\]+)\z", 1))


def page_kind(relative: Column) -> Column:
    """The parser that a normalised path goes to; 'skip' for none."""
    return let(F.lower(F.translate(relative, "\\", "/")), _kind_of)


def _kind_of(path: Column) -> Column:
    has = lambda part: F.contains(path, F.lit(part))
    profile = has("/page/profile/")
    return (
        F.when(has("/page/topic/"), "asp_topic")
        .when(has("/page/post/"), "asp_post")
        .when(has("/page/viewtopic/"), "phpbb_viewtopic")
        .when(profile & has("/asp/"), "asp_profile")
        .when(profile & has("/phpbb/"), "phpbb_profile")
        .when(has("/page/members/"), "asp_members")
        .when(has("/page/memberlist/"), "phpbb_memberlist")
        .otherwise("skip")
    )


def logical_domain(path: Column) -> Column:
    """The part of a path after 'normalized'."""
    parts = F.split(F.lower(F.translate(path, "\\", "/")), "/", -1)
    at = F.array_position(parts, "normalized").cast("int")
    return F.coalesce(F.when(at > 0, F.get(parts, at)), F.lit("unknown_domain"))


def engine_and_type(base: Column, pairs: Column) -> Column:
    """struct(engine, page_type, confidence) of a file name and its query."""
    name = F.lower(base)
    asp = F.try_element_at(_map(ASP_PAGES), name)
    phpbb = F.try_element_at(_map({f"{p}.php": p for p in PHPBB_PAGES}), name)
    modes = F.filter(pairs, lambda p: (p["k"] == "mode") & F.lower(p["v"]).isin(*PROFILE_MODES))
    mode = F.when(name == "profile.php", F.try_element_at(_map(PROFILE_MODES), F.lower(F.get(modes, 0)["v"])))
    out = lambda engine, kind, confidence: F.struct(F.lit(engine).alias("engine"), kind.alias("page_type"), F.lit(confidence).alias("confidence"))
    return (
        F.when(asp.isNotNull(), out("asp", asp, "high"))
        .when(phpbb.isNotNull(), out("phpbb", F.coalesce(mode, phpbb), "high"))
        .when(name.endswith(".asp"), out("asp", F.lit("unknown_page"), "medium"))
        .when(name.endswith(".php"), out("phpbb", F.lit("unknown_page"), "medium"))
        .when(extension(name).isin(PAGE_EXTENSIONS), out("unknown", F.lit("unknown_page"), "medium"))
        .otherwise(out("unknown", F.lit("unknown"), "low"))
    )


def file_nature(base: Column) -> Column:
    ext = extension(base)
    return (
        F.when(ext.isin(PAGE_EXTENSIONS), "html_page")
        .when(ext.isin(IMAGE_EXTENSIONS), "asset_image")
        .when(ext.isin(SCRIPT_EXTENSIONS), "asset_script")
        .when(ext.isin(STYLE_EXTENSIONS), "asset_stylesheet")
        .when(ext.isin(OTHER_EXTENSIONS), "asset_other")
        .when(ext.isin(MORE_IMAGE_EXTENSIONS), "asset_image")
        .otherwise("unknown")
    )


def relevance(nature: Column, page_type: Column) -> Column:
    """struct(relevance, materialize, reason)."""
    out = lambda level, keep, why: F.struct(F.lit(level).alias("relevance"), F.lit(keep).alias("materialize"), F.lit(why).alias("reason"))
    page = nature == "html_page"
    return (
        F.when(page & page_type.isin(HIGH_TYPES), out("high", True, "relevant_page_type"))
        .when(page & page_type.isin(LOW_TYPES), out("low", False, "low_value_page_type"))
        .when(page, out("medium", True, "unknown_page_but_html_like"))
        .when(nature.startswith("asset_"), out("low", False, "asset_not_materialized_by_default"))
        .otherwise(out("unknown", False, "unknown_file_nature"))
    )


def status(confidence: Column, nature: Column, page_type: Column, materialize: Column) -> Column:
    unsure = (confidence != "high") | (nature == "unknown") | page_type.isin("unknown", "unknown_page")
    return F.when(~materialize, "inventoried_only").when(unsure, "classified_with_low_confidence").otherwise("classified")


def warning_codes(confidence: Column, engine: Column, page_type: Column, nature: Column, materialize: Column, collided: Column) -> Column:
    return F.array_compact(
        F.array(
            F.when(confidence != "high", "classification_low_confidence"),
            F.when(engine == "unknown", "engine_family_unknown"),
            F.when(page_type.isin("unknown", "unknown_page"), "page_type_unknown"),
            F.when(nature == "unknown", "file_nature_unknown"),
            F.when(~materialize, "not_materialized_by_default"),
            F.when(collided, "name_collision_detected"),
        )
    )


def role_class(label: Column, compat: bool = True) -> Column:
    """The class of a role's label. With compat only the unaccented spelling of 'Junior' is known."""
    role = text.normalize_whitespace(label)
    junior = "junior" if compat else "j[uúÚ]nior"
    like = lambda pattern: role.rlike(f"(?iu){pattern}")
    return (
        F.when(role == "", "unknown")
        .when(like(r"\Aadministrador\z"), "administrator")
        .when(like(r"\Amoderador\z"), "moderator")
        .when(like(rf"\Amoderador\s+{junior}\z"), "decorative_rank")
        .when(like(rf"estreante|{junior}|membro|veterano"), "member_rank")
        .otherwise("custom_rank")
    )


def is_guest(user_id: Column, name: Column | None = None) -> Column:
    """No user id, or a guest's name."""
    none = F.coalesce(user_id, F.lit("")) == ""
    return none if name is None else none | name.rlike(r"(?i)\A(?:visitante|guest)\z")


def detected_ids(pairs: Column) -> Column:
    """struct of sorted distinct numbers by kind of id, found by the keys of a query; they stay text."""

    def named(keys: list[str]):
        return lambda p: p["k"].isin(keys) & p["v"].rlike(r"\A[0-9]+\z")

    buckets = []
    for kind, keys in ID_KEYS.items():
        own = F.transform(F.filter(pairs, named(keys)), lambda p: p["v"])
        # By value: fewer digits first, leading zeros aside.
        ranked = F.transform(F.array_distinct(own), lambda v: F.struct(F.length(F.regexp_replace(v, r"\A0+(?=\d)", "")).alias("n"), F.regexp_replace(v, r"\A0+(?=\d)", "").alias("d"), v.alias("v")))
        buckets.append(F.transform(F.array_sort(ranked), lambda p: p["v"]).alias(kind))
    return F.struct(*buckets)


def group_key(engine: Column, page_type: Column, ids: Column) -> Column:
    """The key of the thing that a page shows; null for none."""
    first = {kind: F.get(ids[kind], 0) for kind in ID_KEYS}
    key = lambda prefix, kind: F.concat(F.lit(prefix), first[kind])
    asp, phpbb = engine == "asp", engine == "phpbb"
    return F.coalesce(
        F.when(asp & (page_type == "topic"), key("asp:topic:", "topic_id")),
        F.when(phpbb & (page_type == "viewtopic"), F.coalesce(key("phpbb:viewtopic:", "topic_id"), key("phpbb:viewtopic:post:", "post_id"))),
        F.when(asp & (page_type == "forum"), key("asp:forum:", "forum_id")),
        F.when(phpbb & (page_type == "viewforum"), key("phpbb:viewforum:", "forum_id")),
        F.when(page_type.isin("profile", "profile_edit"), F.concat(engine, F.lit(":profile:"), first["user_id"])),
    )


def preserved_name(base: Column, pairs: Column, nature: Column) -> Column:
    """struct(name, flags): the file name under which a page is kept, with its query in it."""
    parts = F.transform(pairs, lambda p: F.when(p["v"] == "empty", p["k"]).otherwise(F.concat_ws("_", p["k"], p["v"])))
    core = F.concat_ws("_", text.sanitize_path_component(base), F.when(F.size(parts) > 0, F.array_join(parts, "_")))
    core = F.regexp_replace(F.regexp_replace(core, "_+", "_"), r"\A[._]+|[._]+\z", "")
    core = F.when(core == "", "empty").otherwise(core)
    page, ext = nature == "html_page", extension(base) != ""
    yes, no = F.lit(True), F.lit(False)
    flags = F.struct(
        yes.alias("url_decoded"), yes.alias("invalid_chars_sanitized"), page.alias("extension_forced_html"), no.alias("collision_suffix_added"), yes.alias("query_preserved_order"), ext.alias("original_extension_preserved")
    )
    return F.struct(F.when(page, F.concat(core, F.lit(".html"))).otherwise(core).alias("name"), flags.alias("flags"))


def bucket_dir(source: Column, engine: Column, nature: Column, page_type: Column) -> Column:
    """The folder of a kept file."""
    safe = text.sanitize_path_component
    asset = F.coalesce(F.try_element_at(_map(ASSET_BUCKETS), nature), F.lit("unknown"))
    return F.concat_ws("/", source, safe(engine), F.when(nature == "html_page", F.concat_ws("/", F.lit("page"), safe(page_type))).otherwise(F.concat_ws("/", F.lit("asset"), asset)))


def rank_key(duplicate: Column, confidence: Column, warnings: Column, name: Column) -> Column:
    """What makes one of several captures the best: not a duplicate, sure, few warnings, first name."""
    sure = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for p in (("high", 0), ("medium", 1), ("low", 2)) for x in p)), confidence), F.lit(3))
    return F.struct(F.when(duplicate, 10).otherwise(0).alias("penalty"), sure.alias("sure"), warnings.alias("warnings"), F.coalesce(name, F.lit("")).alias("name"))
