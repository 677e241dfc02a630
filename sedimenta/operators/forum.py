"""Forum pages to observations: of topics (one for each page), of posts and of users (one for each row that tells of one).

Pages are rows (rel, kind, domain, ord, html), ord being sortable in the order in which pages count. Everything is an
expression over the page; row-like parts are found by one pattern and exploded with their place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions import classify, dates, text, udfs
from sedimenta.functions.once import let, once

# The patterns of rows and fields of the two kinds of forum.
ASP_ROW = r'(?is)<tr>\s*<td\b[^>]*bgcolor="?(?:F8F8F8|white)"?[^>]*>(.*?)</td>\s*<td\b[^>]*colspan="2"[^>]*>(.*?)</td>\s*</tr>'
PHPBB_ROW = (
    r'(?is)<tr>\s*<td\b[^>]*rowspan="2"[^>]*>(.*?)</td>\s*<td\b[^>]*valign="top"[^>]*>(.*?)</td>\s*</tr>\s*'
    r'<tr>\s*<td\b(?=[^>]*valign="bottom")(?=[^>]*nowrap="nowrap")(?=[^>]*class="row[12]")[^>]*>(.*?)</td>\s*</tr>'
)
ASP_MEMBER = (
    r"(?is)<tr>\s*<td[^>]*>.*?pop_profile\.asp\?mode=display&id=(\d+).*?</td>\s*<td[^>]*>.*?<a href=\"pop_profile\.asp\?mode=display&id=\d+\">(.*?)</a>.*?</td>"
    r"\s*<td[^>]*>(.*?)</td>\s*<td[^>]*>(.*?)</td>\s*<td[^>]*>(.*?)</td>\s*<td[^>]*>(.*?)</td>\s*<td[^>]*>(.*?)</td>"
)
PHPBB_MEMBER = (
    r'(?is)<tr>\s*<td[^>]*class="(?:row1|row2)"[^>]*>\s*<span class="name"><a href="profile\.php\?mode=viewprofile(?:&amp;|&)u=(\d+)">(.*?)</a></span>'
    r'.*?<td[^>]*class="(?:row1|row2)"[^>]*>(.*?)</td>.*?<td[^>]*class="(?:row1|row2)"[^>]*>(.*?)</td>.*?<td[^>]*class="(?:row1|row2)"[^>]*>(.*?)</td>'
)
ASP_REPLY = r"(?i)post\.asp\?method=Reply[^\"]*TOPIC_ID=(\d+)&FORUM_ID=(\d+)(?:&CAT_ID=(\d+))?(?:&Forum_Title=([^\"&]+))?(?:&Topic_Title=([^\"&]+))?"
ASP_CRUMB = r'(?is)<a[^>]+class="linkstopo"[^>]+href="FORUM\.asp\?FORUM_ID=(\d+)"[^>]*>(.*?)</a>\s*&nbsp;>\s*&nbsp;(.*?)(?:<!--|</font>)'
HIDDEN = r'(?is)<input\s+name="([^"]+)"\s+type="hidden"\s+value="([^"]*)">'
PHPBB_USER = r"(?i)profile\.php\?mode=viewprofile(?:&amp;|&)u=(\d+)"
PHPBB_FOOTER = r'(?is)<td[^>]*height="40"[^>]*class="genmed"[^>]*>(.*?)</td>'
PHPBB_CRUMB = r'(?is)<td width="100%" class="nav"><a href="index\.php[^\"]*">.*?</a>\s*&gt;\s*<a href="viewforum\.php\?f=\d+[^\"]*">(.*?)</a>'
PHPBB_TITLE = r'(?is)<td class="maintitle"[^>]*>(.*?)</td>'
PHPBB_TOPIC = r"(?i)viewtopic\.php\?t=(\d+)"
PHPBB_FORUM = r"(?i)viewforum\.php\?f=(\d+)"
PHPBB_POST = r"(?i)viewtopic\.php\?p=(\d+)"
QUOTED = r'(?is)<textarea[^>]*name="?(?:Message|message)"?[^>]*>(.*?)</textarea>'
QUOTE_FORUM = r"Forum_Title_([^_].*?)_M(?:_|\.|$)"
QUOTE_TOPIC = r"Topic_Title_([^_].*?)_method"
ASP_SMALL = r"(?is)<small>(.*?)</small>"
ASP_RULE = r"(?is)<hr[^>]*>\s*(.*)\z"
ASP_TOP = r'(?is)<a href="#top".*\z'
ASP_POST = r'(?is)<a name="(\d+)"></a>'
ASP_USER = r"(?i)pop_profile\.asp\?mode=display&id=(\d+)"
ASP_POSTED = r"(?is)Enviado em\s*(.*?)</font>"
PHPBB_POSTED = r"(?is)Enviada:\s*(.*?)</td>"
PHPBB_DETAILS = r'(?is)<span class="postdetails">(.*?)</span>'
PHPBB_BODY = r'(?is)<td[^>]*class="postbody"[^>]*>'
PHPBB_COUNT = r"(?i)Mensagens:\s*(\d+)"
PHPBB_NAME = r'(?is)<th[^>]*colspan="2"[^>]*>(.*?)</th>'
GUEST = "Visitante"

POST_COLUMNS = ["post_key", "architecture", "source_page_kind", "topic_key", "topic_id", "user_id", "author_key", "author_display", "role_label", "location_raw", "message_count", "posted", "body_text", "links", "deleted_or_guest", "domain", "rel", "ord", "pos"]
TOPIC_COLUMNS = ["topic_key", "architecture", "topic_id", "forum_id", "forum_title", "topic_title", "domain", "rel", "ord"]
USER_COLUMNS = ["user_key", "architecture", "user_id", "name", "role", "location", "homepage", "occupation", "interests", "member_since", "observed", "post_count", "is_profile", "emails", "domain", "rel", "ord", "pos"]


def _get(value: Column, pattern: str, k: int = 1) -> Column:
    return F.regexp_extract(value, pattern, k)


def _first(*values: Column) -> Column:
    """The first value that is not empty; empty if none is not."""
    return F.coalesce(*(F.nullif(v, F.lit("")) for v in values), F.lit(""))


def url_decode(value: Column) -> Column:
    return text.normalize_whitespace(udfs.url_decode(F.coalesce(value, F.lit(""))))


def _rows(pages: DataFrame, pattern: str, groups: int) -> DataFrame:
    """pages without html and with pos and g1, g2 ... of each match."""
    rows = pages.select(*(c for c in pages.columns if c != "html"), F.posexplode(F.regexp_extract_all("html", F.lit(pattern), F.lit(0))).alias("pos", "row"))
    rows = once(rows, {"g": _groups(F.col("row"), pattern, groups)})
    return rows.select(*(c for c in rows.columns if c not in ("row", "g")), *(F.get("g", k - 1).alias(f"g{k}") for k in range(1, groups + 1)))


def _groups(row: Column, pattern: str, count: int) -> Column:
    """The groups of a row, which is one match of pattern. It is matched once for all of them where no character of the text can be taken for the mark between them."""
    marked = F.split(F.regexp_replace(row, pattern, "\x01".join(f"${k}" for k in range(1, count + 1))), "\x01", -1)
    return F.when(F.contains(row, F.lit("\x01")), F.array(*(_get(row, pattern, k) for k in range(1, count + 1)))).otherwise(marked)


def balanced(html: Column, start: str, tag: str) -> Column:
    """What stands between the first match of start, which opens tag, and the end tag that closes it; empty if none does."""
    token = rf"(?is)</?{tag}\b[^>]*>"
    begin = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("seen"))

    def step(acc: Column, t: Column) -> Column:
        """Depth and number of tags, up to the one that closes."""
        depth = F.when(acc["depth"] == 0, 0).when(t.startswith("</"), acc["depth"] - 1).otherwise(acc["depth"] + 1)
        return F.struct(depth.alias("depth"), (acc["seen"] + F.when(acc["depth"] == 0, 0).otherwise(1)).alias("seen"))

    def until(x: Column, end: Column) -> Column:
        before = F.zip_with(F.slice(x["parts"], 1, end - 1), F.slice(x["tokens"], 1, end - 1), lambda p, t: F.concat(p, t))
        return F.concat(F.array_join(before, ""), F.get(x["parts"], end - 1))

    def inner(x: Column) -> Column:
        # Null where nothing closes.
        closing = F.aggregate(x["tokens"], begin, step, lambda acc: F.when(acc["depth"] == 0, acc["seen"]))
        return let(closing, lambda end: F.when(end.isNotNull(), until(x, end)))

    # Tags and what stands between them are taken once, not for each tag.
    cut = lambda rest: F.struct(F.regexp_extract_all(rest, F.lit(token), F.lit(0)).alias("tokens"), F.split(rest, token, -1).alias("parts"))
    return F.coalesce(let(let(F.get(F.split(html, start, 2), 1), cut), inner), F.lit(""))


# ---- topics and posts


def asp_topic_pages(pages: DataFrame) -> DataFrame:
    """Pages of ASP topics with the topic that they show; pages without a topic id go."""
    html, rel = F.col("html"), F.col("rel")
    reply = lambda k: _get(html, ASP_REPLY, k)
    crumb = lambda k: _get(html, ASP_CRUMB, k)
    line = lambda v: text.normalize_whitespace(text.html_to_text(v))
    shown = once(pages.filter("kind = 'asp_topic'"), {"topic_id": _first(text.first_group(rel, r"TOPIC_ID_(\d+)"), reply(1))}).filter("topic_id <> ''").withColumns(
        {
            "forum_id": _first(text.first_group(rel, r"FORUM_ID_(\d+)"), reply(2), crumb(1)),
            "forum_title": _first(url_decode(reply(4)), line(crumb(2))),
            "topic_title": _first(url_decode(reply(5)), line(crumb(3))),
        }
    )
    return shown.withColumn("architecture", F.lit("asp")).withColumn("topic_key", F.concat(F.lit("asp:topic:"), "topic_id"))


def phpbb_topic_pages(pages: DataFrame) -> DataFrame:
    html = F.col("html")
    shown = once(pages.filter("kind = 'phpbb_viewtopic'"), {"topic_id": _first(_get(html, PHPBB_TOPIC), text.first_group(F.col("rel"), r"viewtopic\.php_t_(\d+)"))})
    shown = shown.filter("topic_id <> ''").withColumns(
        {
            "forum_id": _get(html, PHPBB_FORUM),
            "forum_title": text.html_to_text(_get(html, PHPBB_CRUMB)),
            "topic_title": text.html_to_text(_get(html, PHPBB_TITLE)),
        }
    )
    return shown.withColumn("architecture", F.lit("phpbb")).withColumn("topic_key", F.concat(F.lit("phpbb:topic:"), "topic_id"))


def asp_quote_pages(pages: DataFrame) -> DataFrame:
    """Pages on which a post is quoted, with the topic, the post and the author that hidden fields tell of, and the quoted text."""
    html, rel = F.col("html"), F.col("rel")
    pairs = F.transform(F.regexp_extract_all(html, F.lit(HIDDEN), F.lit(0)), lambda m: F.struct(F.upper(_get(m, HIDDEN, 1)).alias("k"), _get(m, HIDDEN, 2).alias("v")))
    field = lambda name: F.coalesce(F.get(F.filter("fields", lambda p: (p["k"] == name) & (p["v"] != "")), 0)["v"], F.lit(""))
    path = lambda pattern: text.first_group(rel, pattern)
    shown = once(pages.filter("kind = 'asp_post'"), {"fields": pairs, "quoted": _get(html, QUOTED)})
    shown = once(shown, {"topic_id": _first(path(r"TOPIC_ID_(\d+)"), field("TOPIC_ID"))}).filter("topic_id <> ''").withColumns(
        {
            "reply_id": _first(path(r"REPLY_ID_(\d+)"), field("REPLY_ID")),
            "forum_id": _first(path(r"FORUM_ID_(\d+)"), field("FORUM_ID")),
            "forum_title": _first(text.normalize_whitespace(field("FORUM_TITLE")), url_decode(path(QUOTE_FORUM))),
            "topic_title": _first(text.normalize_whitespace(field("TOPIC_TITLE")), url_decode(path(QUOTE_TOPIC))),
            "author_id": field("AUTHOR"),
            "body_text": text.markup_to_text(F.col("quoted")),
        }
    )
    return shown.drop("quoted").withColumn("architecture", F.lit("asp")).withColumn("topic_key", F.concat(F.lit("asp:topic:"), "topic_id"))


def asp_posts(topic_pages: DataFrame) -> DataFrame:
    rows = _rows(topic_pages, ASP_ROW, 2).withColumnsRenamed({"g1": "author", "g2": "message"})
    author, message = F.col("author"), F.col("message")
    small = lambda k: text.html_to_text(F.coalesce(F.get(F.regexp_extract_all(author, F.lit(ASP_SMALL), F.lit(1)), k), F.lit("")))
    body = F.regexp_replace(F.when(message.rlike(ASP_RULE), _get(message, ASP_RULE)).otherwise(message), ASP_TOP, "")
    named = r"(?is)<b>(.*?)</a>"
    rows = once(rows, {"post_id": _get(message, ASP_POST), "user_id": _get(author, ASP_USER)}).filter("post_id <> ''")
    rows = _with_text(once(rows, {"body": body}), F.col("body"))
    out = rows.withColumns(
        {
            "author_display": F.when(author.rlike(named), text.html_to_text(_get(author, named))).otherwise(GUEST),
            "role_label": small(0),
            "location_raw": small(1),
            "message_count": text.first_int(small(2)),
            "posted": dates.parse_date(_get(message, ASP_POSTED)),
            "links": text.links(F.col("body")),
            "source_page_kind": F.lit("topic"),
        }
    )
    return _finished(out, "asp").withColumn("deleted_or_guest", classify.is_guest(F.col("user_id"))).select(POST_COLUMNS)


def author_details(cell: Column) -> tuple[Column, Column]:
    """(role, place) of an author's cell: the first line that is neither a number of messages nor a place, and the place."""
    lines = F.filter(F.transform(F.split(text.html_to_text(_get(cell, PHPBB_DETAILS)), "\n", -1), text.strip), lambda x: x != "")
    lines = F.filter(lines, lambda x: ~x.rlike(r"(?i)\Amensagens:\s*\d+\s*\z"))
    place = r"(?i)\Alocaliza\S*:\s*(.+)\z"
    role = F.coalesce(F.get(F.filter(lines, lambda x: ~x.rlike(place)), 0), F.lit(""))
    told = F.coalesce(F.element_at(F.concat(F.array(F.lit("")), F.transform(F.filter(lines, lambda x: x.rlike(place)), lambda x: _get(x, place))), -1), F.lit(""))
    return text.normalize_whitespace(role), _first(text.normalize_whitespace(told), text.normalize_whitespace(_get(cell, r"(?i)Localiza\S*:\s*([^<]+)")))


def phpbb_posts(topic_pages: DataFrame) -> DataFrame:
    rows = _rows(topic_pages, PHPBB_ROW, 3).withColumnsRenamed({"g1": "author", "g2": "message", "g3": "footer"})
    author, message = F.col("author"), F.col("message")
    role, place = author_details(author)
    named = r"(?is)<strong>(.*?)</strong>"
    rows = once(rows, {"post_id": _first(_get(message, PHPBB_POST), text.first_group(F.col("rel"), r"viewtopic\.php_p_(\d+)")), "user_id": _get(F.col("footer"), PHPBB_USER)})
    rows = once(rows.filter("post_id <> ''"), {"body_html": F.regexp_replace(balanced(message, PHPBB_BODY, "td"), r"(?is)\A\s*<hr\s*/?>", "")})
    out = _with_text(rows, F.col("body_html")).withColumns(
        {
            "author_display": F.when(author.rlike(named), text.html_to_text(_get(author, named))).otherwise(GUEST),
            "role_label": role,
            "location_raw": place,
            "message_count": text.first_int(_get(author, PHPBB_COUNT)),
            "posted": dates.parse_date(_get(message, PHPBB_POSTED)),
            "links": text.links(F.col("body_html")),
            "source_page_kind": F.lit("viewtopic"),
        }
    )
    return _finished(out, "phpbb").withColumn("deleted_or_guest", classify.is_guest(F.col("user_id"), F.col("author_display"))).select(POST_COLUMNS)


def _with_text(rows: DataFrame, body: Column) -> DataFrame:
    """Rows that have a text, with body_text. It is read by the filter and by what follows, and made once."""
    plain = once(rows, {"plain": text.strip_markup(body)}).withColumn("plain", text.unescape(F.col("plain")))
    return once(plain, {"body_text": text.squeeze(F.col("plain"))}).drop("plain").filter("body_text <> ''")


def _finished(rows: DataFrame, architecture: str) -> DataFrame:
    """Rows with their keys."""
    key = lambda kind, column: F.concat(F.lit(f"{architecture}:{kind}:"), column)
    return rows.withColumn("post_key", key("post", "post_id")).withColumn("author_key", F.when(F.col("user_id") != "", key("user", "user_id")))


def phpbb_footers(pages: DataFrame) -> DataFrame:
    """(user_key, signature) under posts: at least six characters, without the line before it and notes of editing after it."""
    rows = _rows(pages.filter("kind = 'phpbb_viewtopic'"), PHPBB_ROW, 3)
    last = F.element_at(F.concat(F.array(F.lit("")), F.regexp_extract_all("g2", F.lit(PHPBB_FOOTER), F.lit(1))), -1)
    value = text.strip(F.regexp_replace(text.html_to_text_basic(last), rf"(?U)\A_+{text.SPACE}*", ""))
    value = text.strip(F.regexp_replace(value, r"(?is)editado pela.*\z", ""))
    known = once(rows, {"user_id": _get(F.col("g3"), PHPBB_USER)}).filter("user_id <> ''")
    out = once(known.select(F.concat(F.lit("phpbb:user:"), "user_id").alias("user_key"), "g2"), {"signature": value}).select("user_key", "signature")
    return out.filter(F.length("signature") >= 6)


# ---- users


def _user_row(rows: DataFrame, architecture: str, **fields: Column) -> DataFrame:
    none = F.lit(None).cast("struct<raw:string,iso:string>")
    filled = {"name": F.lit(""), "role": F.lit(""), "location": F.lit(""), "homepage": F.lit(""), "occupation": F.lit(""), "interests": F.lit(""), "member_since": none, "observed": none}
    filled |= {"post_count": F.lit(0).cast("long"), "is_profile": F.lit(False), "emails": F.array().cast("array<string>"), "pos": F.lit(0)} | fields
    if "pos" in rows.columns:
        filled["pos"] = F.col("pos")
    out = once(rows, {"user_id": F.col("user_id")}).filter("user_id <> ''").withColumns(filled)
    return out.withColumn("architecture", F.lit(architecture)).withColumn("user_key", F.concat(F.lit(f"{architecture}:user:"), "user_id")).select(USER_COLUMNS)


def asp_profiles(pages: DataFrame, compat: bool = True) -> DataFrame:
    html, rel = F.col("html"), F.col("rel")
    # Labels; the accented ones count only without compat.
    user, place = ("Usuario", "Cidade") if compat else ("Usu(?:[aáÁ]|&aacute;)rio", "(?:Localiza(?:ç|&ccedil;)(?:ã|&atilde;)o|Cidade)")
    names = [
        rf"(?isu){user}:?\s*</font></b></td>\s*<td[^>]*><font[^>]*>(.*?)</font>",
        r'(?is)<td[^>]*valign=top[^>]*align=left[^>]*bgcolor="?618F9E"?[^>]*>\s*<font[^>]*><b>&nbsp;\s*(.*?)\s*</b></font>\s*</td>',
        r"(?is)<title>[^<]*?(?:de|do)\s+([^<]+)</title>",
    ]
    name = reduce(lambda rest, p: F.when(html.rlike(p), _get(html, p)).otherwise(rest), reversed(names), F.lit(""))
    cell = lambda label: _get(html, rf"(?isu){label}:&nbsp;</font></b></td>\s*<td[^>]*><font[^>]*>(.*?)</font>")
    since = dates.parse_date(cell("(?:Membro desde|Registrado em)"), compat)
    rows = pages.filter("kind = 'asp_profile'").withColumn("user_id", _first(text.first_group(rel, r"id_(\d+)"), text.first_group(rel, r"id=(\d+)"), text.first_group(html, r"pop_profile\.asp\?mode=display&id=(\d+)")))
    home = _get(html, r'(?is)Homepage:&nbsp;</font></b></td>\s*<td[^>]*><font[^>]*><a href="([^"]+)"')
    return _user_row(rows, "asp", name=text.html_to_text(name), location=text.html_to_text(cell(place)), homepage=text.normalize_whitespace(home), member_since=since, observed=since, is_profile=F.lit(True), emails=text.emails(html, compat))


def phpbb_profiles(pages: DataFrame, compat: bool = True) -> DataFrame:
    html = F.col("html")
    cell = lambda label: _get(html, rf"(?isu){label}:</td>\s*<td[^>]*>(.*?)</td>")
    since = dates.parse_date(cell("Registrado em"), compat)
    open_ = lambda label: F.lit("") if compat else text.html_to_text(cell(label))
    rows = pages.filter("kind = 'phpbb_profile'").withColumn("user_id", _first(text.first_group(F.col("rel"), r"u_(\d+)"), _get(html, PHPBB_USER)))
    home = text.html_to_text(cell("Pagina/WWW" if compat else "P(?:[aá]|&aacute;)gina/WWW"))
    return _user_row(
        rows,
        "phpbb",
        name=text.html_to_text(_get(html, PHPBB_NAME)),
        location=open_("Localiza(?:ç|&ccedil;)(?:ã|&atilde;)o"),
        occupation=open_("Ocupa(?:ç|&ccedil;)(?:ã|&atilde;)o"),
        interests=text.html_to_text(cell("Interesses")),
        homepage=home,
        member_since=since,
        observed=since,
        is_profile=F.lit(True),
        emails=text.emails(html, compat),
    )


def asp_members(pages: DataFrame) -> DataFrame:
    rows = _rows(pages.filter("kind = 'asp_members'"), ASP_MEMBER, 7).withColumnRenamed("g1", "user_id")
    plain = {k: text.html_to_text(F.col(k)) for k in ("g2", "g3", "g4", "g5", "g6", "g7")}
    seen, joined = dates.parse_date(plain["g5"]), dates.parse_date(plain["g6"])
    rows = rows.withColumn("seen", seen).withColumn("joined", joined)
    observed = F.struct(F.coalesce("seen.raw", "joined.raw").alias("raw"), F.coalesce("seen.iso", "joined.iso").alias("iso"))
    return _user_row(rows, "asp", name=plain["g2"], role=plain["g3"], location=plain["g7"], member_since=F.col("joined"), observed=observed, post_count=text.first_int(plain["g4"]))


def phpbb_members(pages: DataFrame) -> DataFrame:
    rows = _rows(pages.filter("kind = 'phpbb_memberlist'"), PHPBB_MEMBER, 5).withColumnRenamed("g1", "user_id")
    joined = dates.parse_date(F.col("g3"))
    site = text.normalize_whitespace(_get(F.col("g5"), r'(?is)<a href="([^"]+)"'))
    return _user_row(rows, "phpbb", name=text.html_to_text(F.col("g2")), homepage=site, member_since=joined, observed=joined, post_count=text.first_int(text.html_to_text(F.col("g4"))))


def post_authors(posts: DataFrame) -> DataFrame:
    """User observations of posts whose author has an id."""
    none = F.lit(None).cast("struct<raw:string,iso:string>")
    empty = {c: F.lit("") for c in ("homepage", "occupation", "interests")}
    return posts.filter("user_id <> ''").select(
        F.col("author_key").alias("user_key"), "architecture", "user_id", F.col("author_display").alias("name"), F.col("role_label").alias("role"), F.col("location_raw").alias("location"),
        *(v.alias(k) for k, v in empty.items()), none.alias("member_since"), F.col("posted").alias("observed"), F.col("message_count").alias("post_count"), F.lit(False).alias("is_profile"),
        F.array().cast("array<string>").alias("emails"), "domain", "rel", "ord", "pos",
    )
