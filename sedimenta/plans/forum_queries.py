"""Queries that write forum pages of every kind from the driver's tables and read them back with the engine's parsers and plans.

Rows of list pages and posts of topics are dealt to pages by number, ten or twenty to a page, so a page's size is bounded
whatever the tables hold.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions import classify, text
from sedimenta.functions.once import once
from sedimenta.functions.ordering import walk_order
from sedimenta.operators import enrich, forum, inventory, knowledge
from sedimenta.plans import build
from sedimenta.plans.queries import _t, query
from sedimenta.session import cut_lineage, ensure_checkpoint_dir
from sedimenta.sources import archive, sinks, tables

ROWS, POSTS = 20, 10


def _pages(rows: DataFrame, rel: Column, html: Column) -> DataFrame:
    """rows as pages for the parsers, of the kind that their path tells."""
    pages = once(rows, {"rel": rel, "html": html})
    kind = classify.page_kind(F.concat(F.lit("/"), "rel"))
    return pages.select("rel", kind.alias("kind"), F.split("rel", "/")[0].alias("domain"), walk_order(F.col("rel")).alias("ord"), "html")


def _dealt(rows: DataFrame) -> DataFrame:
    """rows dealt to all cores: tables are narrow and read in few tasks, and what is made of their rows is not cheap."""
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def _listed(rows: DataFrame, key: str, row: Column, rel: str) -> DataFrame:
    """Pages of at most ROWS rows each, in the order of key."""
    page = F.floor(F.col(key) / ROWS).alias("page")
    parts = rows.select(page, F.struct(F.col(key).alias("key"), row.alias("row")).alias("r")).groupBy("page").agg(F.array_sort(F.collect_list("r")).alias("r"))
    return _pages(parts, F.format_string(rel, "page"), F.array_join(F.transform("r", lambda r: r["row"]), "\n"))


def _day(key: str, later: int = 0) -> Column:
    return F.date_format(F.date_add(F.to_date(F.lit("2001-01-01")), (F.col(key) % 1000 + later).cast("int")), "dd/MM/yyyy")


def _day_sql(key: str, later: int = 0) -> str:
    return f"strftime(DATE '2001-01-01' + ({key} % 1000 + {later})::INT, '%Y-%m-%dT00:00:00')"


# ---- users


def _asp_profile_pages(spark, sf_dir):
    key, name = F.col("c_custkey"), F.col("c_name")
    heading = (
        F.when(key % 3 == 0, F.format_string("<tr><td><b><font>Usuario:</font></b></td><td><font>%s</font></td></tr>", name))
        .when(key % 3 == 1, F.format_string('<td valign=top align=left bgcolor="618F9E"><font><b>&nbsp;%s</b></font></td>', name))
        .otherwise(F.format_string("<title>Perfil de %s</title>", name))
    )
    cells = F.format_string(
        "<tr><td><b><font>Membro desde:&nbsp;</font></b></td><td><font>%s</font></td></tr><tr><td><b><font>Cidade:&nbsp;</font></b></td><td><font>%s</font></td></tr>"
        '<tr><td><b><font>Homepage:&nbsp;</font></b></td><td><font><a href="http://c.org/%d">a</a></font></td></tr> C%d@forum\\.org <a href="pop_profile.asp?mode=display&id=%d">eu</a>',
        _day("c_custkey"), "c_mktsegment", "c_custkey", "c_custkey", "c_custkey",
    )
    told = F.when(key % 2 == 0, F.format_string("s/asp/page/profile/pop_profile.asp_mode_display_id_%d.html", key)).otherwise(F.format_string("s/asp/page/profile/perfil-%d.html", key))
    return _pages(_dealt(_t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")), told, F.concat(heading, cells))


@query(
    f"""SELECT 'asp:user:' || c_custkey AS user_key, c_name AS name, c_mktsegment AS location, 'http://c.org/' || c_custkey AS homepage, {_day_sql("c_custkey")} AS member_since,
    'c' || c_custkey || '@forum\\.org' AS emails, true AS is_profile FROM customer"""
)
def asp_profile_pages(spark, sf_dir):
    rows = forum.asp_profiles(_asp_profile_pages(spark, sf_dir))
    return rows.select("user_key", "name", "location", "homepage", F.col("member_since.iso").alias("member_since"), F.array_join("emails", "|").alias("emails"), "is_profile")


def _phpbb_profile_pages(spark, sf_dir):
    html = F.format_string(
        '<th class="thHead" colspan="2">Exibir perfil :: %s</th><tr><td>Registrado em:</td><td>%s</td></tr><tr><td>Localização:</td><td>Pa&iacute;s %d</td></tr><tr><td>Ocupa&ccedil;&atilde;o:</td><td>Fornecedor</td></tr>'
        '<tr><td>Interesses:</td><td>i%d</td></tr><tr><td>P&aacute;gina/WWW:</td><td><a href="x">http://s.org/%d</a></td></tr><a href="mailto:S%d@Forum.org">m</a>',
        _shown("s_name"), _day("s_suppkey"), "s_nationkey", "s_nationkey", "s_suppkey", "s_suppkey",
    )
    return _pages(_dealt(_t(spark, sf_dir, "supplier")), F.format_string("s/phpbb/page/profile/profile.php_mode_viewprofile_u_%d.html", "s_suppkey"), html)


def _shown(name: str) -> Column:
    """The name of a customer with the supplier's number, in capitals: other letters, the same alias."""
    return F.upper(F.replace(name, F.lit("Supplier"), F.lit("Customer")))


_SHOWN = "upper(replace(s_name, 'Supplier', 'Customer'))"


@query(
    f"""SELECT 'phpbb:user:' || s_suppkey AS user_key, 'Exibir perfil :: ' || {_SHOWN} AS name, 'País ' || s_nationkey AS location, 'Fornecedor' AS occupation, 'i' || s_nationkey AS interests, 'http://s.org/' || s_suppkey AS homepage,
    {_day_sql("s_suppkey")} AS member_since, 's' || s_suppkey || '@forum.org' AS emails FROM supplier"""
)
def phpbb_profile_pages(spark, sf_dir):
    rows = forum.phpbb_profiles(_phpbb_profile_pages(spark, sf_dir), compat=False)
    return rows.select("user_key", "name", "location", "occupation", "interests", "homepage", F.col("member_since.iso").alias("member_since"), F.array_join("emails", "|").alias("emails"))


def _asp_member_pages(spark, sf_dir):
    seen = F.when(F.col("c_custkey") % 4 == 0, "").otherwise(_day("c_custkey", 100))
    row = F.format_string(
        '<tr><td><a href="pop_profile.asp?mode=display&id=%d">i</a></td><td><a href="pop_profile.asp?mode=display&id=%d">%s</a></td><td>Membro</td><td>%d</td><td>%s</td><td>%s</td><td>%s</td></tr>',
        "c_custkey", "c_custkey", "c_name", F.col("c_custkey") % 500, seen, _day("c_custkey"), "c_mktsegment",
    )
    return _listed(_t(spark, sf_dir, "customer"), "c_custkey", row, "s/asp/page/members/members.asp_%d.html")


@query(
    f"""SELECT 'asp:user:' || c_custkey AS user_key, c_name AS name, 'Membro' AS role, c_mktsegment AS location, {_day_sql("c_custkey")} AS member_since,
    CASE WHEN c_custkey % 4 = 0 THEN {_day_sql("c_custkey")} ELSE {_day_sql("c_custkey", 100)} END AS observed, c_custkey % 500 AS post_count, c_custkey // {ROWS} AS page,
    row_number() OVER (PARTITION BY c_custkey // {ROWS} ORDER BY c_custkey) - 1 AS pos FROM customer"""
)
def asp_member_pages(spark, sf_dir):
    rows = forum.asp_members(_asp_member_pages(spark, sf_dir))
    page = F.regexp_extract("rel", r"asp_(\d+)", 1).cast("long").alias("page")
    return rows.select("user_key", "name", "role", "location", F.col("member_since.iso").alias("member_since"), F.col("observed.iso").alias("observed"), "post_count", page, F.col("pos").cast("long").alias("pos"))


def _phpbb_member_pages(spark, sf_dir):
    row = F.format_string(
        '<tr><td class="row1"><span class="name"><a href="profile.php?mode=viewprofile&amp;u=%d">%s</a></span></td><td class="row1">%s</td><td class="row2">%d</td><td class="row1"><a href="http://s.org/%d">w</a></td></tr>',
        "s_suppkey", _shown("s_name"), _day("s_suppkey"), F.col("s_suppkey") % 500, "s_suppkey",
    )
    return _listed(_t(spark, sf_dir, "supplier"), "s_suppkey", row, "s/phpbb/page/memberlist/memberlist.php_%d.html")


@query(f"SELECT 'phpbb:user:' || s_suppkey AS user_key, {_SHOWN} AS name, 'http://s.org/' || s_suppkey AS homepage, {_day_sql('s_suppkey')} AS member_since, s_suppkey % 500 AS post_count FROM supplier")
def phpbb_member_pages(spark, sf_dir):
    rows = forum.phpbb_members(_phpbb_member_pages(spark, sf_dir))
    return rows.select("user_key", "name", "homepage", F.col("member_since.iso").alias("member_since"), "post_count")


_IDENTITY = f"customer LEFT JOIN supplier ON upper(c_name) = {_SHOWN}"


@query(
    f"""SELECT 'asp:user:' || c_custkey AS user_key, c_name AS primary_display_name, CASE WHEN s_name IS NOT NULL THEN 'merged:asp_user_' || c_custkey END AS merged_identity_key, 'Membro' AS role_labels, 'member_rank' AS role_classes,
      c_mktsegment AS locations, 'http://c.org/' || c_custkey AS homepages, {_day_sql("c_custkey")} AS member_since, c_custkey % 500 AS post_count_observed, 1::BIGINT AS profile_count, 2::BIGINT AS source_page_count,
      {_day_sql("c_custkey")} AS first_seen_at, CASE WHEN c_custkey % 4 = 0 THEN {_day_sql("c_custkey")} ELSE {_day_sql("c_custkey", 100)} END AS last_seen_at FROM {_IDENTITY}
    UNION ALL SELECT 'phpbb:user:' || s_suppkey, {_SHOWN}, CASE WHEN c_name IS NOT NULL THEN 'merged:asp_user_' || c_custkey END, '', '', 'País ' || s_nationkey, 'http://s.org/' || s_suppkey, {_day_sql("s_suppkey")}, s_suppkey % 500, 1, 2,
      {_day_sql("s_suppkey")}, {_day_sql("s_suppkey")} FROM supplier LEFT JOIN customer ON upper(c_name) = {_SHOWN}"""
)
def warehouse_users(spark, sf_dir):
    """Users of four kinds of pages, brought together by key, and across platforms by name."""
    seen = forum.asp_profiles(_asp_profile_pages(spark, sf_dir), compat=False).unionByName(forum.asp_members(_asp_member_pages(spark, sf_dir)))
    seen = seen.unionByName(forum.phpbb_profiles(_phpbb_profile_pages(spark, sf_dir), compat=False)).unionByName(forum.phpbb_members(_phpbb_member_pages(spark, sf_dir)))
    users, _ = build.warehouse_users(seen, compat=False)
    lists = [F.array_join(c, "|").alias(c) for c in ("role_labels", "role_classes", "locations", "homepages")]
    return users.select("user_key", "primary_display_name", "merged_identity_key", *lists, "member_since", "post_count_observed", "profile_count", "source_page_count", "first_seen_at", "last_seen_at")


# ---- topics and posts: ten events make a topic


def _topic_pages(spark, sf_dir):
    months = F.array(*(F.lit(m) for m in ("jan", "fev", "mar", "abr", "mai", "jun", "jul", "ago", "set", "out", "nov", "dez")))
    posted = F.concat(F.element_at(months, F.month("ts")), F.date_format("ts", " dd, yyyy h:mm a"))
    guest = F.col("event_type") == "error"
    ending = F.when(F.col("event_id") % 3 == 0, "abc").otherwise(F.concat(F.lit("Assinatura &amp; "), F.col("user_id") % 10, F.lit("<br />Editado pela &uacute;ltima vez")))
    post = F.format_string(
        '<tr><td class="row1" rowspan="2"><strong>%s</strong><span class="postdetails">%s<br />Mensagens: %d<br />Localização: Sala %d</span></td><td class="row1" valign="top"><a href="viewtopic.php?p=%d#x">p</a><table><tr><td>Enviada: %s</td></tr>'
        '<tr><td class="postbody"><hr />%s<table><tr><td class="quote">cita %s</td></tr></table>fim</td></tr><tr><td height="40" valign="bottom" class="genmed">_________________<br />%s</td></tr></table></td></tr>\n'
        '<tr><td class="row1" valign="bottom" nowrap="nowrap">%s</td></tr>',
        F.when(guest, "Visitante").otherwise(F.concat(F.lit("U "), "user_id")), "event_type", F.col("event_id") % 100, F.col("user_id") % 7, "event_id", posted, "props", "event_type", ending,
        F.when(guest, "").otherwise(F.format_string('<a href="profile.php?mode=viewprofile&amp;u=%d">perfil</a>', "user_id")),
    )
    events = _t(spark, sf_dir, "events").select(F.floor(F.col("event_id") / POSTS).alias("topic"), F.struct("event_id", post.alias("post")).alias("p"))
    topics = events.groupBy("topic").agg(F.array_sort(F.collect_list("p")).alias("p"))
    head = F.format_string(
        '<td width="100%%" class="nav"><a href="index.php">Home</a> &gt; <a href="viewforum.php?f=%d">Forum %d</a></td><td class="maintitle">Assunto &amp; %d</td><a href="viewtopic.php?t=%d">t</a>\n',
        F.col("topic") % 9, F.col("topic") % 9, "topic", "topic",
    )
    return _pages(topics, F.format_string("s/phpbb/page/viewtopic/viewtopic.php_t_%d.html", "topic"), F.concat(head, F.array_join(F.transform("p", lambda p: p["post"]), "\n")))


_POSTED = "strftime(ts, '%Y-%m-%dT%H:%M') || ':00'"


@query(
    f"""SELECT 'phpbb:post:' || event_id AS post_key, 'phpbb:topic:' || (event_id // {POSTS}) AS topic_key, CASE WHEN event_type <> 'error' THEN 'phpbb:user:' || user_id END AS author_key,
    CASE WHEN event_type = 'error' THEN 'Visitante' ELSE 'U ' || user_id END AS author_display, event_type AS role_label, 'Sala ' || (user_id % 7) AS location_raw, event_id % 100 AS message_count, {_POSTED} AS posted_at,
    props || 'cita ' || event_type || ' ' || chr(10) || 'fim' AS body_text, event_type = 'error' AS deleted_or_guest, event_id % {POSTS} AS pos FROM events"""
)
def phpbb_topic_posts(spark, sf_dir):
    posts = forum.phpbb_posts(forum.phpbb_topic_pages(_topic_pages(spark, sf_dir)))
    return posts.select("post_key", "topic_key", "author_key", "author_display", "role_label", "location_raw", "message_count", F.col("posted.iso").alias("posted_at"), "body_text", "deleted_or_guest", F.col("pos").cast("long").alias("pos"))


@query(
    f"""SELECT 'phpbb:topic:' || t AS topic_key, 'phpbb:forum:' || (t % 9) AS forum_key, 'Forum ' || (t % 9) AS forum_title, 'Assunto & ' || t AS topic_title, n AS post_count, authors AS unique_author_count, author_keys,
    first_seen_at, last_seen_at, 's/phpbb/page/viewtopic/viewtopic.php_t_' || t || '.html' AS first_source_file, 1::BIGINT AS source_page_count
    FROM (SELECT event_id // {POSTS} AS t, count(*) AS n, count(DISTINCT user_id) FILTER (event_type <> 'error') AS authors, min({_POSTED}) AS first_seen_at, max({_POSTED}) AS last_seen_at,
      coalesce(string_agg(DISTINCT 'phpbb:user:' || user_id, '|' ORDER BY 'phpbb:user:' || user_id) FILTER (event_type <> 'error'), '') AS author_keys FROM events GROUP BY 1)"""
)
def warehouse_topics(spark, sf_dir):
    pages = forum.phpbb_topic_pages(_topic_pages(spark, sf_dir))
    # Two counts are made of posts: written once, without their texts.
    posts = cut_lineage(forum.phpbb_posts(pages).select("topic_key", "author_key", "author_display", "posted", "ord", "pos"))
    topics = build.warehouse_topics(pages.select(forum.TOPIC_COLUMNS), posts)
    return topics.select("topic_key", "forum_key", "forum_title", "topic_title", "post_count", "unique_author_count", F.array_join("author_keys", "|").alias("author_keys"), "first_seen_at", "last_seen_at", "first_source_file", "source_page_count")


_SIGNED = "event_id % 3 <> 0 AND event_type <> 'error'"


@query(f"SELECT 'phpbb:user:' || user_id AS user_key, 'Assinatura & ' || (user_id % 10) AS signature FROM events WHERE {_SIGNED}")
def phpbb_footer_signatures(spark, sf_dir):
    return forum.phpbb_footers(_topic_pages(spark, sf_dir))


@query(
    f"""WITH seen AS (SELECT DISTINCT 'phpbb:user:' || user_id AS user_key, 'Assinatura & ' || (user_id % 10) AS sig, 'phpbb_footer_signature' AS source FROM events WHERE {_SIGNED}
      UNION SELECT 'phpbb:user:' || user_id, 'fim de ' || user_id, 'asp_repeated_suffix' FROM events WHERE user_id % 2 = 0)
    SELECT u.user_key, coalesce(string_agg(DISTINCT sig, '|' ORDER BY sig), '') AS signatures_observed, coalesce(string_agg(DISTINCT source, '|' ORDER BY source), '') AS signature_sources, count(DISTINCT sig) AS signature_count_observed
    FROM (SELECT DISTINCT 'phpbb:user:' || user_id AS user_key FROM events) u LEFT JOIN seen s ON u.user_key = s.user_key GROUP BY 1"""
)
def enriched_users(spark, sf_dir):
    known = _t(spark, sf_dir, "events").select("user_id").distinct()
    users = known.select(F.concat(F.lit("phpbb:user:"), "user_id").alias("user_key"), F.lit("phpbb").alias("architecture"), F.concat(F.lit("U "), "user_id").alias("primary_display_name"))
    profiles = known.filter("user_id % 2 = 0").select(F.concat(F.lit("phpbb:user:"), "user_id").alias("user_key"), F.concat(F.lit("fim de "), "user_id").alias("signature_text_example"))
    full, _, _ = enrich.enrich(users, profiles, forum.phpbb_footers(_topic_pages(spark, sf_dir)))
    return full.select("user_key", F.array_join("signatures_observed", "|").alias("signatures_observed"), F.array_join("signature_sources", "|").alias("signature_sources"), F.col("signature_count_observed").cast("long").alias("signature_count_observed"))


# ---- quotes and what is salvaged of them


def _quote_pages(spark, sf_dir):
    orders = _dealt(_t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"))
    key = F.col("o_orderkey")
    body = F.when(key % 5 == 0, " ").when(key % 2 == 0, F.concat("o_orderpriority", F.lit("\ntotal "), "o_orderstatus")).otherwise(F.format_string("[quote][b]%s[/b] [url=http://x.org/%d]site[/url][/quote]", "o_orderpriority", key))
    html = F.format_string(
        '<input name="TOPIC_ID" type="hidden" value="%d"><input name="REPLY_ID" type="hidden" value="%d"><input name="AUTHOR" type="hidden" value="%d"><input name="FORUM_TITLE" type="hidden" value="Pedidos &amp; mais"><textarea name="Message">%s</textarea>',
        "o_custkey", key, "o_custkey", body,
    )
    return _pages(orders, F.format_string("s/asp/page/post/post.asp_Topic_Title_Conta+%d_method_ReplyQuote_n_%d.html", "o_custkey", key), html)


_QUOTED = "o_orderpriority || ' site (http://x.org/' || o_orderkey || ')'"
_QUOTE_FILE = "'s/asp/page/post/post.asp_Topic_Title_Conta+' || o_custkey || '_method_ReplyQuote_n_' || o_orderkey || '.html'"


@query(
    f"""SELECT 'asp:topic:' || o_custkey AS topic_key, o_orderkey::VARCHAR AS reply_id, o_custkey::VARCHAR AS author_id, 'Pedidos & mais' AS forum_title, 'Conta ' || o_custkey AS topic_title,
    CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderkey % 2 = 0 THEN o_orderpriority || chr(10) || 'total ' || o_orderstatus ELSE {_QUOTED} END AS body_text FROM orders"""
)
def asp_quotes(spark, sf_dir):
    return forum.asp_quote_pages(_quote_pages(spark, sf_dir)).select("topic_key", "reply_id", "author_id", "forum_title", "topic_title", "body_text")


@query(
    f"""SELECT 'salvage:' || sha1({_QUOTE_FILE} || '|' || {_QUOTED}) AS salvage_key, 'asp:post:' || o_orderkey AS candidate_post_key, 'asp:topic:' || o_custkey AS topic_key, 'Conta ' || o_custkey AS topic_title,
    'asp:user:' || o_custkey AS author_key, c_name AS author_display, {_QUOTED} AS body_text, {_QUOTE_FILE} AS first_source_file FROM orders LEFT JOIN customer ON c_custkey = o_custkey WHERE o_orderkey % 5 <> 0 AND o_orderkey % 2 <> 0"""
)
def salvaged_quotes(spark, sf_dir):
    """Of the quotes those are left that have a text other than that of their post; authors get the name that is known."""
    quotes = forum.asp_quote_pages(_quote_pages(spark, sf_dir))
    posts = _t(spark, sf_dir, "orders").select(F.concat(F.lit("asp:post:"), "o_orderkey").alias("post_key"), F.concat("o_orderpriority", F.lit("\ntotal "), "o_orderstatus").alias("body_text"))
    users = _t(spark, sf_dir, "customer").select(F.concat(F.lit("asp:user:"), "c_custkey").alias("user_key"), F.col("c_name").alias("primary_display_name"))
    rows = build.salvage(quotes, build.running_titles(quotes.select(forum.TOPIC_COLUMNS)), posts, users)
    return rows.select("salvage_key", "candidate_post_key", "topic_key", "topic_title", "author_key", "author_display", "body_text", "first_source_file")


@query(
    """SELECT 'k' || o_orderkey AS post_key, concat(CASE WHEN o_orderkey % 2 = 0 THEN 'Tópico: ' || o_orderpriority || chr(10) ELSE '' END, CASE WHEN o_orderkey % 3 = 0 THEN 'Fórum: F' || (o_orderkey % 7) || chr(10) ELSE '' END,
      CASE WHEN c_name IS NOT NULL THEN 'Autor: ' || c_name || chr(10) ELSE '' END, 'Data: ' || strftime(o_orderdate, '%Y-%m-%d') || chr(10), chr(10), 'total ' || o_orderstatus) AS text FROM orders LEFT JOIN customer ON c_custkey = o_custkey"""
)
def knowledge_documents(spark, sf_dir):
    """Documents of posts with all four headings, where there is something to say."""
    key = F.col("o_orderkey")
    rows = _t(spark, sf_dir, "orders").join(_t(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left").select(
        F.concat(F.lit("k"), key).alias("post_key"), F.lit("t").alias("topic_key"), F.lit("u").alias("author_key"), F.lit("asp").alias("architecture"), F.lit("topic").alias("source_page_kind"),
        F.when(key % 2 == 0, F.col("o_orderpriority")).alias("topic_title"), F.when(key % 3 == 0, F.concat(F.lit("F"), key % 7)).otherwise("").alias("forum_title"), F.col("c_name").alias("author_display"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("posted_at"), F.concat(F.lit("total "), "o_orderstatus").alias("body_text"), F.lit("f").alias("first_source_file"),
    )
    return knowledge.knowledge_posts(rows).select("post_key", "text")


# ---- sources and sinks

MODES = ("hint", "declared_first", "no_hint")


@query(
    r"""WITH told AS (SELECT page_id, page_id % 3 AS r, CASE page_id % 3 WHEN 0 THEN 'charset=utf-8 ' || html WHEN 1 THEN 'charset=ISO-8859-1 ' || regexp_replace(html, '[^\x{00}-\x{7f}\x{a0}-\x{ff}]', '', 'g') || 'é' ELSE 'charset=utf-8 ' || regexp_replace(html, '[^\x{00}-\x{7f}]', '', 'g') END AS t FROM pages)
    SELECT page_id, mode, CASE r WHEN 1 THEN 'iso-8859-1' ELSE 'utf-8' END AS charset, CASE WHEN r = 0 THEN 'utf-8' WHEN r = 1 THEN CASE mode WHEN 'declared_first' THEN 'iso-8859-1' ELSE 'cp1252' END WHEN mode <> 'hint' THEN 'cp1252' END AS decoder,
    r = 2 AND mode = 'hint' AS failed, CASE WHEN r = 2 THEN CASE WHEN mode <> 'hint' THEN sha256(t || 'ÿ') END ELSE sha256(t) END AS text_sha256 FROM told, (VALUES ('hint'), ('declared_first'), ('no_hint')) m(mode)"""
)
def decoded_pages(spark, sf_dir):
    """Pages in UTF-8, in a one-byte encoding, and with a byte that UTF-8 hasn't got, read in each of three ways."""
    third, html = F.col("page_id") % 3, F.col("html")
    latin = F.encode(F.concat(F.lit("charset=ISO-8859-1 "), F.regexp_replace(html, r"[^\x00-\x7f\xa0-\xff]", ""), F.lit("é")), "ISO-8859-1")
    broken = F.concat(F.encode(F.concat(F.lit("charset=utf-8 "), F.regexp_replace(html, r"[^\x00-\x7f]", "")), "UTF-8"), F.unhex(F.lit("FF")))
    content = F.when(third == 0, F.encode(F.concat(F.lit("charset=utf-8 "), html), "UTF-8")).when(third == 1, latin).otherwise(broken)
    rel = F.col("page_id").cast("string")
    pages = _t(spark, sf_dir, "pages").select(rel.alias("rel"), F.lit("asp_topic").alias("kind"), F.lit("s").alias("domain"), walk_order(rel).alias("ord"), content.alias("content"))
    read = [archive.decode_pages(pages, mode).withColumn("mode", F.lit(mode)) for mode in MODES]
    out = read[0].unionByName(read[1]).unionByName(read[2])
    return out.select(F.col("rel").cast("long").alias("page_id"), "mode", "charset", "decoder", F.col("error").isNotNull().alias("failed"), F.sha2("html", 256).alias("text_sha256"))


def _shared_folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("SELECT form, c_custkey, c_name, nullif(c_mktsegment, 'FURNITURE') AS c_mktsegment FROM customer, (VALUES ('lines'), ('objects')) f(form)")
def json_round_trip(spark, sf_dir):
    """Rows written as JSON lines and as objects one after another, nulls too, and read back by their schema."""
    rows = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("c_mktsegment"))
    folder, schema = _shared_folder(spark, "json"), "c_custkey long, c_name string, c_mktsegment string"
    sinks.write_jsonl(rows, f"{folder}/lines", "c_custkey")
    sinks.write_concatenated(rows, f"{folder}/objects")
    lines, objects = tables.read_jsonl(spark, f"{folder}/lines", schema), tables.read_concatenated(spark, f"{folder}/objects", schema)
    return lines.withColumn("form", F.lit("lines")).unionByName(objects.withColumn("form", F.lit("objects"))).select("form", "c_custkey", "c_name", "c_mktsegment")


@query(
    """SELECT CASE page_id % 3 WHEN 0 THEN 'b' ELSE 'a' END AS source_key, 'd' || (page_id % 7) AS folder, count(*) AS files, min('topic.asp_TOPIC_ID_' || page_id || '.html') AS first_name,
    count(*) FILTER (page_id % 5 = 0) AS failed FROM pages GROUP BY 1, 2"""
)
def inventory_entries(spark, sf_dir):
    """The inventory of two sources whose files lie in folders; a fifth of them can't be read."""
    key, name = F.when(F.col("page_id") % 3 == 0, "b").otherwise("a"), F.concat(F.lit("d"), F.col("page_id") % 7, F.lit("/topic.asp%3FTOPIC_ID="), "page_id")
    content = F.when(F.col("page_id") % 5 != 0, F.encode("html", "UTF-8"))
    files = _t(spark, sf_dir, "pages").select(key.alias("source_key"), F.when(key == "a", 0).otherwise(1).alias("source_ord"), name.alias("relative"), name.alias("path"), F.length("html").cast("long").alias("length"), content.alias("content"))
    entries = inventory.inventory(files)
    named = entries.select("source_key", F.split("original_relative_path", "/")[0].alias("folder"), F.col("normalized_filename").alias("name"))
    counted = named.groupBy("source_key", "folder").agg(F.count("*").alias("files"), F.min("name").alias("first_name"))
    failed = inventory.exceptions(entries).groupBy("source_key", F.split("original_relative_path", "/")[0].alias("folder")).agg(F.count("*").alias("failed"))
    met = archive.folders(files).join(counted, ["source_key", "folder"]).join(failed, ["source_key", "folder"], "left")
    return met.select("source_key", "folder", "files", "first_name", F.coalesce("failed", F.lit(0).cast("long")).alias("failed"))


@query(
    """SELECT page_id, lower(addr) AS fixed, CASE WHEN page_id % 2 = 0 THEN lower(replace(addr, '.org', '\\.org')) END AS compat FROM (SELECT page_id, 'Ana.' || page_id || '@Forum.org' AS addr FROM pages)"""
)
def email_addresses(spark, sf_dir):
    """Addresses in the two ways of reading: as they are written, and only where a backslash stands before the last dot."""
    plain = F.format_string("<p>Ana.%d@Forum.org</p>", "page_id")
    slashed = F.when(F.col("page_id") % 2 == 0, F.format_string("<p>Ana.%d@Forum\\.org</p>", "page_id")).otherwise("")
    rows = _t(spark, sf_dir, "pages").select("page_id", F.concat(plain, slashed).alias("html"))
    return rows.select("page_id", F.get(text.emails(F.col("html"), False), 0).alias("fixed"), F.get(text.emails(F.col("html"), True), 0).alias("compat"))
