"""Golden rows of small forum pages, and the whole command line over them."""

import json
import random
from pathlib import Path

from mini import PAGES
from pyspark.sql import functions as F

from sedimenta import cli
from sedimenta.functions import classify
from sedimenta.functions.ordering import walk_order
from sedimenta.operators import forum, repair
from sedimenta.plans.build import build


def pages_of(spark, items, parts=1):
    rows = spark.createDataFrame(items, "rel string, html string").repartition(parts)
    rows = rows.withColumn("kind", classify.page_kind(F.concat(F.lit("/"), "rel"))).withColumn("domain", F.split("rel", "/")[0]).withColumn("ord", walk_order(F.col("rel")))
    return rows.select("rel", "kind", "domain", "ord", "html")


def test_build(spark):
    house = build(pages_of(spark, list(PAGES.items())))
    posts = {r.post_key: r for r in house.posts.collect()}
    assert set(posts) == {"asp:post:501", "asp:post:502", "phpbb:post:77"}
    ana = posts["asp:post:501"]
    assert (ana.topic_title, ana.forum_key, ana.author_key, ana.role_classification, ana.location_raw, ana.posted_at) == ("Olá mundo", "asp:forum:3", "asp:user:42", "member_rank", "Recife", "2004-03-05T14:07:09")
    assert ana.links == ["http://x.org/a"] and ana.observed_domains == ["site_a"] and not ana.deleted_or_guest
    assert posts["asp:post:502"].deleted_or_guest and posts["asp:post:502"].author_display == "Visitante"
    bia = posts["phpbb:post:77"]
    assert (bia.posted_at, bia.role_label, bia.location_raw) == ("2004-03-05T15:04:00", "Veterano", "Natal")
    assert bia.body_text.startswith("antes") and bia.body_text.endswith("depois")

    topics = {r.topic_key: r for r in house.topics.collect()}
    assert set(topics) == {"asp:topic:7", "phpbb:topic:9"}  # the stub has no posts
    assert (topics["asp:topic:7"].post_count, topics["asp:topic:7"].source_page_count, topics["asp:topic:7"].first_seen_at) == (3, 4, "2004-03-04T10:00:00")

    users = {r.user_key: r for r in house.users.collect()}
    assert (users["asp:user:42"].post_count_observed, users["asp:user:42"].member_since, users["asp:user:42"].last_seen_at) == (120, "2004-03-05T00:00:00", "2005-02-01T00:00:00")
    assert users["phpbb:user:12"].interests == ["anime"] and users["phpbb:user:12"].primary_display_name == "Bia" and users["phpbb:user:12"].homepages == ["http://bia.org"]
    merged = house.merged_identities.collect()
    assert [(m.user_keys, m.normalized_aliases) for m in merged] == [(["asp:user:42", "phpbb:user:13"], ["ana"])]
    assert users["phpbb:user:13"].merged_identity_key == "merged:asp_user_42"

    salvage = house.post_salvage.collect()  # the quote that equals its post is gone
    assert [(s.candidate_post_key, s.body_text, s.author_display) for s in salvage] == [("asp:post:501", "Oi site (http://x.org)", "Ana")]
    knowledge = {r.post_key: r.text for r in house.knowledge_posts.collect()}
    assert knowledge["asp:post:502"] == "Tópico: Olá mundo\nFórum: Anime\nAutor: Visitante\nData: 2004-03-06T00:00:00\n\nDe passagem"


def test_order_of_partitions_changes_nothing(spark):
    items = list(PAGES.items())
    random.Random(5).shuffle(items)
    a, b = build(pages_of(spark, list(PAGES.items()))), build(pages_of(spark, items, 5))
    for name in ("posts", "topics"):
        assert sorted(map(str, getattr(a, name).collect())) == sorted(map(str, getattr(b, name).collect()))


def test_footers_and_breadcrumb(spark):
    pages = pages_of(spark, list(PAGES.items()))
    assert [tuple(r) for r in forum.phpbb_footers(pages).collect()] == [("phpbb:user:12", "Assinatura da Bia")]
    crumb = pages.filter("rel like '%TOPIC_ID_7_FORUM%'").select(repair.breadcrumb(F.col("html")).alias("b")).first().b
    assert (crumb.forum_key, crumb.forum_title) == ("asp:forum:3", "Anime")
    assert spark.createDataFrame([("<p>no</p>",)], "html string").select(repair.breadcrumb(F.col("html")).alias("b")).first().b is None


def test_balanced_body(spark):
    start = r'(?is)<td[^>]*class="postbody"[^>]*>'
    cases = {'<td class="postbody">a<td>b</td>c</td>d': "a<td>b</td>c", '<td class="postbody">never closed': "", "none": "", '<td class="postbody"></td>': ""}
    rows = spark.createDataFrame([(k,) for k in cases], "h string").select("h", forum.balanced(F.col("h"), start, "td").alias("b")).collect()
    assert {r.h: r.b for r in rows} == cases


def test_command_line(spark, tmp_path):
    root = tmp_path / "normalized"
    for name, html in PAGES.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(html, encoding="utf-8")
    bad = root / "site_a/asp/page/topic/bad.html"
    bad.write_bytes(b'<meta charset="utf-8">\xff')
    found = cli.build_tables(spark, str(root), str(tmp_path / "runs"))
    assert (found["posts"], found["topics"], found["users"], found["post_salvage"], found["merged_identities"], found["errors"]) == (3, 2, 3, 1, 1, 1)
    run = found["run"]
    assert json.loads(Path(run, "summary.json").read_text())["processed_files"] == len(PAGES) + 1
    assert cli.refine(spark, run)["signatures_removed"] == 0
    assert cli.enrich(spark, run) == {"users_with_signatures": 1, "phpbb_footer_signature": 1}
    assert cli.rebuild(spark, run) == 3
    assert cli.repair_topics(spark, run, str(root)) == {"topics_patched": 0}
    one = next(Path(run, "warehouse/users.jsonl").glob("part-*")).read_text(encoding="utf-8").splitlines()[0]
    assert "merged_identity_key" in json.loads(one)  # nulls are written too


def test_refine_takes_posts_in_the_order_of_pages(spark, tmp_path):
    """Neither the order of keys nor of lines counts: the example of a signature is that of the first page's first post."""
    (tmp_path / "warehouse").mkdir()
    post = lambda key, page, at, sig: {
        "post_key": key, "architecture": "asp", "source_page_kind": "topic", "author_key": "asp:user:1", "author_display": f"name {key}", "first_source_file": page, "source_position": at,
        "body_text": f"some text of post {key} that is long enough\n\n{sig}", "role_label": "", "links": [],
    }
    rows = [post("asp:post:10", "a/1.html", 0, "Best Regards, Ann"), post("asp:post:9", "a/1.html", 1, "best regards, ann")] + [post(f"asp:post:{k}", f"b/{k}.html", 0, "best regards, Ann") for k in (1, 2, 3)]
    with open(tmp_path / "warehouse" / "posts.jsonl", "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in reversed(rows))
    done = cli.refine(spark, str(tmp_path))
    assert done["signatures_removed"] == 5 and done["profiles"] == 1
    path = f"{done['run']}/signature_profiles.jsonl"
    row = spark.read.json(path).collect()[0]
    assert row.signature_text_example == "Best Regards, Ann" and row.author_display == "name asp:post:3" and row.match_count == 5
