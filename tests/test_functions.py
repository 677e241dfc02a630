"""Text, dates, classification, decoding, signatures, inventory: cases and plain versions."""

import html
import random
import re
import unicodedata

from pyspark.sql import functions as F

from sedimenta.functions import classify, dates, text, udfs
from sedimenta.functions.ordering import walk_order
from sedimenta.operators import enrich, inventory, reduce, signatures
from sedimenta.operators.components import components
from sedimenta.sources import archive, sinks, tables

ODD = [None, "", " ", "a  b\t c", "x\r\n\n\n\n y", " nb sp ", "&amp;lt;b&amp;gt;", "ß İ ﬁ", "<script>x</script>a<br/>b</p>c", "José &eacute;", " em ", "\x1cfs\x1c", "a&b;c &#233; &copy2"]


def column(spark, values, make):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.o for r in rows.select("i", make(F.col("v")).alias("o")).orderBy("i").collect()]


def plain_normalize(value):
    value = html.unescape(value or "").replace("\r", "").replace("\xa0", " ")
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", value)).strip()


def samples():
    r = random.Random(11)
    alphabet = ["a", "B", " ", "\t", "\n", "\r", "\xa0", "&amp;", "&lt;", "<b>", "</p>", "<br>", "é", "ß", "́", "&#65;", ";", "[url]", "[/url]", " "]
    return ODD + ["".join(r.choice(alphabet) for _ in range(r.randint(0, 30))) for _ in range(200)]


def test_normalize_whitespace(spark):
    values = samples()
    assert column(spark, values, text.normalize_whitespace) == [plain_normalize(v) for v in values]


def test_alias_and_signature(spark):
    values = samples()

    def alias(v):
        folded = "".join(c for c in unicodedata.normalize("NFKD", plain_normalize(v)) if not unicodedata.combining(c))
        return " ".join(folded.split()).casefold()

    assert column(spark, values, text.normalize_alias) == [alias(v) for v in values]
    assert column(spark, ["Straße  \n X"], text.normalize_signature) == ["strasse x"]


def test_names_and_links(spark):
    assert column(spark, ["Exibir perfil :: View profile :: Bia", "Anime - SobreSites", "forum de anime - sobresites", "Zé"], text.display_name) == ["Bia", "", "", "Zé"]
    assert column(spark, ["<a href=b#x><img src='A'><a href=\"b\">", None], text.links) == [["A", "b"], []]
    assert column(spark, ["joe@site.com", None], text.emails) == [[], []]
    assert column(spark, ["Joe@Site.com"], lambda v: text.emails(v, compat=False)) == [["joe@site.com"]]


def test_dates(spark):
    cases = {"5/3/2004 7:08": "2004-03-05T07:08:00", "31/02/2004": "2004-02-31T00:00:00", "Mar 05, 2004 12:04 am": "2004-03-05T00:04:00", "dez 1, 1999 1:02 PM": "1999-12-01T13:02:00", "5 de marco de 2004": "2004-03-05T00:00:00", "5 de março de 2004": None, "05 Mar 2004": None, "": None, None: None, "Enviado 05/03/2004 às 14:07:09": "2004-03-05T14:07:09"}
    assert column(spark, list(cases), lambda v: dates.parse_date(v)["iso"]) == list(cases.values())
    assert column(spark, ["5 de março de 2004"], lambda v: dates.parse_date(v, compat=False)["iso"]) == ["2004-03-05T00:00:00"]


def test_roles_kinds_domains(spark):
    roles = {"Administrador": "administrator", " moderador": "moderator", "Moderador Junior": "decorative_rank", "Moderador Júnior": "custom_rank", "Super Membro": "member_rank", "": "unknown", None: "unknown", "x": "custom_rank"}
    assert column(spark, list(roles), classify.role_class) == list(roles.values())
    assert column(spark, ["Moderador Júnior"], lambda v: classify.role_class(v, compat=False)) == ["decorative_rank"]
    kinds = {"s\\asp\\page\\topic\\a.html": "asp_topic", "s/phpbb/page/profile/a": "phpbb_profile", "s/asp/page/profile/a": "asp_profile", "s/x/page/memberlist/a": "phpbb_memberlist", "s/other": "skip"}
    assert column(spark, list(kinds), classify.page_kind) == list(kinds.values())
    assert column(spark, ["/r/Normalized/Site/x", "/r/x", "/r/normalized"], classify.logical_domain) == ["site", "unknown_domain", "unknown_domain"]


def test_tokens(spark):
    assert column(spark, ["a%20b/c", "..", "A<>:b", None, "x__ _y"], text.sanitize_token) == ["a_b_c", "empty", "A_b", "empty", "x_y"]
    pairs = column(spark, ["TOPIC_ID=07&t=&&x%3D1&b=a+c", ""], text.query_pairs)
    assert [[(p.k, p.v) for p in q] for q in pairs] == [[("TOPIC_ID", "07"), ("t", "empty"), ("x=1", "empty"), ("b", "a_c")], []]
    ids = column(spark, ["t=10&t=9&TOPIC_ID=9&u=x"], lambda v: classify.detected_ids(text.query_pairs(v)))
    assert ids[0].topic_id == ["9", "10"] and ids[0].user_id == []


def test_walk_order(spark):
    names = ["b/z.html", "a/c/x.html", "B.html", "a/y.html"]
    rows = spark.createDataFrame([(n,) for n in names], "p string").orderBy(walk_order(F.col("p"))).collect()
    assert [r.p for r in rows] == ["B.html", "a/y.html", "a/c/x.html", "b/z.html"]


def test_decoding(spark):
    data = [(b'<meta charset="utf-8">\xc3\xa9',), (b'<meta charset="utf-8">\xff',), (b"charset=iso-8859-1 \xe9\x93",), (b"\x81",), (b"",), (None,)]
    rows = spark.createDataFrame(data, "c binary").withColumn("h", archive.charset_hint(F.col("c"))).select("h", udfs.decoder()(F.col("c"), F.col("h")).alias("d")).collect()
    assert [(r.d.text, r.d.decoder) for r in rows] == [('<meta charset="utf-8">é', "utf-8"), (None, None), ("charset=iso-8859-1 é“", "cp1252"), ("\x81", "latin-1"), ("", "utf-8"), ("", "utf-8")]
    assert rows[1].d.error and not rows[0].d.error
    assert column(spark, ["FÃ³rum", "ok é", "Ã"], lambda v: udfs.repair_mojibake(v)) == ["Fórum", "ok é", "Ã"]


def test_signatures(spark):
    body = lambda i, sig: f"mensagem numero {i} com texto\n\n{sig}"
    posts = [(f"p{i}", "u", body(i, "Minha Assinatura"), "U", i) for i in range(3)] + [("p3", "u", "outra mensagem aqui\n\nfim diferente x", "U", 3), ("p4", "u", "Minha Assinatura", "U", 4), ("p5", None, body(9, "x y"), "", 5)]
    frame = spark.createDataFrame(posts, "post_key string, user_key string, body string, author_display string, ord int")
    counted, users = signatures.candidates(frame)
    found = signatures.profiles(counted, users)
    assert [(r.normalized, r["count"], r.user_posts, r.coverage) for r in found.collect()] == [("minha assinatura", 3, 4, 0.75)]
    clean = {r.post_key: (r.clean, r.signature) for r in signatures.strip_signatures(frame, found).collect()}
    assert clean["p0"] == ("mensagem numero 0 com texto", "Minha Assinatura") and clean["p4"] == ("Minha Assinatura", None) and len(clean) == 6
    shapes = [("x" * 7 + " y", 8 + 1 + 20), ("ab cd", 30), ("---- ----", 40), ("word " * 60, 400)]
    rows = spark.createDataFrame([(c, c.strip() + "p" * n) for c, n in shapes], "c string, w string").select(signatures.is_candidate(F.col("c"), F.col("w")).alias("o")).collect()
    assert [r.o for r in rows] == [True, False, False, False]


def test_enrich_and_components(spark):
    users = spark.createDataFrame([("a", "asp", "A"), ("b", "phpbb", None)], "user_key string, architecture string, primary_display_name string")
    profiles = spark.createDataFrame([("a", "sig one"), ("zz", "gone")], "user_key string, signature_text_example string")
    footers = spark.createDataFrame([("a", "sig one"), ("a", "Sig two")], "user_key string, signature string")
    full, some, added = enrich.enrich(users, profiles, footers)
    assert {r.user_key: r.signatures_observed for r in full.collect()} == {"a": ["sig one", "Sig two"], "b": []}
    assert [r.user_key for r in some.collect()] == ["a"] and {r.source: r.added for r in added.collect()} == {"asp_repeated_suffix": 1, "phpbb_footer_signature": 1}
    links = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 101), (7, None)], "a int, b int")
    assert {r.node: r.component for r in components(links).collect()} == {i: 0 for i in range(31)} | {100: 100, 101: 100}


def test_inventory(spark, tmp_path):
    names = ["topic.asp%3FTOPIC_ID=7", "sub/topic.asp%3FTOPIC_ID=7", "sub/TOPIC.ASP%3FTOPIC_ID=7", "logo.gif", "readme"]
    for n in names:
        (tmp_path / "s" / n).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "s" / n).write_text("x" if "topic" in n else n)
    files = archive.inventory_sources(spark, {"s": str(tmp_path / "s")})
    entries = {r.original_relative_path: r for r in inventory.inventory(files).collect()}
    assert sorted(entries) == sorted(names)
    assert entries["topic.asp%3FTOPIC_ID=7"].is_physical_duplicate and not entries["sub/topic.asp%3FTOPIC_ID=7"].is_physical_duplicate
    assert sorted(e.normalized_filename for e in entries.values() if e.normalized_filename) == ["TOPIC.ASP_TOPIC_ID_7.html", "topic.asp_TOPIC_ID_7__collision_2.html", "topic.asp_TOPIC_ID_7__collision_3.html"]
    assert [k for k, e in entries.items() if e.canonical_candidate_preliminary] == ["sub/TOPIC.ASP%3FTOPIC_ID=7"]
    assert entries["logo.gif"].status == "inventoried_only" and entries["logo.gif"].sha256 is None
    assert [r.folder for r in archive.folders(files).collect()] == ["sub"]
    assert inventory.summary(inventory.inventory(files)).first().physical_duplicate_groups == 1


def test_json(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"k": 1}\n\n{\n "k": 2,\n "v": null}', encoding="utf-8")
    assert sorted(r.k for r in tables.read_concatenated(spark, str(tmp_path / "a.json"), "k int, v string").collect()) == [1, 2]
    rows = spark.createDataFrame([(1, None)], "k int, v string")
    sinks.write_jsonl(rows, str(tmp_path / "t"))
    sinks.replace_table(tables.read_jsonl(spark, str(tmp_path / "t"), "k int, v string").withColumn("k", F.col("k") + 1), str(tmp_path / "t"))
    assert [tuple(r) for r in tables.read_jsonl(spark, str(tmp_path / "t"), "k int, v string").collect()] == [(2, None)]
    assert tables.latest_run(str(tmp_path / "none")) is None


def test_first_wins_and_bounds(spark):
    rows = spark.createDataFrame([("a", 2, "x", None), ("a", 1, "y", "2004"), ("b", 1, "z", "2001"), ("a", 3, "w", "2004")], "k string, o int, v string, d string")
    assert sorted(r.v for r in reduce.first_wins(rows, "k", ["o"]).collect()) == ["y", "z"]
    bounds = {r.k: (r.first_seen_at, r.first_seen_at_raw, r.last_seen_at_raw) for r in reduce.with_date_bounds(rows, "k", "d", "v", "o").collect()}
    assert bounds == {"a": ("2004", "y", "y"), "b": ("2001", "z", "z")}


def test_hot_keys(spark):
    """One key for half of the rows: ordinals, firsts and running values as plain loops have them, over many ranges."""
    rows = [(i, "hot" if i % 2 else f"k{i % 30}" if i % 7 else None, "" if i % 3 else f"v{i}") for i in range(600)]
    frame = spark.createDataFrame(rows, "i int, k string, v string").repartition(7)
    seen, last, expected = {}, {}, {}
    for i, k, v in rows:
        seen[k] = seen.get(k, 0) + 1
        last[k] = v or last.get(k)
        expected[i] = (seen[k], last[k])
    numbered = {r.i: r.n for r in reduce.with_ordinal(frame, ["k"], ["i"]).collect()}
    running = {r.i: r.now for r in reduce.with_running_last(frame, {"now": "v"}, ["k"], ["i"]).collect()}
    assert {i: (numbered[i], running[i]) for i in numbered} == expected
    for out, want in ((reduce.mark_duplicates(frame, "k", ["i"], "x"), lambda n: n > 1), (reduce.mark_best(frame, "k", ["i"], "x"), lambda n: n == 1)):
        assert {r.i: r.x for r in out.collect()} == {i: k is not None and want(expected[i][0]) for i, k, _ in rows}
    # Of rows that agree in everything, one is the best.
    assert reduce.mark_best(frame.withColumn("i", F.lit(1)).filter("k = 'hot'"), "k", ["i"], "x").filter("x").count() == 1
