"""Licence scan by ordered signature rules (operator 4), in DataFrame functions only.

One pattern of all keywords is searched first; only rules whose keyword occurs are matched. Each match is a detection
with its place and its rule's priority. A detection is suppressed when its interval lies within that of a detection of
a higher priority, or of the same priority that is longer or, at the same place, of an earlier rule. What is left gives
the labels.

Texts are looked at once, and only numbers leave that step: counts of words, and for each rule that matches the lengths
of its matches and of what lies between them. Places are running sums of these, and suppression is a running maximum of
ends by priority, both as windows over the rows of a text, so time is linear in a text and its detections (but for a
sort), and a window holds no list. Texts without detections, nearly all, are not shuffled at all.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.license_rules import GAP, PRIORITIES, rules
from sedimenta.session import cut_lineage

WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
#: Base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
_EDGE = r"(?<![0-9A-Za-z\x{80}-\x{10FFFF}])", r"(?![0-9A-Za-z\x{80}-\x{10FFFF}])"
BASE = f"(?i){_EDGE[0]}(?:{'|'.join(p.replace(' ', GAP) for p in PHRASES)}){_EDGE[1]}"
_TOP = float(max(PRIORITIES))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD))


def _base(text: Column) -> Column:
    """A struct (n_base, first_word, last_word, labels) of the base phrases."""
    found = lambda x: F.regexp_extract_all(x, F.lit(BASE), F.lit(0))
    place = lambda parts, hits: F.struct(
        F.size(hits).cast("long").alias("n_base"),
        _words(parts[0]).cast("long").alias("first_word"),
        (_words(text) - _words(F.element_at(parts, -1)) - _words(F.element_at(hits, -1))).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(F.transform(hits, _label_of))).alias("labels"),
    )
    return F.when(text.rlike(BASE), let(F.split(text, BASE, -1), lambda parts: let(found(text), lambda hits: place(parts, hits))))


def _label_of(hit: Column) -> Column:
    kind = F.lower(F.substring(hit, 1, 1))
    initial = {p[0]: label for p, label in PHRASES.items()}
    return F.coalesce(*(F.when(kind == c, F.lit(label)) for c, label in initial.items()))


def _rule_table() -> Column:
    rows = [F.struct(F.lit(i).alias("rule"), F.lit(squeeze(keyword)).alias("keyword"), F.lit(pattern).alias("pattern")) for i, (_, _, keyword, pattern) in enumerate(rules())]
    return F.array(*rows)


_LENGTHS = "array<struct<rule:int,matches:array<int>,between:array<int>>>"


def _lengths(text: Column, keywords: str) -> Column:
    """For each rule that matches: its number, the lengths of its matches, the lengths of what lies before, between and after them."""
    none = F.array().cast(_LENGTHS)

    def of_rule(rule: Column) -> Column:
        hits = F.regexp_extract_all(text, rule["pattern"], F.lit(0))
        between = lambda h: F.when(F.size(h) > 0, F.transform(F.split(text, rule["pattern"], -1), F.length))
        return let(hits, lambda h: F.struct(rule["rule"].alias("rule"), F.transform(h, F.length).alias("matches"), between(h).alias("between")))

    # The keywords of a place are the longest one and those that it begins with.
    found = F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(keywords), F.lit(1)), lambda k: F.lower(F.regexp_replace(k, GAP, " "))))
    live = lambda known: F.filter(_rule_table(), lambda r: F.exists(known, lambda k: F.startswith(k, r["keyword"])))
    detect = let(found, lambda known: F.filter(F.transform(live(known), of_rule), lambda x: F.size(x["matches"]) > 0))
    return F.when(text.rlike(keywords), detect.cast(_LENGTHS)).otherwise(none)


def _detections(rows: DataFrame) -> DataFrame:
    """(row, found) of (row, lengths): the detections that are left, in order of their place."""
    table = rules()
    label, priority = (F.element_at(F.array(*(F.lit(r[k]) for r in table)), F.col("rule") + 1) for k in (0, 1))
    pairs = rows.select("row", F.explode("lengths").alias("x")).select("row", "x.rule", F.posexplode(F.arrays_zip("x.matches", "x.between")).alias("at", "p")).filter("p.matches is not null")
    upto = Window.partitionBy("row", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.col("p.matches") + F.col("p.between")).over(upto)
    placed = pairs.select("row", "rule", stop.alias("stop"), F.col("p.matches").alias("size"), label.alias("label"), priority.alias("priority")).withColumn("start", F.col("stop") - F.col("size"))
    # Whatever contains a detection comes before it in this order, or is at the same place and stronger.
    before = Window.partitionBy("row").orderBy("start", F.desc("stop"), F.desc("priority"), "rule").rowsBetween(Window.unboundedPreceding, -1)
    far = {k: F.max(F.when(F.col("priority") == k, F.col("stop"))).over(before) for k in PRIORITIES}
    inside = F.lit(False)
    for k, stop in far.items():
        inside = inside | F.coalesce((F.col("priority") <= k) & (stop >= F.col("stop")), F.lit(False))
    order = F.struct("start", (-F.col("stop")).alias("e"), "rule", "priority", "label")
    left = placed.withColumn("inside", inside).filter("not inside").groupBy("row").agg(F.sort_array(F.collect_list(order)).alias("d"))
    return left.select("row", F.transform("d", lambda d: F.struct(d["start"].cast("int").alias("start"), (-d["e"]).cast("int").alias("stop"), d["rule"].alias("rule"), d["priority"].alias("priority"), d["label"].alias("label"))).alias("found"))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, detections, labels, score), a row for each row of docs.

    Words are runs of ASCII letters and digits and of any characters beyond ASCII. detections holds the detections
    that are left, as structs (start, stop, rule, priority, label), start and stop in characters of the text. labels
    are the distinct labels of base phrases and detections, sorted and joined by commas; score is the highest
    priority among detections over 4, at least 0.75 with a base phrase, 0 without either. Null counts as empty: no
    words, null first_word and last_word, empty labels, score 0. Repeated rows give repeated rows, an empty table none;
    columns other than the two named are not read. A text of any length is searched whole, within what a task's JVM
    needs for its characters and, for texts with base phrases, a copy of them.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    text = F.col("text")
    read = base.select("doc_id", _words(text).cast("long").alias("n_words"), _base(text).alias("base"), _lengths(text, keyword_pattern()).alias("lengths"))
    # Written, so that texts are looked at once and a row keeps its number.
    read = cut_lineage(read.withColumn("row", F.monotonically_increasing_id()))
    none = F.array().cast("array<struct<start:int,stop:int,rule:int,priority:int,label:string>>")
    some = read.filter(F.size("lengths") > 0)
    found = some.drop("lengths").join(_detections(some), "row").drop("row")
    out = read.filter(F.size("lengths") == 0).drop("lengths", "row").withColumn("found", none).unionByName(found)
    labels, empty = F.col("base.labels"), F.array().cast("array<string>")
    strongest = F.coalesce(F.array_max(F.transform("found", lambda d: d["priority"])), F.lit(0)) / F.lit(_TOP)
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("base.n_base", F.lit(0).cast("long")).alias("n_base"),
        F.col("base.first_word").alias("first_word"),
        F.col("base.last_word").alias("last_word"),
        F.array_join(F.coalesce(labels, empty), ",").alias("base_labels"),
        F.col("found").alias("detections"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(F.coalesce(labels, empty), F.transform("found", lambda d: d["label"])))), ",").alias("labels"),
        F.greatest(strongest, F.when(F.col("base").isNotNull(), F.lit(0.75)).otherwise(F.lit(0.0))).alias("score"),
    )


def squeeze(keyword: str) -> str:
    return " ".join("".join(c if c.isalnum() else " " for c in keyword).split())


def keyword_pattern() -> str:
    """A pattern whose group 1 is, at each place where a keyword begins, the longest one; nothing is used up, so the next place may be within it."""
    return f"(?i){_EDGE[0]}(?=({_trie(sorted({squeeze(k) for _, _, k, _ in rules()}))}))"


def _trie(words: list[str]) -> str:
    """A pattern for the beginnings of words, longest first, with common beginnings taken together so that few choices are tried at a place."""
    by_first: dict[str, list[str]] = {}
    for word in words:
        if word:
            by_first.setdefault(word[0], []).append(word[1:])
    parts = [(GAP if first == " " else first) + _trie(rest) for first, rest in sorted(by_first.items())]
    if "" in words:
        parts.append("")
    return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"
