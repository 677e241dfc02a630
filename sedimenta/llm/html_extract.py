"""Main text of web pages by equivalence-class template deduction (operator 3).

A page is a sequence of tokens: tags and text nodes, each with the containers around it. The occurrence vector of a
token tells how often each distinct page of a host has it; pages with the same text are copies and count once, for
what copies share is their article as much as their template. Tokens of one host with equal vectors form an
equivalence class; classes that are large (MIN_SIZE tokens) and frequent (SHARE of the host's pages, MIN_PAGES at
least) are taken for the template from which the pages were made. Vectors are never built: a token's pages each add
two 31-bit hashes of (page, count) to sums, which partial aggregation makes small before any shuffle, and tokens with
equal sums and numbers of pages are a class.

On a page a class is valid if its tokens, once each there, nest with those of larger classes: all of it lies in one
gap between neighbouring tokens of the other. Valid classes form the page's template, nested; the gaps that are left
are its slots. Over all pages of a host the template's containers are weighed by the text that is not link text: the
innermost one that holds most of it (MAIN_SHARE) is the host's main container.

Where a template is known, it decides what is looked at: an article container of the template before those that only
a slot holds (cards, comments), then the main container, whose slots are the article. Names of containers (tags, roles,
words of class and id) rank what the template leaves open, take out what a slot has of other purposes, and decide
alone where a host has too few pages for a template. Text of the template is not article text, except inside an
article container, where it is dropped only if it is a notice: in nearly all of many pages (WIDE_SHARE, WIDE_PAGES)
and less than half of that article.
"""

from __future__ import annotations

import html as html_lib
import re
from array import array
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm import exact_dedup, vectext
from sedimenta.session import cut_lineage

MIN_SIZE, MIN_PAGES, SHARE = 3, 3, 0.5
MAIN_SHARE = 0.6
WIDE_PAGES, WIDE_SHARE = 10, 0.9
#: Tokens of all templates that are broadcast at most (24 bytes each); more meet their pages in a salted join.
BROADCAST_TOKENS = 200_000
#: A host with more than one in so many pages has as many salts as it has such parts; so at most that many hosts have any.
HOT_PARTS = 1000
#: Tags whose quotes don't close, after which quotes of a page are no longer heeded.
LOOSE = 16

_OPEN = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|/(?![a-zA-Z])|(/?)([a-zA-Z][a-zA-Z0-9:-]*))")
_TAG_STOP = re.compile(r">|=\s*([\"'])")
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
#: Their content is not markup, and never text of an article. The second ones may hold others of their kind.
_RAW = {"script", "style", "noscript", "textarea", "iframe", "noframes", "title"} | (_NESTING := {"svg", "math", "object", "canvas", "template"})
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Tags that hold others and give a token its path.
_CONTAINER = {"html", "head", "body", "div", "section", "article", "main", "nav", "header", "footer", "aside", "form", "ul", "ol", "table", "dl", "fieldset", "dialog", "menu", "details", "button", "select", "label", "figure", "blockquote", "center"}
#: Tags at which a block of text begins and ends.
_BLOCK = _CONTAINER - {"label", "button", "select"} | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "tr", "td", "th", "thead", "tbody", "tfoot", "caption", "dt", "dd", "pre", "hr", "address", "figcaption", "summary", "hgroup", "option", "legend"}
#: Containers of other purposes, by tag, by role, by words of class or id. An article within a wrapper may still be the article.
_OTHER_TAG = {"head", "nav", "footer", "aside", "menu", "dialog", "button", "select"}
_OTHER_ROLE = {"navigation", "banner", "contentinfo", "complementary", "dialog", "alert"}
_WRAPPER_TAG, _WRAPPER_ROLE = {"form", "fieldset"}, {"form", "search"}
_ASIDE_WORD = {
    *"ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promotion promoted banner".split(),
    *"comment comments discussion disqus replies reply respond related recommended recommendations".split(),
}
_WRAPPER_WORD = {
    *"cookie cookies consent gdpr notice notices alert popup modal overlay share sharing social newsletter".split(),
    *"subscribe subscription signup login search pager pagination tags copyright legal disclaimer".split(),
}
#: Words that name other containers, or the layout of a container that holds them and the article too: an article within such a one is one.
_LAYOUT_WORD = {*"nav navbar navigation menu breadcrumb breadcrumbs sidebar side widget widgets footer header masthead toolbar topbar".split()}
#: What a container is for, by how surely it is not the article.
_LAYOUT, _WRAPPER, _ASIDE, _SURE = 1, 2, 3, 4
_WORDS = re.compile(r"[a-z]+")
#: What is not text of a page (Java): raw content, comments, tags, white space.
_NOT_TEXT = rf"(?is)<({'|'.join(sorted(_RAW))})\b.*?(?:</\1|\z)|<!--.*?(?:-->|\z)|<[/!?]?[a-z][^>]*>|\s+"


def host_of(url: Column) -> Column:
    """The host of a URL in lower case, without user and port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def text_of(html: Column) -> Column:
    """A hash that pages with the same text share, whatever their tags, attributes and white space."""
    return F.xxhash64(F.regexp_replace(html, _NOT_TEXT, ""))


@dataclass
class Node:
    """A container: its parent's number, place and hash of its token, hash of its path, purpose, whether it is (or is within) an article container, its own text outside links.

    Tokens of tags are told apart by the number of their container among equal siblings, and so all the way up; those
    of text nodes are not, for a container that is not on all pages moves the numbers of those after it.
    """

    parent: int
    place: int
    token: int
    path: int
    purpose: int
    starts: bool
    within: bool
    chars: int = 0


@dataclass
class Template:
    """What is known of a host: the classes of its tokens, those of notices, and the token of the main container."""

    classes: dict[int, int] = field(default_factory=dict)
    wide: set[int] = field(default_factory=set)
    main: int | None = None


def _tags(source: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, stop, name, closing, attributes) of each tag (with its content, if that is raw), comment and declaration (these without a name); linear in the text."""
    at, loose = 0, 0
    last = {q: source.rfind(q) for q in "\"'"}
    while m := _OPEN.search(source, at):
        start, name = m.start(), m.group(2)
        if not name:
            mark, skip = ("-->", 2) if m.group().startswith("<!--") else ("]]>", 9) if m.group().startswith("<![") else (">", 2)
            stop = source.find(mark, start + skip)
            if stop < 0 and mark == ">":  # no markup
                at = m.end()
                continue
            at = len(source) if stop < 0 else stop + len(mark)
            yield start, at, "", False, ""
            continue
        place, stop = m.end(), -1
        while loose < LOOSE and (end := _TAG_STOP.search(source, place)):
            if not (quote := end.group(1)):
                stop = end.start()
                break
            place = source.find(quote, end.end()) + 1 if end.end() <= last[quote] else end.end()
        if stop < 0:
            loose += 1
            stop = source.find(">", m.end())
            if stop < 0:  # no tag ends any more: the rest is text
                return
        at, name = stop + 1, name.lower()
        if name in _RAW and not m.group(1) and not (name in ("svg", "math") and source[stop - 1] == "/"):
            at = _raw_end(source, at, name)
        yield start, at, name, bool(m.group(1)), source[m.end() : stop]


def _raw_end(source: str, at: int, name: str) -> int:
    """Where the content of a raw element ends."""
    depth = 1
    for m in re.compile(rf"<(/?){name}(?=[\s/>])", re.I).finditer(source, at):
        if m.group(1):
            depth -= 1
        elif name in _NESTING:
            depth += 1
        if not depth:
            return m.start()
    return len(source)


class Page:
    """The tokens of a page in order, its containers, and its text nodes."""

    def __init__(self, source: str):
        self.tokens = array("Q")
        #: The first one stands for the page itself.
        self.nodes = [Node(0, -1, 0, 0, 0, False, False)]
        self._siblings: dict[tuple[int, str], int] = defaultdict(int)
        #: (place in tokens or -1 for white space, number of the block, number of the container, raw text)
        self.texts: list[tuple[int, int, int, str]] = []
        self._parse(source)

    def _parse(self, source: str) -> None:
        stack, tags = [0], [""]
        opened: dict[str, int] = defaultdict(int)
        block, at, link = 0, 0, False
        digest, put, texts, nodes = xxhash.xxh64_intdigest, self.tokens.append, self.texts, self.nodes
        for start, stop, tag, closing, attributes in _tags(source):
            if start > at:
                self._text(source[at:start], block, stack[-1], link)
            at = stop
            if not tag:
                continue
            here = nodes[stack[-1]].token
            if tag in _BLOCK:
                block, link = block + 1, False
            elif tag == "br":
                texts.append((-1, block, stack[-1], " "))
            elif tag == "a":
                link = not closing
            if tag not in _CONTAINER:
                put(digest(f"{here}<{'/' if closing else ''}{tag}"))
                continue
            if closing:
                if opened[tag]:
                    while True:
                        gone = tags.pop()
                        stack.pop()
                        opened[gone] -= 1
                        if gone == tag:
                            break
                put(digest(f"{nodes[stack[-1]].token}</{tag}"))
                continue
            nodes.append(self._node(tag, attributes, stack[-1]))
            put(nodes[-1].token)
            stack.append(len(nodes) - 1)
            tags.append(tag)
            opened[tag] += 1
        if at < len(source):
            self._text(source[at:], block, stack[-1], link)

    def _text(self, text: str, block: int, node: int, link: bool) -> None:
        if text.isspace():
            self.texts.append((-1, block, node, " "))
            return
        self.texts.append((len(self.tokens), block, node, text))
        self.tokens.append(xxhash.xxh64_intdigest(f"{self.nodes[node].path}#{' '.join(text.split())}"))
        if not link:
            self.nodes[node].chars += len(text.strip())

    def _node(self, tag: str, attributes: str, parent: int) -> Node:
        named = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)} if attributes else {}
        above = self.nodes[parent]
        kind, role = named.get("class", "").lower(), named.get("role", "").lower()
        words = {*_WORDS.findall(kind), *_WORDS.findall(named.get("id", "").lower())}
        starts = tag in ("article", "main") or role in ("main", "article")
        if above.within:  # an article's own header holds its title
            words.discard("header")
        purpose = 0
        if tag in ("html", "body"):
            pass
        elif tag in _OTHER_TAG or role in _OTHER_ROLE or "hidden" in attributes.lower().split() or tag == "header" and not above.within:
            purpose = _SURE
        elif words & _ASIDE_WORD:
            purpose = _ASIDE
        elif tag in _WRAPPER_TAG or role in _WRAPPER_ROLE or words & _WRAPPER_WORD:
            purpose = _WRAPPER
        elif not starts and words & _LAYOUT_WORD:
            purpose = _LAYOUT
        signature = f"{tag}.{'.'.join(sorted(kind.split()))}.{role}"
        number = self._siblings[parent, signature]
        self._siblings[parent, signature] = number + 1
        token, path = xxhash.xxh64_intdigest(f"{above.token}/{signature}/{number}"), xxhash.xxh64_intdigest(f"{above.path}/{signature}")
        return Node(parent, len(self.tokens), token, path, purpose, starts, starts or above.within)

    def weights(self) -> dict[int, tuple[int, int]]:
        """(text outside links in it, place) of each container, by token."""
        chars = [n.chars for n in self.nodes]
        for k in range(len(chars) - 1, 0, -1):
            chars[self.nodes[k].parent] += chars[k]
        return {n.token: (c, n.place) for n, c in zip(self.nodes[1:], chars[1:], strict=True)}

    def template(self, classes: dict[int, int]) -> set[int]:
        """Places of tokens that belong to valid classes, of those that classes names by token."""
        found: dict[int, list[int]] = defaultdict(list)
        for place, token in enumerate(self.tokens):
            if token in classes:
                found[token].append(place)
        places: dict[int, list[int]] = defaultdict(list)
        for token, own in found.items():
            if len(own) == 1:
                places[classes[token]].append(own[0])
        valid: list[list[int]] = []
        for own in sorted((sorted(x) for x in places.values()), key=lambda x: (-len(x), x)):
            if len(own) >= 2 and all(bisect_left(more, own[0]) == bisect_left(more, own[-1]) or bisect_left(own, more[0]) == bisect_left(own, more[-1]) for more in valid):
                valid.append(own)
        return {p for own in valid for p in own}

    def _inside(self, roots: set[int], lenient: bool = False) -> list[tuple[int, int]]:
        """By container (the root that it lies in or 0, purpose of the containers between); lenient: wrappers between count for nothing."""
        out = [(0, 0)]
        for k, node in enumerate(self.nodes[1:], 1):
            root, purpose = out[node.parent]
            if k in roots or not root:
                out.append((k, 0) if k in roots else (0, 0))
            elif node.starts and purpose <= _LAYOUT and node.purpose <= _LAYOUT:
                out.append((root, 0))
            else:
                out.append((root, max(purpose, 0 if lenient and node.purpose == _WRAPPER else node.purpose)))
        return out

    def _lengths(self, inside: list[tuple[int, int]]) -> dict[int, int]:
        out: dict[int, int] = defaultdict(int)
        for place, _, node, text in self.texts:
            if place >= 0 and inside[node][0] and not inside[node][1]:
                out[inside[node][0]] += len(text.strip())
        return out

    def _around(self) -> list[int]:
        """By container, the purpose of itself and all around it."""
        out = [0]
        for node in self.nodes[1:]:
            out.append(max(out[node.parent], node.purpose))
        return out

    def _articles(self, fixed: set[int], main: int, neutral: int, around: list[int]) -> set[int]:
        """The containers that are the article; none if the page has no such container, or it is not worth it."""
        nodes = self.nodes
        tops = {k for k, n in enumerate(nodes) if n.starts and not nodes[n.parent].within}
        for _ in range(8):  # what holds no text but another article container gives way to it
            lengths = self._lengths(self._inside(tops))
            empty = {k for k in tops if not lengths[k]}
            inner = {k for k, n in enumerate(nodes) if n.starts and k not in tops and self._next_start(k) in empty} if empty else set()
            if not inner:
                break
            tops = (tops - empty) | inner
        # One of the template, of which the page has no other of the same kind beside it, as cards are.
        paths = Counter(nodes[k].path for k in tops)
        if known := {k for k in tops if nodes[k].place in fixed and lengths[k] and paths[nodes[k].path] == 1}:
            tops = known
        elif main:
            tops = {k for k in tops if self._is_in(k, main)}
        # So may be one within another, of which only its own words say that it is something else.
        inside = self._inside(tops)
        named = [k for k, n in enumerate(nodes) if n.starts and k not in tops and n.purpose and inside[n.parent][0] and inside[n.parent][1] <= _LAYOUT]
        if len(named) == 1:
            both = self._lengths(self._inside(tops | set(named)))
            if both[named[0]] > both[inside[nodes[named[0]].parent][0]]:
                lengths, tops = both, tops | set(named)
                around = [*around]
                around[named[0]] = around[nodes[named[0]].parent]
        full = {k for k in tops if lengths[k]}
        clean = {k for k in full if around[k] <= _LAYOUT}
        wrapped = {k for k in full if around[k] == _WRAPPER}
        best = clean or wrapped
        amount = sum(lengths[k] for k in best)
        # One that a word or a tag says is something else has to be the only one, and most of the text.
        rest = full - best
        if best or neutral:
            rest = {k for k in rest if around[k] < _SURE}
        if len(rest) == 1 and (only := next(iter(rest))) and lengths[only] > (amount or neutral):
            return best | rest
        return best if best or neutral else rest

    def _next_start(self, k: int) -> int:
        k = self.nodes[k].parent
        while k and not self.nodes[k].starts:
            k = self.nodes[k].parent
        return k

    def _is_in(self, k: int, root: int) -> bool:
        while k and k != root:
            k = self.nodes[k].parent
        return k == root

    def article(self, known: Template) -> str:
        """The text in the slots of the article: blocks joined by blank lines."""
        fixed = self.template(known.classes) if known.classes else set()
        around = self._around()
        main = next((k for k, n in enumerate(self.nodes) if k and n.token == known.main and n.place in fixed and around[k] < _ASIDE), 0)
        slots = [t for t in self.texts if t[0] not in fixed and around[t[2]] == 0]
        neutral = sum(len(t[3].strip()) for t in slots if t[0] >= 0)
        roots, lenient = self._articles(fixed, main, neutral, around), False
        if not roots and not neutral and not main:  # perhaps all of it is in a form within the article container
            roots, lenient = {k for k, n in enumerate(self.nodes) if n.starts and not self.nodes[n.parent].within}, True
        if roots:
            inside = self._inside(roots, lenient)
            chosen = [t for t in self.texts if inside[t[2]][0] and not inside[t[2]][1]]
            notices = {t[0] for t in chosen if t[0] in fixed and self.tokens[t[0]] in known.wide}
            if notices and 2 * sum(len(t[3]) for t in chosen if t[0] in notices) < sum(len(t[3].strip()) for t in chosen):
                chosen = [t for t in chosen if t[0] not in notices]
        elif main:
            inside = self._inside({main})
            chosen = [t for t in self.texts if inside[t[2]][0] and not inside[t[2]][1] and t[0] not in fixed]
        else:
            chosen = slots
        blocks: dict[int, list[str]] = {}
        for _, block, _, text in chosen:
            blocks.setdefault(block, []).append(html_lib.unescape(text) if "&" in text else text)
        out = (" ".join("".join(parts).split()) for parts in blocks.values())
        return "\n\n".join(b for b in out if b)


_SUMS = ("a", "b", "chars", "place")
_VECTORS = "host string, copy long, token long, a long, b long, chars long, place long"


def _vectors(batches):
    """(host, page, html, whether there may be copies of the page) to a row for each host and distinct token of a page: two hashes of (page, count), and a container's text and place. copy is the page, where it may have copies."""
    for batch in batches:
        for start, stop in vectext.blocks(batch.column(2)):
            hosts, columns = [], []
            for host, page, source in zip(*(batch.column(k).slice(start, stop - start).to_pylist() for k in range(3)), strict=True):
                parsed = Page(source or "")
                tokens, counts = np.unique(np.frombuffer(parsed.tokens, np.uint64), return_counts=True)
                mixed = vectext.mix(vectext.mix(counts.astype(np.uint64)) ^ np.uint64(page & (1 << 64) - 1))
                weights = np.zeros((2, len(tokens)), np.int64)
                if found := parsed.weights():
                    at = np.searchsorted(tokens, np.array(list(found), np.uint64))
                    weights[:, at] = np.array(list(found.values()), np.int64).T
                hosts.append(np.full(len(tokens), len(hosts)))
                columns.append(np.stack([tokens.view(np.int64), (mixed & np.uint64(0x7FFFFFFF)).view(np.int64), (mixed >> np.uint64(33)).view(np.int64), *weights]))
            joined = np.hstack(columns) if columns else np.zeros((5, 0), np.int64)
            rows = pa.array(np.concatenate(hosts) if hosts else np.zeros(0, np.int64), pa.int64())
            part = batch.slice(start, stop - start)
            copies = pc.if_else(part.column(3), part.column(1), pa.scalar(None, pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column(0).take(rows), copies.take(rows), *(pa.array(c) for c in joined)], ["host", "copy", "token", *_SUMS])


def templates(pages: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, tokens, classes, wide, main) of (host, page, html): tokens of large and frequent classes, the numbers of the
    classes, whether they are in nearly all of many pages, and the token of the main container.

    Rows with the same host and page are copies and count as one page; counts is (host, page, n). Pages with copies are
    known by a bitmap, and their tokens are first taken together by page; a false bit does no harm. A token that is in
    SHARE of the host's pages can only be one of 1 / SHARE times the tokens of a page, so the lists are bounded by the
    size of pages whatever the number of pages.
    """
    several = cut_lineage(counts.filter("n > 1"))
    size = exact_dedup.rows_for(several.count())
    pages = exact_dedup.marked(pages, cut_lineage(exact_dedup.bitmap(several, size, "host", "page")), size, "_maybe", "host", "page")
    rows = pages.select("host", "page", "html", "_maybe").mapInArrow(_vectors, _VECTORS)
    once = rows.groupBy("host", "token", "copy").agg(F.count("*").alias("pages"), *(F.sum(c).alias(c) for c in _SUMS), *(F.min(c).alias(f"one_{c}") for c in _SUMS))
    once = once.select("host", "token", *(F.when(F.col("copy").isNull(), F.col(c)).otherwise(o).alias(c) for c, o in (("pages", F.lit(1)), *((c, F.col(f"one_{c}")) for c in _SUMS))))
    vectors = once.groupBy("host", "token").agg(F.sum("pages").alias("pages"), *(F.sum(c).alias(c) for c in _SUMS)).filter(F.col("pages") >= MIN_PAGES)
    sizes = counts.groupBy("host").agg(F.count("*").alias("all"))
    frequent = cut_lineage(vectors.join(sizes, "host").filter(F.col("pages") >= SHARE * F.col("all")))
    large = frequent.groupBy("host", "pages", "a", "b").agg(F.count("*").alias("size"), F.min("token").alias("class")).filter(F.col("size") >= MIN_SIZE)
    kept = frequent.join(large, ["host", "pages", "a", "b"])
    kept = kept.withColumn("wide", (F.col("all") >= WIDE_PAGES) & (F.col("pages") >= WIDE_SHARE * F.col("all")))
    lists = kept.groupBy("host").agg(F.collect_list(F.struct("token", "class", "wide", "chars", "place")).alias("t"))
    most = F.array_max(F.transform("t", lambda t: t["chars"]))
    # The innermost one: it has the least text of those with most of it, and of equal ones it comes last.
    holders = F.transform(F.filter("t", lambda t: (t["chars"] > 0) & (t["chars"] >= MAIN_SHARE * F.col("most"))), lambda t: F.struct(t["chars"].alias("c"), (-t["place"]).alias("p"), t["token"].alias("token")))
    lists = lists.withColumn("most", most).withColumn("main", F.array_min(holders)["token"])
    return cut_lineage(lists.select("host", F.col("t.token").alias("tokens"), F.col("t.class").alias("classes"), F.col("t.wide").alias("wide"), "main"))


def _unsigned(x: int | None) -> int | None:
    return None if x is None else x & (1 << 64) - 1


def _extract(batches):
    """(host, html, tokens, classes, wide, main, ...) to the rest and the text."""
    for batch in batches:
        names = batch.schema.names[6:]
        for start, stop in vectext.blocks(batch.column(1)):
            known: dict[str, Template] = {}
            texts = []
            part = batch.slice(start, stop - start)
            for i, (host, source) in enumerate(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)):
                if host not in known:
                    tokens, classes, wide, main = (part.column(k)[i].as_py() for k in range(2, 6))
                    tokens = [_unsigned(t) for t in tokens or ()]
                    known[host] = Template(dict(zip(tokens, classes or (), strict=True)), {t for t, w in zip(tokens, wide or (), strict=True) if w}, _unsigned(main))
                texts.append(Page(source or "").article(known[host]))
            yield pa.RecordBatch.from_arrays([*part.columns[6:], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*names, "text", "n_chars"])


def _with_templates(pages: DataFrame, found: DataFrame, counts: DataFrame) -> DataFrame:
    """pages with their host's template: a broadcast if all templates are small, else a join in which hot hosts are dealt over salts."""
    tokens = found.agg(F.sum(F.size("tokens"))).first()[0] or 0
    if tokens <= BROADCAST_TOKENS:
        return pages.join(F.broadcast(found), "host", "left")
    sizes = counts.groupBy("host").agg(F.sum("n").alias("rows"))
    part = (sizes.agg(F.sum("rows")).first()[0] or 0) / HOT_PARTS
    # Fewer than HOT_PARTS hosts can have more than one in HOT_PARTS of the rows.
    hot = F.broadcast(cut_lineage(sizes.filter(F.col("rows") > part).select("host", F.ceil(F.col("rows") / part).alias("salts"))))
    dealt = pages.join(hot, "host", "left").withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.coalesce("salts", F.lit(1)))).drop("salts")
    again = found.join(hot, "host", "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
    return dealt.join(again, ["host", "salt"], "left")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), a row for each row of pages.

    Character references are decoded, white space inside a block becomes one space, blocks are joined by blank lines.
    Null html counts as empty and gives an empty text. Pages without a host (null or malformed URLs) are taken for
    one site. Repeated rows and pages with the same text count as one page. Hosts with fewer than MIN_PAGES distinct
    pages have no template; their articles are found by containers alone. An empty table gives no rows. A page of any
    length is read whole, in time linear in it whatever its mark-up is like; a worker holds one long page, its text
    nodes and 8 bytes for each of its tokens. Further columns of pages are not read.
    """
    base = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html")).withColumn("host", host_of(F.col("url")))
    texts = base.select("host", text_of(F.col("html")).alias("page"), "html")
    counts = cut_lineage(texts.groupBy("host", "page").agg(F.count("*").alias("n")))
    joined = _with_templates(base, templates(texts, counts), counts).select("host", "html", "tokens", "classes", "wide", "main", "page_id", "url")
    kind = pages.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(_extract, f"page_id {kind}, url string, text string, n_chars long")
