"""Text functions as Column expressions. Python is used only where Java has no equal (see udfs.py)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sedimenta.functions import udfs

#: White space as Unicode has it, and the four separators that count as such too.
SPACE = r"[\s\x1c-\x1f]"


def _text(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def strip(value: Column) -> Column:
    """Without white space at both ends (Unicode's, not only spaces)."""
    return F.regexp_replace(value, rf"(?U)\A{SPACE}+|{SPACE}+\z", "")


def collapse(value: Column) -> Column:
    """Runs of any white space become one space; none at the ends."""
    return strip(F.regexp_replace(value, rf"(?U){SPACE}+", " "))


def unescape(value: Column) -> Column:
    """Character references decoded, all names and numbers. Texts without '&' come back as they are."""
    return udfs.unescape(_text(value))


def squeeze(value: Column) -> Column:
    """White space without decoding: no carriage returns, no-break spaces are spaces, runs of blanks are one, three or more line ends are two."""
    value = F.replace(_text(value), F.lit("\r"), F.lit(""))
    value = F.replace(value, F.lit(" "), F.lit(" "))
    value = F.regexp_replace(value, r"[ \t]+", " ")
    return strip(F.regexp_replace(value, r"\n{3,}", "\n\n"))


def normalize_whitespace(value: Column) -> Column:
    """Decoded, then squeezed; null is empty. Not idempotent, as it decodes each time."""
    return squeeze(unescape(value))


def strip_markup(value: Column) -> Column:
    """Markup to line ends and blanks: scripts and styles go, br and tr end lines, p ends paragraphs, td is a blank, other tags go."""
    value = F.regexp_replace(_text(value), r"(?is)<(script|style)\b.*?</\1>", "")
    for pattern, text in ((r"(?i)<br\s*/?>", "\n"), (r"(?i)</p\s*>", "\n\n"), (r"(?i)</tr\s*>", "\n"), (r"(?i)</td\s*>", " "), (r"(?s)<[^>]+>", "")):
        value = F.regexp_replace(value, pattern, text)
    return value


def html_to_text(value: Column, closed: bool = False) -> Column:
    """The text of a piece of HTML; tags go before references are decoded. With closed, only references that end in a semicolon are."""
    plain = strip_markup(value)
    return squeeze(udfs.unescape_closed(plain)) if closed else normalize_whitespace(plain)


def _references(value: Column, *pairs: tuple[str, str]) -> Column:
    for name, text in pairs:
        value = F.replace(value, F.lit(name), F.lit(text))
    return value


def html_to_text_basic(value: Column) -> Column:
    """As html_to_text, but only four references are decoded, in this order (signature footers)."""
    return squeeze(_references(strip_markup(value), ("&nbsp;", " "), ("&amp;", "&"), ("&quot;", '"'), ("&#39;", "'")))


def html_to_line(value: Column) -> Column:
    """One line of text, four references (breadcrumbs)."""
    value = F.regexp_replace(_text(value), r"(?i)<br\s*/?>", "\n")
    value = F.regexp_replace(value, r"(?s)<[^>]+>", "")
    return collapse(_references(value, ("&nbsp;", " "), ("&gt;", ">"), ("&lt;", "<"), ("&amp;", "&")))


def markup_to_text(value: Column) -> Column:
    """The text of forum markup in square brackets: images and links keep their addresses, other marks go."""
    value = unescape(value)
    for pattern, text in ((r"(?is)\[img\](.*?)\[/img\]", " $1 "), (r"(?is)\[url=(.*?)\](.*?)\[/url\]", " $2 ($1) "), (r"(?is)\[url\](.*?)\[/url\]", " $1 "), (r"(?s)\[[^\]]+\]", "")):
        value = F.regexp_replace(value, pattern, text)
    return normalize_whitespace(value)


def display_name(value: Column) -> Column:
    """A shown name without the title of a profile page before it; the forum's own name is no name."""
    # Titles of profile pages, and the name of the forum.
    value = F.regexp_replace(normalize_whitespace(value), rf"(?iU)\A(?:{SPACE}*(?:exibir\s+perfil|view\s+profile)\s*::\s*)+", "")
    value = strip(value)
    return F.when(value.rlike(r"(?i)\A(?:f[oÃ³]rum\s+de\s+)?anime\s*-\s*sobresites\z"), "").otherwise(value)


def normalize_alias(value: Column) -> Column:
    """The form in which names are compared: decomposed, without marks, one blank between words, folded."""
    return udfs.fold_alias(normalize_whitespace(value))


def normalize_signature(value: Column) -> Column:
    """The form in which repeated endings are compared: one blank between words, folded."""
    return udfs.casefold(F.regexp_replace(squeeze(value), rf"(?U){SPACE}+", " "))


def split_blocks(value: Column, separator: str = r"\n\s*\n+") -> Column:
    """Non-empty parts between separators, stripped."""
    value = strip(F.replace(_text(value), F.lit("\r"), F.lit("")))
    return F.filter(F.transform(F.split(value, separator, -1), strip), lambda b: b != "")


def join_blocks(blocks: Column, joint: str = "\n\n") -> Column:
    return strip(F.array_join(blocks, joint))


def sort_values(values: Column) -> Column:
    """Distinct values that are not empty, by lower case, then as they are."""
    pairs = F.transform(F.array_distinct(F.filter(values, lambda v: v.isNotNull() & (v != ""))), lambda v: F.struct(F.lower(v).alias("k"), v.alias("v")))
    return F.transform(F.array_sort(pairs), lambda p: p["v"])


def first_int(value: Column) -> Column:
    """The first run of digits as a number, 0 without one."""
    return F.coalesce(F.regexp_extract(_text(value), r"(\d+)", 1).try_cast("long"), F.lit(0).cast("long"))


def ratio(part: Column, whole: Column) -> Column:
    """A share with six digits, halves to even."""
    return F.bround(part / whole, 6)


def first_group(value: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, whatever the case; empty without a match."""
    return F.regexp_extract(_text(value), f"(?i){pattern}", group)


def all_matches(value: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(_text(value), F.lit(pattern), F.lit(group))


def links(value: Column) -> Column:
    """Addresses of links and images, up to '#', distinct and sorted."""
    found = [all_matches(value, rf"(?is)<{tag}\b[^>]*{name}\s*=\s*[\"']?([^\"' >#]+)") for tag, name in (("a", "href"), ("img", "src"))]
    return sort_values(F.transform(udfs.unescape_all(F.array_union(*found)), squeeze))


def emails(value: Column, compat: bool = True) -> Column:
    """Addresses in lower case. With compat, the dot before the last part must be a backslash and any character."""
    dot = r"\\." if compat else r"\."
    return F.array_distinct(F.transform(all_matches(value, rf"(?i)([a-z0-9._%+-]+@[a-z0-9.-]+{dot}[a-z]{{2,}})"), F.lower))


def _safe(value: Column) -> Column:
    value = strip(value)
    value = F.regexp_replace(value, r'[<>:"|?*\x00-\x1f/\\]', "_")
    value = F.regexp_replace(value, rf"(?U){SPACE}+", "_")
    value = F.regexp_replace(F.regexp_replace(value, "_+", "_"), r"\A[._ ]+|[._ ]+\z", "")
    return F.when(value == "", "empty").otherwise(value)


def percent_decode(value: Column) -> Column:
    """Percent sequences decoded as UTF-8; '+' stays; bytes that are not UTF-8 become U+FFFD."""
    return F.when(F.contains(value, F.lit("%")), udfs.unquote(value)).otherwise(value)


def sanitize_token(value: Column) -> Column:
    """A query token as part of a file name; 'empty' if nothing is left."""
    return _safe(F.replace(percent_decode(_text(value)), F.lit("&amp;"), F.lit("&")))


def sanitize_path_component(value: Column) -> Column:
    return _safe(_text(value))


def decode_filename(value: Column) -> Column:
    return F.replace(percent_decode(value), F.lit("&amp;"), F.lit("&"))


def split_name(decoded: Column) -> tuple[Column, Column]:
    """(what stands before the first '?', what stands after it)."""
    at = F.instr(decoded, "?")
    return F.when(at > 0, F.substring_index(decoded, "?", 1)).otherwise(decoded), F.when(at > 0, decoded.substr(at + 1, F.length(decoded))).otherwise("")


def query_pairs(query: Column) -> Column:
    """array<struct<k, v>> of a query in order, both sides sanitised; parts without '=' have an empty value."""
    clean = F.regexp_replace(F.replace(_text(query), F.lit("&amp;"), F.lit("&")), r"\A&+|&+\z", "")
    parts = F.filter(F.split(clean, "&", -1), lambda p: p != "")
    keys = F.transform(parts, lambda p: F.substring_index(p, "=", 1))
    values = F.transform(parts, lambda p: F.when(F.instr(p, "=") > 0, p.substr(F.instr(p, "=") + F.lit(1), F.length(p))).otherwise(""))
    return F.arrays_zip(_tokens(keys).alias("k"), _tokens(values).alias("v"))


def _tokens(sides: Column) -> Column:
    """Sides of a query, decoded and sanitised. Decoding is done twice, as a query's sides and as tokens."""
    blanks = F.transform(sides, lambda x: F.replace(x, F.lit("+"), F.lit(" ")))
    coded = F.exists(sides, lambda x: F.contains(x, F.lit("%")))
    plain = F.when(coded, udfs.unquote_all(udfs.unquote_all(blanks))).otherwise(blanks)
    return F.transform(plain, lambda x: _safe(F.replace(x, F.lit("&amp;"), F.lit("&"))))
