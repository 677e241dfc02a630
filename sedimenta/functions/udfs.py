"""The few functions that Java has no equal for, as Arrow UDFs over whole columns."""

from __future__ import annotations

import html
import re
import unicodedata
from html.entities import html5
from urllib.parse import unquote as _unquote
from urllib.parse import unquote_to_bytes

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _each(function):
    def run(values: pd.Series) -> pd.Series:
        return values.map(function, na_action="ignore")

    return run


unescape = F.pandas_udf(_each(lambda t: html.unescape(t) if "&" in t else t), T.StringType())
unescape_all = F.pandas_udf(_each(lambda a: [html.unescape(t) if "&" in t else t for t in a]), T.ArrayType(T.StringType()))
_CLOSED = re.compile(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[0-9A-Za-z]+);")


def _closed(match: re.Match) -> str:
    name = match[0][1:]
    return html.unescape(match[0]) if name[0] == "#" or name in html5 else match[0]


#: As unescape, but a reference has to end in a semicolon; a name that was cut off, '&amp' without one, stays.
unescape_closed = F.pandas_udf(_each(lambda t: _CLOSED.sub(_closed, t) if "&" in t else t), T.StringType())
unquote = F.pandas_udf(_each(_unquote), T.StringType())
unquote_all = F.pandas_udf(_each(lambda a: [_unquote(t) for t in a]), T.ArrayType(T.StringType()))
casefold = F.pandas_udf(_each(str.casefold), T.StringType())


def _fold(text: str) -> str:
    plain = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return " ".join(plain.split()).casefold()


fold_alias = F.pandas_udf(_each(_fold), T.StringType())


def _percent(text: str) -> str:
    raw = unquote_to_bytes(text.replace("+", " "))
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return raw.decode("cp1252", "replace")


#: '+' is a blank; UTF-8 if the bytes are, else Windows-1252.
url_decode = F.pandas_udf(_each(_percent), T.StringType())

#: Marks of text that was decoded with the wrong one-byte encoding.
_MARKS = ("Ã", "Â", "â€", "ï¿½", "�")


def _marks(text: str) -> int:
    return sum(text.count(m) for m in _MARKS)


def _repaired(text: str) -> str:
    best, least = text, _marks(text)
    for encoding in ("latin-1", "cp1252") if least else ():
        try:
            found = text.encode(encoding).decode("utf-8")
        except (UnicodeEncodeError, UnicodeDecodeError):
            continue
        if _marks(found) < least:
            best, least = found, _marks(found)
    return best


#: UTF-8 that was read as a one-byte encoding, read anew where the round trip is exact and leaves fewer marks.
repair_mojibake = F.pandas_udf(_each(_repaired), T.StringType())

_ONE_BYTE = ("iso-8859-1", "latin-1", "windows-1252", "cp1252")


def _tries(hint: str, mode: str) -> list[str]:
    general = ["utf-8", "cp1252", "latin-1"]
    if mode == "no_hint":
        return general
    if mode == "declared_first":
        return [hint, *general] if hint else general
    if "utf-8" in hint:
        return ["utf-8"]
    return ["cp1252", "latin-1"] if any(name in hint for name in _ONE_BYTE) else general


DECODED = T.StructType([T.StructField(n, T.StringType()) for n in ("text", "decoder", "error")])


def decoder(mode: str = "hint"):
    """(bytes, charset that the page names) to struct(text, decoder, error); never raises.

    hint: a page that says UTF-8 must be it, one that names a one-byte charset is read as Windows-1252 or Latin-1,
    others are tried as UTF-8, Windows-1252, Latin-1. declared_first: the named charset, whichever, is tried before
    these. no_hint: these alone.
    """

    def one(data: bytes | None, hint: str | None) -> dict:
        error = None
        for name in _tries(hint or "", mode):
            try:
                return {"text": bytes(data or b"").decode(name), "decoder": name, "error": None}
            except (UnicodeDecodeError, LookupError) as failure:
                error = str(failure)
        return {"text": None, "decoder": None, "error": error}

    def run(content: pd.Series, hint: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(d, h) for d, h in zip(content, hint, strict=True)], columns=["text", "decoder", "error"])

    run.__annotations__ = {"content": pd.Series, "hint": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(run, DECODED)
