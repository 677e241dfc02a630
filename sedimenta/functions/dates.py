"""Forum dates to local ISO text. Nothing is checked: the 31st of February stays one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sedimenta.functions import text
from sedimenta.functions.once import let

# Month names and their numbers.
MONTHS = {
    "jan": 1, "janeiro": 1, "fev": 2, "fevereiro": 2, "mar": 3, "marco": 3, "abr": 4, "abril": 4, "mai": 5, "maio": 5, "jun": 6, "junho": 6,
    "jul": 7, "julho": 7, "ago": 8, "agosto": 8, "set": 9, "setembro": 9, "out": 10, "outubro": 10, "nov": 11, "novembro": 11, "dez": 12, "dezembro": 12,
}


def _number(name: Column, compat: bool) -> Column:
    months = MONTHS if compat else MONTHS | {"março": 3}
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in months.items() for x in pair)), F.lower(name))


def _pad(value: Column, width: int) -> Column:
    """Longer numbers keep all their digits."""
    plain = value.try_cast("int").cast("string")
    return F.when(F.length(plain) >= width, plain).otherwise(F.lpad(plain, width, "0"))


def _iso(y: Column, m: Column, d: Column, h: Column, n: Column, s: Column) -> Column:
    two = [_pad(x, 2) for x in (m, d, h, n, s)]
    return F.concat(_pad(y, 4), F.lit("-"), two[0], F.lit("-"), two[1], F.lit("T"), two[2], F.lit(":"), two[3], F.lit(":"), two[4])


def parse_date(raw: Column, compat: bool = True, decode: bool = True) -> Column:
    """struct(raw, iso) of day/month/year with or without a time, 'mon d, yyyy h:mm am', or 'd de month de yyyy', in that order.

    raw is the cleaned text, null if empty; iso is null without a date. With compat only unaccented month names count.
    """
    clean = text.normalize_whitespace(raw) if decode else text.squeeze(raw)
    letters = "a-z" if compat else "a-zç"

    def groups(value: Column, pattern: str, count: int) -> Column:
        return F.array(*(F.regexp_extract(value, pattern, k) for k in range(1, count + 1)))

    def numeric(a: Column) -> Column:
        return F.when(a[2] != "", _iso(a[2], a[1], a[0], *(F.when(a[k] == "", "0").otherwise(a[k]) for k in range(3, 6))))

    def english(b: Column) -> Column:
        half = F.lower(b[5])
        hour = let(b[3].try_cast("int"), lambda h: F.when((half == "pm") & (h < 12), h + 12).when((half == "am") & (h == 12), 0).otherwise(h))
        return _iso(b[2], _number(b[0], compat), b[1], hour, b[4], F.lit("0"))

    def long(c: Column) -> Column:
        zero = F.lit("0")
        return F.when(c[0] != "", _iso(c[2], _number(c[1], compat), c[0], zero, zero, zero))

    first = r"(\d{1,2})/(\d{1,2})/(\d{4})(?:\D+(\d{1,2}):(\d{2})(?::(\d{2}))?)?"
    second = rf"(?i)(jan|fev|mar|abr|mai|jun|jul|ago|set|out|nov|dez)[{letters}]*\s+(\d{{1,2}}),\s+(\d{{4}})\s+(\d{{1,2}}):(\d{{2}})\s*(am|pm)"
    third = rf"(?i)(\d{{1,2}})\s+de\s+([{letters}]+)\s+de\s+(\d{{4}})"

    # The first pattern that matches decides, even where it gives no date.
    def worded(clean: Column) -> Column:
        return let(groups(clean, second, 6), lambda b: F.when(b[0] != "", english(b)).otherwise(let(groups(clean, third, 3), long)))

    def built(clean: Column) -> Column:
        iso = let(let(groups(clean, first, 6), numeric), lambda one: F.when(one.isNotNull(), one).otherwise(worded(clean)))
        return F.struct(F.when(clean != "", clean).alias("raw"), iso.alias("iso"))

    return let(clean, built)
