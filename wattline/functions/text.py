"""Column functions for bill text: stripping, regex lookup, cleaners, dates.

Every function takes and returns a ``Column`` and is built only from native
``pyspark.sql.functions`` expressions, so it runs inside whole-stage codegen.

Regex dialect: patterns are Java regexes. ``(?i)`` alone is ASCII-only case
folding in Java, so patterns that must fold accented capitals carry
``(?iU)`` (Unicode classes and case); ``(?d)`` makes ``\\n`` the only line
terminator, so ``^``/``$`` under ``(?m)`` behave like Python's ``re``.
Known residual differences with Python's ``re``: Python's ``\\s`` also matches
the four ASCII separators U+001C..U+001F, Java's does not.
"""
from __future__ import annotations

import sys
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Flag prefixes for the bill patterns.
CI = "(?iUd)"
CIM = "(?iUdm)"

# Every code point Python's ``str.strip()`` removes (``str.isspace``), built
# from the rule rather than typed out.
PY_WHITESPACE = "".join(
    ch for ch in map(chr, range(sys.maxunicode + 1)) if ch.isspace()
)

# Spanish month abbreviations in calendar order.
MONTHS_ES = ["ENE", "FEB", "MAR", "ABR", "MAY", "JUN",
             "JUL", "AGO", "SEP", "OCT", "NOV", "DIC"]

# Tariff prefixes kept when trailing noise follows them.
TARIFF_PREFIXES = ["PDBT", "GDBT", "GDMTO", "GDMTH"]


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pystrip(c) -> Column:
    """Strip leading/trailing Unicode white space exactly like ``str.strip()``.

    A column given by its name may be read several times: where it begins and
    ends with a visible ASCII character it is taken as it is. To see that takes
    a few comparisons; ``trim`` looks characters up in the whole set.
    """
    if not isinstance(c, str):
        return F.trim(c, F.lit(PY_WHITESPACE))
    text, last = F.col(c), F.substring(c, -1, 1)
    plain = (text >= "!") & (text < "\x7f") & (last >= "!") & (last < "\x7f")
    return F.when(plain, text).otherwise(F.trim(text, F.lit(PY_WHITESPACE)))


def null_if_empty(c) -> Column:
    return F.nullif(as_col(c), F.lit(""))


def find_first(text, pattern: str, group: int = 1) -> Column:
    """Group ``group`` of the first match, stripped; no match / empty -> NULL."""
    return null_if_empty(pystrip(F.regexp_extract(as_col(text), pattern, group)))


def digits_only(c) -> Column:
    """C4: keep only (Unicode) digits; nothing left -> NULL."""
    return null_if_empty(F.regexp_replace(as_col(c), r"(?U)\D+", ""))


def alnum_only(c) -> Column:
    """Upper-case, keep only A-Z and 0-9; nothing left -> NULL."""
    return null_if_empty(F.regexp_replace(F.upper(as_col(c)), "[^A-Z0-9]+", ""))


def without(c, chars: str) -> Column:
    """``c`` without the given characters (one search each; ``translate`` looks every character of ``c`` up)."""
    return reduce(lambda t, ch: F.replace(t, F.lit(ch), F.lit("")), chars, as_col(c))


def num_clean(c) -> Column:
    """Drop ``$``, ``,`` and blanks, strip; nothing left -> NULL."""
    return null_if_empty(pystrip(without(c, "$, ")))


def compact_id(c) -> Column:
    """RPU clean-up: drop blanks and hyphens, strip; nothing left -> NULL."""
    return null_if_empty(pystrip(F.translate(as_col(c), " -", "")))


def normalize_tarifa(c) -> Column:
    """Upper-case, no blanks; a known prefix wins over trailing noise."""
    t = null_if_empty(F.replace(F.upper(pystrip(as_col(c))), F.lit(" "), F.lit("")))
    prefix = null_if_empty(
        F.regexp_extract(t, "^(" + "|".join(TARIFF_PREFIXES) + ")", 1))
    return F.coalesce(prefix, t)


def parse_es_date(c, whole: bool = False) -> Column:
    """``'07 NOV 25'`` -> ``'2025-11-07'`` as ISO text, no calendar check.

    ``whole=False`` accepts trailing text (bill form); ``whole=True`` requires
    the date to be the whole value (history form). Two-digit years get 2000
    added; an unknown month gives NULL.
    """
    s = F.upper(pystrip(c))
    pat = r"(?U)^(\d{1,2})\s+([A-ZÁÉÍÓÚÑ]{3})\s+(\d{2,4})" + ("$" if whole else "")
    # No CASE WHEN: NULL propagates through concat, so every piece is
    # evaluated once per row (Spark shares subexpressions only outside
    # conditional branches). Blanks divide the match into its groups.
    found = F.split(F.regexp_extract(s, pat, 0), r"(?U)\s+")
    dd = F.get(found, 0).try_cast("int")
    yy = F.get(found, 2).try_cast("int")
    mm = F.nullif(F.array_position(F.array(*[F.lit(m) for m in MONTHS_ES]),
                                   F.get(found, 1)), F.lit(0))
    year = yy + F.when(yy < 100, F.lit(2000)).otherwise(F.lit(0))

    def pad(x, n):
        return F.lpad(x.cast("string"), n, "0")
    return F.concat(pad(year, 4), F.lit("-"), pad(mm, 2), F.lit("-"), pad(dd, 2))


def detect_document_type(text, upper_text=None) -> Column:
    """Ordered utility signals -> struct(source_utility, document_type).

    Pass ``upper_text`` (an already upper-cased column) when the caller has
    one: Spark does not share subexpressions across ``CASE WHEN`` branches,
    so an inline ``upper`` would run once per signal.
    """
    t = as_col(upper_text) if upper_text is not None else \
        F.upper(F.coalesce(as_col(text), F.lit("")))

    def pair(u, d):
        return F.struct(F.lit(u).alias("source_utility"), F.lit(d).alias("document_type"))

    is_cfe = (
        t.contains("CFE SUMINISTRADOR DE SERVICIOS BASICOS")
        | t.rlike(r"(?U)RFC:\s*CFE\d{6}")
        | t.contains("CSS160330CP7")
        | t.contains("COMISION FEDERAL DE ELECTRICIDAD")
    )
    return (
        F.when(t.contains("IBERDROLA"), pair("IBERDROLA", "iberdrola_cfdi"))
        .when(is_cfe, pair("CFE", "cfe_bill"))
        .otherwise(pair("UNKNOWN", "unknown"))
    )


def es_date_text(d) -> Column:
    """Render a date as ``'dd MON yy'`` (the bill layout's date form).

    From the date's numbers: ``date_format`` goes through a timestamp of the
    session's zone and a formatter for every call. Years before 1 are those of their era.
    """
    d = as_col(d)
    year = F.when(F.year(d) > 0, F.year(d)).otherwise(F.lit(1) - F.year(d))
    return F.concat_ws(
        " ",
        F.lpad(F.dayofmonth(d).cast("string"), 2, "0"),
        F.element_at(F.array(*[F.lit(m) for m in MONTHS_ES]), F.month(d)),
        F.lpad((year % 100).cast("string"), 2, "0"),
    )
