"""Numeric and date coercion Column functions.

ANSI mode is on in Spark 4, so every conversion and division here uses the
``try_*`` family: bad data turns into NULL, never into a failed task.
Division by zero gives NULL (pandas would give inf/NaN).
"""
from __future__ import annotations

import datetime as _dt
import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions.text import as_col, pystrip, without

# The calendar range pandas' datetime64[ns] can hold; dates
# outside it coerce to missing (NaT) in the reference.
PANDAS_MIN_DATE = _dt.date(1677, 9, 22)
PANDAS_MAX_DATE = _dt.date(2262, 4, 11)

# A plain decimal number the way pandas.to_numeric reads it: optional sign,
# digits with an optional fraction, optional exponent. Words such as ``inf`` and
# numbers beyond the range of a double are missing values here.
_NUMERIC = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def to_date_or_null(c) -> Column:
    """ISO text -> DATE; impossible or out-of-range dates -> NULL."""
    d = F.try_to_date(as_col(c), "yyyy-MM-dd")
    return F.when(d.between(F.lit(PANDAS_MIN_DATE), F.lit(PANDAS_MAX_DATE)), d)


def safe_numeric(c) -> Column:
    """C11: ``pd.to_numeric(errors='coerce')`` on text: non-numbers -> NULL.

    The guard rejects forms Java accepts but pandas does not (``1d``, ``1f``,
    ``0x10``); ``nan`` and infinities become NULL (missing).
    """
    return _finite(_number(pystrip(as_col(c).cast("string"))))


def _number(stripped: Column) -> Column:
    """The double of a stripped text. Reads it once: what isn't a number gives an empty match, which casts to NULL."""
    return F.regexp_extract(stripped, _NUMERIC, 0).try_cast("double")


def _finite(v: Column) -> Column:
    # Both comparisons always read the value, so Spark computes it once for them and the result.
    return F.when(v.between(-sys.float_info.max, sys.float_info.max), v)


def to_num_series(c) -> Column:
    """Strip, drop ``$`` and ``,``; blank / ``None`` / ``nan`` (no numbers) -> NULL; coerce."""
    return safe_numeric(without(pystrip(as_col(c).cast("string")), "$,"))


def num_series_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` with ``to_num_series`` of the named columns in their places, in projections that read each text a few times at most."""
    def replaced(rows: DataFrame, value) -> DataFrame:
        return rows.select(*[value(c).alias(c) if c in names else F.col(c) for c in rows.columns])
    texts = replaced(df, lambda c: F.col(c).cast("string"))
    bare = replaced(texts, lambda c: without(pystrip(c), "$,"))
    read = replaced(bare, lambda c: _number(pystrip(c)))
    return replaced(read, lambda c: _finite(F.col(c)))


def ratio_if(cond, num, den) -> Column:
    """``num / den`` only where ``cond`` holds."""
    return F.when(cond, F.try_divide(as_col(num), as_col(den)))


def billing_days(ini, fin) -> Column:
    """Inclusive day count ``fin - ini + 1``; <= 0 or missing -> NULL."""
    d = F.datediff(as_col(fin), as_col(ini)) + 1
    return F.when(d > 0, d)


def period_key(ini, fin) -> Column:
    """``'<ini>__<fin>'`` with ``NaT`` standing in for a missing date."""
    def part(d):
        return F.coalesce(as_col(d).cast("string"), F.lit("NaT"))
    return F.concat(part(ini), F.lit("__"), part(fin))


def months_span(first, last) -> Column:
    """``round((last - first) days / 30, 1)``."""
    return F.round(F.datediff(as_col(last), as_col(first)) / F.lit(30.0), 1)


def quantize4(num, den) -> Column:
    """Decimal ``num / den`` rounded half-even to 4 places, exactly.

    NULL when either side is NULL or the denominator is 0, or where the
    quotient has no room in 38 digits. The quotient of 10,000 ``num`` is split
    into a whole number and a remainder, and the remainder decides the rounding.
    """
    den = as_col(den)
    den = F.when(den != 0, den)
    scaled = as_col(num) * F.lit(10_000).cast("decimal(5,0)")
    rest = F.try_mod(scaled, den)
    whole = F.try_divide(scaled - rest, den).try_cast("decimal(38,0)")
    twice, size = F.abs(rest) * F.lit(2).cast("decimal(1,0)"), F.abs(den)
    away = F.when((twice > size) | ((twice == size) & (F.abs(whole) % 2 == 1)), F.lit(1)).otherwise(F.lit(0))
    sign = F.signum(scaled) * F.signum(den)
    return F.try_divide((whole + (away * sign).cast("decimal(1,0)")).try_cast("decimal(34,0)"),
                        F.lit(10_000).cast("decimal(5,0)")).try_cast("decimal(38,4)")
