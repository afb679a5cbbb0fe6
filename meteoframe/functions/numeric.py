"""Safe numeric parsing, sentinels and exact rounding (Column -> Column).

Feed text must be a plain decimal number before ``try_cast``: Spark alone
accepts '1d', 'nan' or 'inf' as doubles, and engines differ on '3.0' as an
integer, so the guard makes every engine agree.  The guard is a
``translate`` (text made only of digits, sign, point and exponent) in front
of ``try_cast``, which rejects every malformed arrangement of those
characters; this equals the ``DECIMAL_RE`` pattern (used by the SQL oracle)
without running a regex per value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meteoframe.functions.text import _c, strip

DECIMAL_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER_RE = r"^[+-]?[0-9]+$"


def _only(s: Column, chars: str) -> Column:
    """s is non-empty and made only of ``chars``."""
    return (F.length(s) > 0) & (F.translate(s, chars, "") == "")


def _plain_decimal(s: Column) -> Column:
    # only digits, sign, point, exponent; try_cast rejects bad arrangements
    # of them ('1e', '+', '.', '1-2') just as DECIMAL_RE does
    return _only(s, "0123456789+-.eE")


def safe_double(c, stripped: bool = False) -> Column:
    """Numeric text -> double; anything else (incl. '', null, 'nan') -> null."""
    return _plain_or_stripped(_c(c), stripped, _plain_decimal, "double")


def _plain_or_stripped(v: Column, stripped: bool, plain, kind: str) -> Column:
    """Cast of plain number text; only other text is stripped and tried again."""
    direct = F.when(plain(v), v.try_cast(kind))
    s = strip(v)
    return direct if stripped else direct.when(plain(s), s.try_cast(kind))


def safe_int(c, stripped: bool = False) -> Column:
    """Integer text -> int; '3.0', 'x', '' -> null (Python int() rules)."""
    return _plain_or_stripped(_c(c), stripped, lambda s: _only(s, "0123456789+-"), "int")


def safe_number(c, precision: int = 38, scale: int = 0) -> Column:
    """TRY_CAST(text AS NUMBER(p,s)): rounds half up, bad text -> null."""
    return _plain_or_stripped(_c(c), False, _plain_decimal, f"decimal({precision},{scale})")


def sentinel_to_null(c, sentinels) -> Column:
    """Missing-value codes become null.

    A value is missing when its text equals a code ('-9', '-99', ...) or when
    it is numeric and equal to one (so '-9.0' is missing too, as a numeric
    feed column would be).  Other values pass through unchanged.  Text without
    a sign cannot be one of the (negative) codes and is not looked at closer.
    """
    s = strip(_c(c))
    codes = [float(x) for x in sentinels]
    is_code = F.coalesce(s.isin(list(sentinels)) | safe_double(s, stripped=True).isin(codes), s.isin(list(sentinels)), F.lit(False))
    if all(x < 0 for x in codes) and all("-" in x for x in sentinels):
        return F.when(_c(c).contains("-"), F.when(~is_code, _c(c))).otherwise(_c(c))
    return F.when(~is_code, _c(c))


def null_if_missing(c, code=-9) -> Column:
    return F.when(_c(c) != F.lit(code), _c(c))


def zero_if_missing(c, code=-9) -> Column:
    return F.when(_c(c) == F.lit(code), F.lit(0.0)).otherwise(_c(c))


# values enter means as decimals of ten places
MEAN_TYPE = "decimal(20,10)"


def mean_half_up(c, decimals: int = 2) -> Column:
    """Aggregate: mean of the non-null values, rounded half up, as double.

    Values are added as decimals of ten places and divided in integer
    arithmetic, so the result does not depend on the order of rows or on
    binary rounding.  A group with a value too large for that type (10
    integer digits) takes the mean of doubles instead.  No value: null.
    """
    x = _c(c)
    d = x.try_cast(MEAN_TYPE)
    s, n = F.sum(d), F.count(x)
    a = F.abs(s) * F.lit(2 * 10 ** decimals).cast("decimal(8,0)") + n.cast("decimal(20,0)")
    b = (n * 2).cast("decimal(20,0)")
    # a less its remainder is a multiple of b: the division is exact
    mag = ((a - F.pmod(a, b)) / b).cast("double")
    exact = F.when(mag == 0, F.lit(0.0)).otherwise(F.signum(s.cast("double")) * mag / F.lit(float(10 ** decimals)))  # never -0.0
    return F.when(n > 0, F.when(n > F.count(d), F.round(F.avg(x.cast("double")), decimals)).otherwise(exact))


def clamp(c, lo=0, hi=100) -> Column:
    """Bound to [lo, hi]; null stays null (greatest/least would skip it)."""
    col = _c(c)
    return F.when(col.isNotNull(), F.greatest(F.least(col, F.lit(hi)), F.lit(lo)))
