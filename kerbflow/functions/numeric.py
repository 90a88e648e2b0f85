"""Numeric coercion and small arithmetic helpers as column expressions.

ANSI mode is on by default, so every coercion goes through ``try_cast``; NaN is
mapped to null because Spark orders NaN above every number (``NaN > 1`` is
true), while the validity rules need "garbage fails every test".
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType


# What a number may look like as text; Java's own suffixes ('12d') and hex forms are not numbers.
_DECIMAL = r"(?i)^\s*[-+]?(\d+\.?\d*([e][-+]?\d+)?|\.\d+([e][-+]?\d+)?|inf|infinity|nan)\s*$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_to_double(c) -> Column:
    """DOUBLE from text that is a plain decimal, inf or nan; null for the rest."""
    t = _col(c).cast("string")
    return F.when(t.rlike(_DECIMAL), t.try_cast("double"))


def clean_double(c, dtype: DataType | None = None) -> Column:
    """Coerce to DOUBLE; text that does not parse and NaN become null."""
    c = _col(c)
    if dtype is not None and isinstance(dtype, NumericType):
        x = c.cast("double")
    else:
        x = text_to_double(c)
    return F.when(~F.isnan(x), x)


def finite_or_null(c) -> Column:
    """Null for null, NaN and +/-Infinity; the value otherwise."""
    x = _col(c)
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)


def _text_to_finite(c) -> Column:
    return finite_or_null(text_to_double(c))


def first_within(*numbers, default: float | None = 0.0, min_value: float | None = None, max_value: float | None = None) -> Column:
    """The first of some finite-or-null numbers that is within the bounds, if any; else ``default``."""
    picks = []
    for v in numbers:
        ok = v.isNotNull()
        if min_value is not None:
            ok = ok & (v >= F.lit(float(min_value)))
        if max_value is not None:
            ok = ok & (v <= F.lit(float(max_value)))
        picks.append(F.when(ok, v))
    if default is not None:
        picks.append(F.lit(float(default)))
    return F.coalesce(*picks) if len(picks) > 1 else picks[0]


def pick_float(*candidates, default: float | None = 0.0,
               min_value: float | None = None,
               max_value: float | None = None) -> Column:
    """The first usable candidate of a row: finite, and within the bounds if any.

    Rows without one get ``default``, which later aggregates count like any value.
    """
    return first_within(*[_text_to_finite(c) for c in candidates], default=default, min_value=min_value, max_value=max_value)


def to_int(c, default: int | None = None) -> Column:
    """Integer from text or number; numbers are truncated toward zero.

    Goes through DOUBLE first because ``try_cast('3.0' as int)`` is null.
    """
    v = _text_to_finite(c)
    out = v.try_cast("int")
    return F.coalesce(out, F.lit(default)) if default is not None else out


def colour_triple(norm) -> Column:
    """[red, green, blue, alpha] from a value normalised to [-1, 1].

    red = 255*max(0,-n) (outflow), blue = 255*max(0,n) (inflow),
    green = 255*(1-|n|), alpha fixed at 180; channels truncate toward zero.
    """
    n = _col(norm)
    red = (F.lit(255.0) * F.greatest(F.lit(0.0), -n)).cast("int")
    green = (F.lit(255.0) * (F.lit(1.0) - F.abs(n))).cast("int")
    blue = (F.lit(255.0) * F.greatest(F.lit(0.0), n)).cast("int")
    return F.array(red, green, blue, F.lit(180))
