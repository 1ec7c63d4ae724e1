"""Numeric rules shared by every model.

* Exact quantities (prices, sums, running totals, minima, maxima) stay
  ``decimal``: they are order independent and equal in every engine.
* Ratios and averages are computed in ``double`` and then rounded through
  ``decimal(38,10)``: the double is first fixed to ten places, then rounded
  half away from zero to the presented scale.  Rounding a raw double would
  flip exact halves by one unit in the last place, and a decimal division
  would silently lose scale once precision passes 38 digits.
* Every denominator goes through ``nullif(x, 0)``: with ANSI mode on, a
  division by zero raises instead of returning NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("double")


def nonzero(c: Column | str) -> Column:
    """``nullif(c, 0)`` as a double."""
    return F.nullif(as_double(c), F.lit(0.0))


def ratio(num: Column | str, den: Column | str) -> Column:
    """``num / nullif(den, 0)`` in double precision."""
    return as_double(num) / nonzero(den)


def pct(num: Column | str, den: Column | str) -> Column:
    """``num / nullif(den, 0) * 100`` in double precision."""
    return ratio(num, den) * F.lit(100.0)


def rounded(c: Column | str, scale: int = 4) -> Column:
    """Round a double (or decimal) half away from zero, returned as double."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("decimal(38,10)"), scale).cast("double")


def rounded_decimal(c: Column | str, scale: int) -> Column:
    """Round an exact decimal half away from zero, keeping it decimal."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, scale)
