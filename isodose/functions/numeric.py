"""Decimal rounding of doubles by their exact binary value, ties to even.

Spark's own ``round`` and ``format_string`` round the *shortest decimal form* half up, so
35.0000005 (stored as 35.00000049999999...) becomes 35.000001.  The products need the
C/IEEE answer 35.000000, because location keys hash that text.

``value * 10**places`` as a double lies on the right side of every rounding boundary, or
exactly on it.  Only in the second case can the lost part of the product decide, and it is
computed without error from two halves of the value that are short enough.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _scaled(value: Column, places: int) -> Column:
    """``value * 10**places`` rounded to a whole number (as a double)."""
    scale = F.lit(float(10**places))
    product = value * scale
    high = value.cast("float").cast("double")
    lost = (high * scale - product) + (value - high) * scale
    on_edge = product - F.floor(product) == 0.5
    return F.rint(product + F.when(on_edge, F.signum(lost) * 0.25).otherwise(0.0))


def round_exact(value: Column, places: int) -> Column:
    """Nearest double to ``value`` rounded to ``places`` decimals."""
    return _scaled(value, places) / F.lit(float(10**places))


def fixed_decimals(value: Column, places: int) -> Column:
    """``value`` as text with exactly ``places`` decimals, like C's ``%.<places>f``."""
    text = round_exact(value, places).cast(f"decimal(20,{places})").cast("string")
    # A decimal has no negative zero, the text of a small negative double does.
    small = (value <= 0) & (value > -(10.0**-places))
    signed = small & F.startswith(value.cast("string"), F.lit("-")) & ~F.startswith(text, F.lit("-"))
    return F.when(signed, F.lit("-0." + "0" * places)).otherwise(text)


def exact_sum(value: Column) -> Column:
    """Sum that does not depend on row order (decimal accumulation, six decimals)."""
    return F.sum(value.cast("decimal(18,6)")).cast("double")


def exact_avg(value: Column) -> Column:
    """Average over :func:`exact_sum`; null for an empty group."""
    return exact_sum(value) / F.count(value)
