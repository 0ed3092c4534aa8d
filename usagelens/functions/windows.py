"""Date windows over adoption dates. Each convention of bounds is its own function; `as_of` is always given."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def within_days(d: Column, as_of: Column, n: int) -> Column:
    """At most n days old; later dates count."""
    return F.datediff(as_of, d) <= n


def growth_current(d: Column, as_of: Column, n: int) -> Column:
    """(as_of - n, as_of]"""
    return (d > F.date_sub(as_of, n)) & (d <= as_of)


def growth_previous(d: Column, as_of: Column, n: int) -> Column:
    """(as_of - 2n, as_of - n]"""
    return (d > F.date_sub(as_of, 2 * n)) & (d <= F.date_sub(as_of, n))


def paper_current(d: Column, as_of: Column, n: int) -> Column:
    """[as_of - n, as_of], both ends in; seven days are [as_of - 6, as_of]."""
    return d.between(F.date_sub(as_of, 6 if n == 7 else n), as_of)


def paper_previous(d: Column, as_of: Column, n: int) -> Column:
    """[as_of - 2n, as_of - n - 1], both ends in."""
    return d.between(F.date_sub(as_of, 2 * n), F.date_sub(as_of, n + 1))


def month(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def clamp_to_release(d: Column, released: Column) -> Column:
    """NULL where the date's month is before the release month (`yyyy-MM`)."""
    return F.when(released.isNull() | (month(d) >= released), d)


def percent_change(now: Column, before: Column) -> Column:
    """'new' from nothing, '±0%' for no change after rounding, else a signed percentage; halves go up."""
    p = F.floor((now - before) * 100.0 / before + 0.5).cast("long")
    text = F.concat(F.when(p > 0, F.lit("+")).otherwise(F.lit("")), p.cast("string"), F.lit("%"))
    return F.when((before == 0) & (now == 0), F.lit("±0%")).when(before == 0, F.lit("new")).when(p == 0, F.lit("±0%")).otherwise(text)
