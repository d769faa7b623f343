"""Rates, intervals and forecasts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Z = 1.96


def rate(part: Column, whole: Column) -> Column:
    """part / whole; null where whole is 0 or null."""
    return F.try_divide(part.cast("double"), whole)


def wilson(successes: Column, trials: Column) -> tuple[Column, Column]:
    """Lower and upper end of the 95 % score interval, within [0, 1]; null without trials."""
    p = rate(successes, trials)
    n = F.nullif(trials.cast("double"), F.lit(0.0))
    middle = (p + Z * Z / (2 * n)) / (1 + Z * Z / n)
    half = Z * F.sqrt(p * (1 - p) / n + Z * Z / (4 * n * n)) / (1 + Z * Z / n)
    return F.when(n > 0, F.greatest(F.lit(0.0), middle - half)), F.when(n > 0, F.least(F.lit(1.0), middle + half))


def expected_more(remaining: Column, p: Column) -> Column:
    """How many more trials `remaining` successes take at rate p, rounded up; null where p is 0 or null."""
    return F.when(p > 0, F.ceil(remaining / p)).cast("long")


def expected_range(remaining: Column, low: Column, high: Column) -> Column:
    """[fewest, most] more trials by an interval; null unless its lower end is above 0."""
    return F.when(low > 0, F.array(F.ceil(remaining / high).cast("long"), F.ceil(remaining / low).cast("long")))
