"""Rounding, counting and unit conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from groundburn.params import Params


def rnd(x: Column, digits: int = 0) -> Column:
    """Round a double the way binary engines do: scale, round to a whole, unscale.

    Spark's own ``round(x, n)`` rounds the printed decimal instead, so 1.005
    becomes 1.01 there and 1.0 here.
    """
    if digits == 0:
        return F.round(x, 0)
    scale = float(10**digits)
    return F.round(x * F.lit(scale), 0) / F.lit(scale)


def tally(condition: Column, weight: Column | None = None) -> Column:
    """Rows where ``condition`` holds, each counted ``weight`` times.

    Unknown conditions do not count, and a group without any known condition
    gives NULL (``count_if`` would give 0).
    """
    flag = condition.cast("long")
    return F.sum(flag if weight is None else flag * weight)


def co2_tonnes(minutes: Column, rate: float, p: Params) -> Column:
    """Tonnes of CO2 for ``minutes`` of taxiing; minutes are summed first, scaled last."""
    return minutes * F.lit(rate) * F.lit(p.co2_factor) / F.lit(1000.0)


def hours(minutes: Column) -> Column:
    return minutes / F.lit(60.0)


def share(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``, two decimals; NULL for an empty whole."""
    return rnd(F.try_divide(F.lit(100.0) * part, whole.cast("double")), 2)


def mean(total: Column, n: Column) -> Column:
    """Mean from an additive pair; NULL when there is nothing to average."""
    return F.try_divide(total.cast("double"), n.cast("double"))
