"""Scheduled departure time: a whole number read as HHMM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MIDNIGHT = 2400


def _whole_hours(t: Column) -> Column:
    # Exact: the dividend is a multiple of 100, so no rounding can occur.
    return ((t - t % 100) / F.lit(100.0)).cast("long")


def hour(t: Column) -> Column:
    """0..23. Midnight written as 2400 is hour 0; anything off the clock is NULL."""
    return F.when(t == _MIDNIGHT, F.lit(0).cast("long")).when(t.between(0, 2359), _whole_hours(t))


def strict_hour(t: Column) -> Column:
    """As :func:`hour`, and the minute must exist too."""
    return F.when((t % 100 <= 59) | (t == _MIDNIGHT), hour(t))


def plain_hour(t: Column) -> Column:
    """Whole-number quotient with no clock rule: 2400 stays 24."""
    return _whole_hours(t)


def rounded_hour(t: Column) -> Column:
    """The known-wrong decoding that rounds half to even, so 23:50 lands in hour 24."""
    return F.rint(t / F.lit(100.0)).cast("int")


def floor_hour(t: Column) -> Column:
    """Floor of the quotient as a double; 2400 is its own group 24."""
    return F.floor(t / F.lit(100.0)).cast("double")


def time_class(t: Column) -> Column:
    """Name the kind of value. The first rule that applies wins."""
    # Class names. An hour above 23 cannot remain after these rules.
    return (
        F.when(t.isNull(), "nulo")
        .when(t == _MIDNIGHT, "2400_medianoche")
        .when(t < 0, "negativo")
        .when(t > _MIDNIGHT, "mayor_2400")
        .when(t >= 2360, "2360_a_2399")
        .when(t % 100 > 59, "minuto_invalido_0_2359")
        .otherwise("hhmm_valido")
    )


def off_clock(t: Column) -> Column:
    """True for a present value that is neither a real HHMM nor 2400."""
    return t.isNotNull() & ~time_class(t).isin("hhmm_valido", "2400_medianoche")
