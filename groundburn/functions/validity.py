"""The four populations. Each result names the one it uses; they are never mixed.

A  both taxi times valid
B  departure (TaxiOut) valid
C  arrival (TaxiIn) valid
D  B with a decodable scheduled hour
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from groundburn.functions.clock import hour, rounded_hour
from groundburn.params import Params


def valid_minutes(minutes: Column, p: Params) -> Column:
    """Present and not above the cap; never NULL."""
    return minutes.isNotNull() & (minutes <= F.lit(p.taxi_cap))


def departure_valid(p: Params) -> Column:
    return valid_minutes(F.col("TaxiOut"), p)


def arrival_valid(p: Params) -> Column:
    return valid_minutes(F.col("TaxiIn"), p)


def both_valid(p: Params) -> Column:
    return departure_valid(p) & arrival_valid(p)


def departure_with_hour(p: Params) -> Column:
    return departure_valid(p) & hour(F.col("CRSDepTime")).isNotNull()


def flagged(name: str) -> Column:
    """0/1 flag column read as a boolean; a missing flag is false."""
    return F.coalesce(F.col(name), F.lit(0.0)) == F.lit(1.0)


def false_hour_24(p: Params) -> Column:
    """Population B flights that the wrong, rounding hour moves to an hour 24."""
    t = F.col("CRSDepTime")
    return departure_valid(p) & (t < 2400) & (rounded_hour(t) == 24)
