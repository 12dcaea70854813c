"""Joining a large side with a side that should be small, whatever it turns out to be."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundburn.functions.intermediate import materialise

#: A side is broadcast only when counted at or below this many rows.
BROADCAST_ROWS = 200_000
#: A side read from files is broadcast only when they are at most this large.
BROADCAST_BYTES = 32 << 20


def join_sized(
    large: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Equi-join that broadcasts ``small`` only after counting it.

    Above ``max_rows`` it is a shuffled join, whose oversized partitions Spark
    splits over several tasks. Splitting works on the large side, so ``how``
    must keep only rows that side drives: inner, left, left_semi, left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    small = materialise(small)
    fits = small.count() <= max_rows
    return large.join(F.broadcast(small) if fits else small.hint("merge"), on, how)
