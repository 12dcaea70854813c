"""Dates and day names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day names, 1 = Monday ... 7 = Sunday.
DAY_LONG = ("lunes", "martes", "miércoles", "jueves", "viernes", "sábado", "domingo")
DAY_SHORT = ("Lun", "Mar", "Mié", "Jue", "Vie", "Sáb", "Dom")


def day_name(day: Column, names: tuple[str, ...] = DAY_LONG) -> Column:
    """Name of a day number; NULL outside 1..7."""
    position = F.when(day.between(1, 7), day.cast("int"))
    return F.get(F.array(*[F.lit(name) for name in names]), position - 1)


def flight_date() -> Column:
    """Calendar date of a flight; text that is no date becomes NULL."""
    return F.expr("try_cast(FlightDate AS DATE)")


def period(year: Column, month: Column) -> Column:
    """First day of a month."""
    return F.make_date(year.cast("int"), month.cast("int"), F.lit(1))
