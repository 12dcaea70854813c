"""Additive measures that every emission figure is built from.

Counts and minutes add up, so a table of segments can be summed to any level
once or in steps with the same result. Queries therefore accept either the
flight legs turned into measures here or an already summed roll-up of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundburn.functions.clock import hour
from groundburn.functions.intermediate import materialise
from groundburn.functions.validity import arrival_valid, both_valid, departure_valid
from groundburn.params import Params

#: Additive columns of a departure row. The ``ambos`` ones are population A.
DEPARTURE_MEASURES = ("vuelos", "minutos", "vuelos_ambos", "salida_ambos", "llegada_ambos")


def departures(flights: DataFrame, p: Params) -> DataFrame:
    """Population B, one row per flight. Contains all of population A.

    Of a table that holds only some of the flights' columns, what they tell.
    """
    rows = flights.where(departure_valid(p))
    plain = {"aeropuerto": "Origin", "anio": "Year", "mes": "Month", "fecha": "FlightDate", "dia": "DayOfWeek", "aerolinea": "Reporting_Airline"}
    columns = [F.col(source).alias(name) for name, source in plain.items() if source in flights.columns]
    if "CRSDepTime" in flights.columns:
        columns.append(hour(F.col("CRSDepTime")).alias("hora"))
    columns += [F.lit(1).cast("long").alias("vuelos"), F.col("TaxiOut").alias("minutos")]
    if "TaxiIn" in flights.columns:
        both = both_valid(p)
        columns += [both.cast("long").alias("vuelos_ambos"), F.when(both, F.col("TaxiOut")).alias("salida_ambos"),
                    F.when(both, F.col("TaxiIn")).alias("llegada_ambos")]
    return rows.select(*columns)


def segments(flights: DataFrame, p: Params) -> DataFrame:
    """Taxi segments: population B at the origin, population C at the destination.

    A flight has up to two segments; both come out of one scan.
    """
    return flights.sparkSession.sql(
        """
        SELECT aeropuerto, anio, mes, lado, minutos, 1L AS vuelos
        FROM (SELECT Year AS anio, Month AS mes, Origin, TaxiOut, Dest, TaxiIn FROM {flights})
        UNPIVOT INCLUDE NULLS (
          (aeropuerto, minutos) FOR lado IN ((Origin, TaxiOut) AS salida, (Dest, TaxiIn) AS llegada)
        )
        WHERE minutos <= {cap}
        """,
        flights=flights, cap=p.taxi_cap,
    )


def arrivals(flights: DataFrame, p: Params) -> DataFrame:
    """Population C as arrival segments, one row per flight."""
    return flights.where(arrival_valid(p)).select(
        F.col("Dest").alias("aeropuerto"), F.col("Year").alias("anio"), F.col("Month").alias("mes"),
        F.lit("llegada").alias("lado"), F.col("TaxiIn").alias("minutos"), F.lit(1).cast("long").alias("vuelos"),
    )


def segments_from(departures: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Taxi segments from departures (flights or a roll-up) and arrivals."""
    return departures.withColumn("lado", F.lit("salida")).select(*arrivals.columns).unionByName(arrivals)


def roll_up(measures: DataFrame, keys: list[str], columns: tuple[str, ...] = ("vuelos", "minutos")) -> DataFrame:
    """Sum additive columns per key."""
    return measures.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in columns])


def roll_ups(measures: DataFrame, levels: Sequence[Sequence[str]], columns: tuple[str, ...]) -> list[DataFrame]:
    """:func:`roll_up` to several levels from one scan, stored. Runs a job."""
    keys = list(dict.fromkeys(key for level in levels for key in level))
    summed = materialise(measures.groupingSets([list(level) for level in levels], *keys).agg(
        F.grouping_id().alias("_nivel"), *[F.sum(c).alias(c) for c in columns]))
    # A bit per key, the first the highest, is set where the level lacks it.
    number = [sum((key not in level) << i for i, key in enumerate(reversed(keys))) for level in levels]
    return [summed.where(F.col("_nivel") == n).select(*level, *columns) for n, level in zip(number, levels, strict=True)]
