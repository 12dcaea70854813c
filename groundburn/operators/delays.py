"""Arrival-delay statistics. A flight is late when ``ArrDel15`` is 1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundburn.functions import quantiles as Q
from groundburn.functions.calendar import DAY_SHORT, day_name
from groundburn.functions.clock import floor_hour
from groundburn.functions.numeric import rnd, share
from groundburn.params import Params


def late_distribution(flights: DataFrame) -> DataFrame:
    """Flights on time and late, with their share of the total.

    The share window runs over the handful of aggregated rows.
    """
    counted = flights.where(F.col("ArrDel15").isNotNull()).groupBy("ArrDel15").agg(
        F.count(F.lit(1)).alias("vuelos"))
    everything = F.sum("vuelos").over(Window.partitionBy(F.lit(0)))
    return counted.withColumn("porcentaje", share(F.col("vuelos"), everything))


def delay_statistics(flights: DataFrame) -> DataFrame:
    """Centre, spread and extremes of delays and distance, in one scan."""
    found = Q.summarised(Q.histogram(flights, [], ["ArrDelay", "DepDelay", "Distance"]), [Q.VARIABLE], [
        rnd(Q.average(), 1).alias("media"),
        rnd(Q.deviation(), 1).alias("desv_estandar"),
        F.min(Q.VALUE).alias("minimo"),
        F.max(Q.VALUE).alias("maximo"),
    ], {"mediana": 0.5})
    return found.select(Q.VARIABLE, "media", rnd(F.col("mediana"), 1).alias("mediana"), "desv_estandar", "minimo", "maximo")


def late_share(flights: DataFrame, *keys: Column) -> DataFrame:
    """Flights with a known arrival and the percentage late, per key."""
    grouped = flights.where(F.col("ArrDel15").isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("vuelos"),
        F.count_if(F.col("ArrDel15") == 1).alias("atrasados"),
    )
    return grouped.withColumn("pct_atrasados", share(F.col("atrasados"), F.col("vuelos"))).drop("atrasados")


def late_by_weekday(flights: DataFrame) -> DataFrame:
    return late_share(flights, F.col("DayOfWeek")).withColumn(
        "dia", day_name(F.col("DayOfWeek"), DAY_SHORT)).orderBy(F.asc_nulls_last("DayOfWeek"))


def late_by_hour(flights: DataFrame) -> DataFrame:
    """By floor hour: midnight written as 2400 is a group of its own here."""
    scheduled = flights.where(F.col("CRSDepTime").isNotNull())
    return late_share(scheduled, floor_hour(F.col("CRSDepTime")).alias("hora_programada")).orderBy("hora_programada")


def late_by_airline(flights: DataFrame) -> DataFrame:
    return late_share(flights, F.col("Reporting_Airline")).orderBy(
        F.desc("pct_atrasados"), F.asc_nulls_last("Reporting_Airline"))


def late_by_airline_month(flights: DataFrame) -> DataFrame:
    keys = ["Year", "Month", "Reporting_Airline"]
    return late_share(flights, *map(F.col, keys)).orderBy(*[F.asc_nulls_last(k) for k in keys])


def late_routes(flights: DataFrame, p: Params, top: int = 15) -> DataFrame:
    """Routes above the floor with the highest share of late flights."""
    return (
        late_share(flights, F.col("Origin"), F.col("Dest")).where(F.col("vuelos") > p.route_floor)
        .orderBy(F.desc("pct_atrasados"), F.asc_nulls_last("Origin"), F.asc_nulls_last("Dest")).limit(top)
    )


def flight_count(flights: DataFrame) -> DataFrame:
    return flights.agg(F.count(F.lit(1)).alias("total_vuelos"))
