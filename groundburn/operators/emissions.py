"""Published CO2 tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundburn.functions.numeric import co2_tonnes, hours, mean, rnd
from groundburn.functions.validity import both_valid
from groundburn.operators.measures import roll_up
from groundburn.params import HIGH, LOW, Params


def _co2(minutes, scenario: str, p: Params):
    return rnd(co2_tonnes(minutes, p.rate(scenario), p), 3)


def airport_month(segments: DataFrame, p: Params) -> DataFrame:
    """Populations B and C per airport and month, departures beside arrivals.

    Both sides are summed in one scan and then paired by grouping, the way a
    full outer join of two aggregates would pair them. Such a join never
    matches a NULL key, so those stay apart by side.
    """
    keys = ["aeropuerto", "anio", "mes"]
    unmatched = F.when(
        F.col("aeropuerto").isNull() | F.col("anio").isNull() | F.col("mes").isNull(), F.col("lado"))

    def side(name: str, column: str, zero):
        return F.coalesce(F.sum(F.when(F.col("lado") == name, F.col(column))), zero)

    totals = roll_up(segments, [*keys, "lado"]).groupBy(*keys, unmatched.alias("suelto")).agg(
        side("salida", "vuelos", F.lit(0)).alias("vuelos_salida"),
        side("llegada", "vuelos", F.lit(0)).alias("vuelos_llegada"),
        side("salida", "minutos", F.lit(0.0)).alias("salida"),
        side("llegada", "minutos", F.lit(0.0)).alias("llegada"),
    )
    out, arr = F.col("salida"), F.col("llegada")
    return totals.select(
        *keys,
        "vuelos_salida",
        "vuelos_llegada",
        (F.col("vuelos_salida") + F.col("vuelos_llegada")).alias("vuelos"),
        rnd(out, 1).alias("min_rodaje_salida"),
        rnd(arr, 1).alias("min_rodaje_llegada"),
        rnd(hours(out), 2).alias("horas_salida"),
        rnd(hours(arr), 2).alias("horas_llegada"),
        rnd(hours(out + arr), 2).alias("horas"),
        _co2(out, LOW, p).alias("co2_t_bajo_salida"),
        _co2(out, HIGH, p).alias("co2_t_alto_salida"),
        _co2(arr, LOW, p).alias("co2_t_bajo_llegada"),
        _co2(arr, HIGH, p).alias("co2_t_alto_llegada"),
        _co2(out + arr, LOW, p).alias("co2_t_bajo"),
        _co2(out + arr, HIGH, p).alias("co2_t_alto"),
    ).orderBy(F.asc_nulls_last("anio"), F.asc_nulls_last("mes"), F.asc_nulls_last("aeropuerto"))


def airport_hour(departures: DataFrame, p: Params) -> DataFrame:
    """Population D per airport and scheduled hour."""
    keys = ["aeropuerto", "hora"]
    minutes = F.col("minutos")
    return roll_up(departures.where(F.col("hora").isNotNull()), keys).select(
        *keys,
        "vuelos",
        rnd(mean(minutes, F.col("vuelos")), 2).alias("min_promedio_salida"),
        rnd(minutes, 1).alias("min_rodaje_salida"),
        _co2(minutes, LOW, p).alias("co2_t_bajo"),
        _co2(minutes, HIGH, p).alias("co2_t_alto"),
    ).orderBy(F.asc_nulls_last("aeropuerto"), "hora")


def year_totals(departures: DataFrame) -> DataFrame:
    """Population A per year: flights and minutes."""
    return roll_up(
        departures.where(F.col("vuelos_ambos") > 0), ["anio"],
        ("vuelos_ambos", "salida_ambos", "llegada_ambos"),
    )


def yearly_summary(departures: DataFrame, p: Params) -> DataFrame:
    """Population A per year."""
    out, arr = F.col("salida_ambos"), F.col("llegada_ambos")
    return year_totals(departures).select(
        "anio",
        F.col("vuelos_ambos").alias("vuelos"),
        rnd(hours(out), 2).alias("horas_salida"),
        rnd(hours(arr), 2).alias("horas_llegada"),
        rnd(hours(out + arr), 2).alias("horas"),
        _co2(out + arr, LOW, p).alias("co2_t_bajo"),
        _co2(out + arr, HIGH, p).alias("co2_t_alto"),
    ).orderBy(F.asc_nulls_last("anio"))


def yearly_summary_units(departures: DataFrame, p: Params) -> DataFrame:
    """Population A per year, whole hours and tonnes."""
    minutes = F.col("salida_ambos") + F.col("llegada_ambos")
    return year_totals(departures).select(
        "anio",
        F.col("vuelos_ambos").alias("vuelos"),
        rnd(hours(minutes)).alias("horas"),
        rnd(co2_tonnes(minutes, p.fuel_low, p)).alias("co2_t_bajo"),
        rnd(co2_tonnes(minutes, p.fuel_high, p)).alias("co2_t_alto"),
    ).orderBy(F.asc_nulls_last("anio"))


def departure_groups(departures: DataFrame) -> DataFrame:
    """Population D per airport, month and hour: the benchmark aggregation."""
    keys = ["aeropuerto", "anio", "mes", "hora"]
    return roll_up(departures.where(F.col("hora").isNotNull()), keys).select(
        *keys, F.col("minutos").alias("min_rodaje_salida"), "vuelos")


def departure_groups_total(departures: DataFrame, p: Params) -> DataFrame:
    """Number of benchmark groups and their CO2 in one row."""
    return departure_groups(departures).agg(
        F.count(F.lit(1)).alias("grupos"),
        rnd(co2_tonnes(F.sum("min_rodaje_salida"), p.fuel_low, p), 3).alias("co2_t_bajo"),
    )


def flight_co2(flights: DataFrame, p: Params) -> DataFrame:
    """Population A, one row per flight, with its CO2 in kg (low scenario)."""
    return flights.where(both_valid(p)).select(
        "FlightDate", "Reporting_Airline", "Flight_Number_Reporting_Airline", "Origin", "Dest",
        "CRSDepTime", "TaxiOut", "TaxiIn",
        ((F.col("TaxiOut") + F.col("TaxiIn")) * F.lit(p.fuel_low) * F.lit(p.co2_factor)).alias("co2_kg"),
    )
