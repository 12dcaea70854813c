"""Exploratory statistics of taxi times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundburn.functions import quantiles as Q
from groundburn.functions.calendar import day_name
from groundburn.functions.clock import hour, plain_hour, rounded_hour
from groundburn.functions.intermediate import materialise
from groundburn.functions.joins import join_sized
from groundburn.functions.numeric import co2_tonnes, hours, mean, rnd, share, tally
from groundburn.functions.validity import both_valid, departure_valid, false_hour_24, flagged
from groundburn.operators.measures import roll_up
from groundburn.params import Params


_COUNTERS = (
    "filas", "taxiout_nulo", "taxiin_nulo", "vuelos_validos", "cancelados", "desviados", "crs_2400",
    "desviados_dentro_de_validos", "grupo_hora_24_cast",
)
TAXI_PAIR_SCHEMA = "TaxiOut double, TaxiIn double, " + ", ".join(f"{name} long" for name in _COUNTERS)


def taxi_pairs(flights: DataFrame, p: Params, keys: Sequence[str] = ()) -> DataFrame:
    """Counters per pair of taxi times: they add up, and there are few pairs."""
    conditions = (
        F.lit(True), F.col("TaxiOut").isNull(), F.col("TaxiIn").isNull(), both_valid(p), flagged("Cancelled"),
        flagged("Diverted"), F.col("CRSDepTime") == 2400, both_valid(p) & flagged("Diverted"), false_hour_24(p),
    )
    return flights.groupBy(*keys, "TaxiOut", "TaxiIn").agg(
        *[tally(c).alias(name) for name, c in zip(_COUNTERS, conditions, strict=True)])


def cleaning_statistics(flights: DataFrame, p: Params) -> DataFrame:
    """One row of global statistics, cap not applied to them, from one scan."""
    return cleaning_from(taxi_pairs(flights, p))


def cleaning_from(pairs: DataFrame) -> DataFrame:
    """:func:`cleaning_statistics` from :func:`taxi_pairs`, of any keys.

    A pair stands once under each of its two columns, weighted by its rows;
    flags are added up under the first alone.
    """
    both_columns = pairs.unpivot(list(_COUNTERS), ["TaxiOut", "TaxiIn"], Q.VARIABLE, Q.VALUE)
    once = F.col(Q.VARIABLE) == "TaxiOut"
    counted = both_columns.groupBy(Q.VARIABLE, Q.VALUE).agg(
        F.sum("filas").alias(Q.WEIGHT), *[F.sum(F.when(once, F.col(name))).alias(name) for name in _COUNTERS])
    out, arr = F.col(Q.VARIABLE) == "TaxiOut", F.col(Q.VARIABLE) == "TaxiIn"
    counted = materialise(counted)
    medians = Q.summarised(counted, [Q.VARIABLE], [], {"mediana": 0.5}, stored=True)

    def median(only):
        return medians.agg(F.max(F.when(only, F.col("mediana")))).scalar()

    def average(only):
        value, rows = F.when(only, F.col(Q.VALUE)), F.col(Q.WEIGHT)
        return rnd(mean(F.sum(value * rows), F.sum(F.when(value.isNotNull(), rows))), 2)

    def total(name):
        return F.sum(name).alias(name)

    return counted.agg(
        F.coalesce(F.sum("filas"), F.lit(0)).alias("filas"),
        total("taxiout_nulo"), total("taxiin_nulo"), total("vuelos_validos"),
        F.max(F.when(out, F.col(Q.VALUE))).alias("taxiout_max"),
        F.max(F.when(arr, F.col(Q.VALUE))).alias("taxiin_max"),
        average(out).alias("taxiout_media"),
        median(out).alias("taxiout_mediana"),
        average(arr).alias("taxiin_media"),
        median(arr).alias("taxiin_mediana"),
        total("cancelados"), total("desviados"), total("crs_2400"),
        total("desviados_dentro_de_validos"), total("grupo_hora_24_cast"),
    )


def global_check(flights: DataFrame, p: Params) -> DataFrame:
    """One row of headline totals in whole units."""
    minutes = F.sum(F.when(both_valid(p), F.col("TaxiOut") + F.col("TaxiIn")).otherwise(0.0))
    return flights.agg(
        F.count(F.lit(1)).alias("filas"),
        tally(F.col("TaxiOut").isNull()).alias("taxiout_nulo"),
        tally(F.col("TaxiIn").isNull()).alias("taxiin_nulo"),
        tally(both_valid(p)).alias("vuelos_validos"),
        rnd(hours(minutes)).alias("horas_total"),
        rnd(co2_tonnes(minutes, p.fuel_low, p)).alias("co2_t_bajo"),
        rnd(co2_tonnes(minutes, p.fuel_high, p)).alias("co2_t_alto"),
        tally(false_hour_24(p)).alias("grupo_hora_24_cast"),
    )


def wrong_hour_summary(flights: DataFrame, p: Params) -> DataFrame:
    """Population B: size of the false hour 24."""
    t = F.col("CRSDepTime")
    return flights.where(departure_valid(p)).agg(
        F.count(F.lit(1)).alias("filas"),
        tally(t == 2400).alias("valor_2400"),
        F.max(t).alias("maximo"),
        tally((rounded_hour(t) == 24) & (t < 2400)).alias("grupo_24"),
    )


def wrong_hour_examples(flights: DataFrame) -> DataFrame:
    """Scheduled times from 23:50 on, under the wrong and the right quotient."""
    t = F.col("CRSDepTime")
    return flights.where(t.between(2350, 2400)).groupBy("CRSDepTime").agg(F.count(F.lit(1)).alias("vuelos")).select(
        "CRSDepTime", rounded_hour(t).alias("hora_con_cast"), plain_hour(t).alias("hora_correcta"), "vuelos",
    ).orderBy("CRSDepTime")


def global_quality(flights: DataFrame, p: Params) -> DataFrame:
    """Nulls, extremes and the flagged flights inside population A."""
    return flights.agg(
        F.count(F.lit(1)).alias("filas"),
        tally(F.col("TaxiOut").isNull()).alias("taxiout_nulo"),
        tally(F.col("TaxiIn").isNull()).alias("taxiin_nulo"),
        tally(flagged("Cancelled")).alias("cancelados"),
        tally(flagged("Diverted")).alias("desviados"),
        tally(F.col("TaxiOut") > p.taxi_cap).alias("taxiout_sobre_180"),
        tally(F.col("TaxiIn") > p.taxi_cap).alias("taxiin_sobre_180"),
        F.max("TaxiOut").alias("taxiout_max"),
        F.max("TaxiIn").alias("taxiin_max"),
        tally(both_valid(p) & flagged("Cancelled")).alias("cancelados_dentro_de_validos"),
        tally(both_valid(p) & flagged("Diverted")).alias("desviados_dentro_de_validos"),
    )


def tendency(flights: DataFrame) -> DataFrame:
    """Centre, spread and tail of both taxi columns, cap not applied."""
    return Q.summarised(Q.histogram(flights, [], ["TaxiOut", "TaxiIn"]), [Q.VARIABLE], [
        Q.present().alias("n"),
        rnd(Q.average(), 2).alias("media"),
        rnd(Q.deviation(), 2).alias("desviacion"),
        F.max(Q.VALUE).alias("maximo"),
    ], {"mediana": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}).select(
        Q.VARIABLE, "n", "media", "mediana", "desviacion", "p90", "p95", "p99", "maximo")


def departure_histogram(flights: DataFrame, last_minute: int = 60) -> DataFrame:
    """Flights per whole minute of taxi-out."""
    minute = F.rint("TaxiOut").cast("int")
    return flights.where(F.col("TaxiOut").between(0, last_minute)).groupBy(minute.alias("minuto")).agg(
        F.count(F.lit(1)).alias("vuelos")).orderBy("minuto")


def _average(digits: int):
    return rnd(mean(F.col("minutos"), F.col("vuelos")), digits).alias("min_promedio")


def _low_co2(p: Params):
    return rnd(co2_tonnes(F.col("minutos"), p.fuel_low, p)).alias("co2_t_bajo")


def top_airports(departures: DataFrame, p: Params, top: int = 10) -> DataFrame:
    """Airports with most departure CO2."""
    return roll_up(departures, ["aeropuerto"]).select(
        "aeropuerto", "vuelos", _average(1), _low_co2(p),
    ).orderBy(F.desc("co2_t_bajo"), F.asc_nulls_last("aeropuerto")).limit(top)


def slow_airports(departures: DataFrame, p: Params, top: int = 8) -> DataFrame:
    """Slowest airports among those above the ranking floor."""
    return roll_up(departures, ["aeropuerto"]).where(F.col("vuelos") > p.ranking_floor).select(
        "aeropuerto", "vuelos", _average(1),
    ).orderBy(F.desc("min_promedio"), F.asc_nulls_last("aeropuerto")).limit(top)


def by_hour(departures: DataFrame, p: Params) -> DataFrame:
    """Population D per scheduled hour."""
    kilotonnes = co2_tonnes(F.col("minutos"), p.fuel_low, p) / F.lit(1000.0)
    return roll_up(departures.where(F.col("hora").isNotNull()), ["hora"]).select(
        "hora", "vuelos", _average(2), rnd(kilotonnes, 1).alias("miles_de_toneladas"),
    ).orderBy("hora")


def peak_hours(departures: DataFrame, p: Params) -> DataFrame:
    """Hour with most CO2 and hour with the longest taxi; the earlier hour wins a tie."""
    def earliest_peak(column: str):
        return F.max_by("hora", F.struct(F.col(column), -F.col("hora")))

    return by_hour(departures, p).agg(
        earliest_peak("miles_de_toneladas").alias("hora_mas_co2"),
        earliest_peak("min_promedio").alias("hora_mas_lenta"),
    )


def by_weekday(departures: DataFrame) -> DataFrame:
    return roll_up(departures, ["dia"]).select(
        "dia", "vuelos", _average(2), day_name(F.col("dia")).alias("dia_nombre"),
    ).orderBy(F.asc_nulls_last("dia"))


def by_calendar_month(departures: DataFrame) -> DataFrame:
    return roll_up(departures, ["mes"]).select("mes", "vuelos", _average(2)).orderBy(F.asc_nulls_last("mes"))


def by_airline(departures: DataFrame, p: Params, top: int = 8) -> DataFrame:
    """Airlines with most departure CO2."""
    return roll_up(departures, ["aerolinea"]).select(
        "aerolinea", "vuelos", _average(2), _low_co2(p),
    ).orderBy(F.desc("co2_t_bajo"), F.asc_nulls_last("aerolinea")).limit(top)


def _airport_histogram(departures: DataFrame) -> DataFrame:
    return departures.groupBy("aeropuerto", "minutos").agg(F.sum("vuelos").alias("n"))


def excessive_taxi(departures: DataFrame, p: Params) -> DataFrame:
    """Departures longer than their own airport's quantile.

    Both the limit and the comparison come from the airport's minute histogram
    (at most one row per minute up to the cap), so flights are scanned once
    and never joined to themselves.
    """
    counted = materialise(_airport_histogram(departures.where(F.col("aeropuerto").isNotNull())))
    limits = excessive_limits_of(counted, p, stored=True).withColumnRenamed("p90", "limite")
    compared = join_sized(counted, limits, ["aeropuerto"]).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("vuelos_salida"),
        tally(F.col("minutos") > F.col("limite"), F.col("n")).alias("rodaje_excesivo"),
    )
    return compared.withColumn("porcentaje", share(F.col("rodaje_excesivo"), F.col("vuelos_salida")))


def excessive_limits(departures: DataFrame, p: Params) -> DataFrame:
    """Per airport, the taxi-out above which a departure is excessive."""
    return excessive_limits_of(_airport_histogram(departures), p)


def excessive_limits_of(counted: DataFrame, p: Params, stored: bool = False) -> DataFrame:
    return Q.summarised(counted, ["aeropuerto"], [], {"p90": p.excess_quantile}, "minutos", "n", stored)


def excessive_label(flights: DataFrame, departures: DataFrame, p: Params) -> DataFrame:
    """Population B, one row per flight, labelled excessive or not.

    The features beside the label are known before departure. One limit per
    airport is joined; it is broadcast only after being counted.
    """
    candidates = flights.where(departure_valid(p)).select(
        "FlightDate", "Reporting_Airline", "Flight_Number_Reporting_Airline", "Origin", "Dest",
        "DayOfWeek", "Month", hour(F.col("CRSDepTime")).alias("hora"), "TaxiOut",
    )
    limits = excessive_limits(departures, p).withColumnRenamed("aeropuerto", "Origin")
    return join_sized(candidates, limits, ["Origin"]).withColumn(
        "rodaje_excesivo", F.col("TaxiOut") > F.col("p90"))
