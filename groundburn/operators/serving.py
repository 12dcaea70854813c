"""Panel and dashboard queries over the published tables, never over flights.

The figures add up rows that are already rounded, which is what a reader of
the published tables would get.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundburn.functions.calendar import period
from groundburn.functions.numeric import mean, rnd
from groundburn.params import LOW, Params

# Segment types.
BOTH_SIDES = ("salida", "llegada")


def _co2(scenario: str, side: str | None = None) -> str:
    return f"co2_t_{scenario}" if side is None else f"co2_t_{scenario}_{side}"


# Panels -------------------------------------------------------------------

def segment_kpi(airport_month: DataFrame) -> DataFrame:
    """Valid taxi segments (not flights) and the mean minutes of one."""
    totals = airport_month.agg(
        (F.sum("vuelos_salida") + F.sum("vuelos_llegada")).alias("tramos_rodaje_validos"),
        (F.sum("min_rodaje_salida") + F.sum("min_rodaje_llegada")).alias("minutos"),
    )
    return totals.select(
        "tramos_rodaje_validos",
        rnd(mean(F.col("minutos"), F.col("tramos_rodaje_validos")), 2).alias("tiempo_promedio_por_tramo_min"),
    )


def co2_kpi(yearly: DataFrame, scenario: str = LOW) -> DataFrame:
    return yearly.agg(rnd(F.sum(_co2(scenario))).alias("toneladas"))


def co2_by_year(yearly: DataFrame, scenario: str = LOW) -> DataFrame:
    return yearly.select("anio", rnd(F.col(_co2(scenario))).alias("toneladas")).orderBy("anio")


def top_departure_airports(airport_month: DataFrame, scenario: str = LOW, top: int = 10) -> DataFrame:
    return airport_month.groupBy("aeropuerto").agg(
        rnd(F.sum(_co2(scenario, "salida"))).alias("co2_salida_t"),
    ).orderBy(F.desc_nulls_last("co2_salida_t"), F.asc_nulls_last("aeropuerto")).limit(top)


def co2_by_hour_kilotonnes(airport_hour: DataFrame, scenario: str = LOW) -> DataFrame:
    return airport_hour.groupBy("hora").agg(
        rnd(F.sum(_co2(scenario)) / F.lit(1000.0), 1).alias("miles_de_toneladas")).orderBy("hora")


def co2_by_hour_tonnes(airport_hour: DataFrame, scenario: str = LOW) -> DataFrame:
    return airport_hour.groupBy("hora").agg(rnd(F.sum(_co2(scenario))).alias("co2_t")).orderBy("hora")


def hour_map(airport_hour: DataFrame, airports: Sequence[str]) -> DataFrame:
    """CO2 per hour and airport for a chosen list of airports."""
    return airport_hour.where(F.col("aeropuerto").isin(list(airports))).groupBy("hora", "aeropuerto").agg(
        rnd(F.sum(_co2(LOW)), 1).alias("co2_t")).orderBy("hora", "aeropuerto")


def hour_map_of_top(airport_hour: DataFrame, airport_month: DataFrame, top: int = 10) -> DataFrame:
    """CO2 per hour for the airports with most departure CO2."""
    chosen = top_departure_airports(airport_month, LOW, top).select("aeropuerto")
    return airport_hour.join(chosen, "aeropuerto", "left_semi").groupBy("hora", "aeropuerto").agg(
        rnd(F.sum(_co2(LOW)), 1).alias("co2_t")).orderBy("hora", "aeropuerto")


def slow_airport_panel(airport_month: DataFrame, p: Params, top: int = 10) -> DataFrame:
    totals = airport_month.groupBy("aeropuerto").agg(
        F.sum("min_rodaje_salida").alias("minutos"), F.sum("vuelos_salida").alias("vuelos"))
    return totals.where(F.col("vuelos") > p.ranking_floor).select(
        "aeropuerto",
        rnd(mean(F.col("minutos"), F.col("vuelos")), 1).alias("minutos_promedio"),
        "vuelos",
    ).orderBy(F.desc("minutos_promedio"), F.asc_nulls_last("aeropuerto")).limit(top)


def savings_panel(savings: DataFrame) -> DataFrame:
    return savings.select(
        "concepto", "detalle",
        rnd(F.col("co2_t_bajo_actual")).alias("co2_actual_t"),
        rnd(F.col("co2_t_evitado")).alias("co2_evitado_t"),
        rnd(F.col("co2_t_bajo_escenario")).alias("co2_si_se_logra_t"),
    )


def weather_panel(each_condition: DataFrame) -> DataFrame:
    return each_condition.select("condicion", "vuelos", "min_promedio_salida").orderBy(
        F.desc_nulls_last("min_promedio_salida"), "condicion")


# Dashboard ----------------------------------------------------------------

def selection(
    airport_month: DataFrame, years: Sequence[int],
    sides: Sequence[str] = BOTH_SIDES, scenario: str = LOW,
) -> DataFrame:
    """Airport-months of the chosen years with the chosen sides added up."""
    def across(prefix: str):
        columns = [F.coalesce(F.col(f"{prefix}_{side}"), F.lit(0)) for side in sides]
        return reduce(add, columns) if columns else F.lit(0.0)

    return airport_month.where(F.col("anio").isin(list(years))).select(
        "aeropuerto", "anio", "mes",
        period(F.col("anio"), F.col("mes")).alias("periodo"),
        across(f"co2_t_{scenario}").alias("co2_t"),
        across("horas").alias("horas_sel"),
        across("vuelos").alias("vuelos_sel"),
    )


def dashboard_kpi(
    airport_month: DataFrame, p: Params, years: Sequence[int],
    sides: Sequence[str] = BOTH_SIDES, scenario: str = LOW,
) -> DataFrame:
    """Segments, hours, CO2 and the avoidable share; no row when nothing is chosen."""
    totals = selection(airport_month, years, sides, scenario).agg(
        F.coalesce(F.sum("vuelos_sel"), F.lit(0)).cast("long").alias("tramos"),
        rnd(F.coalesce(F.sum("horas_sel"), F.lit(0.0)), 2).alias("horas"),
        rnd(F.coalesce(F.sum("co2_t"), F.lit(0.0)), 3).alias("co2_t"),
    )
    figures = totals.withColumn("co2_evitable_t", rnd(F.col("co2_t") * F.lit(p.cut_share), 3))
    return figures if years and sides else figures.limit(0)


def dashboard_top(chosen: DataFrame, top: int = 15) -> DataFrame:
    """Airports with most CO2, listed from the smallest up as the chart draws them."""
    largest = chosen.groupBy("aeropuerto").agg(rnd(F.sum("co2_t"), 3).alias("co2_t")).orderBy(
        F.desc("co2_t"), F.asc_nulls_last("aeropuerto")).limit(top)
    return largest.orderBy("co2_t", F.desc("aeropuerto"))


def dashboard_monthly(chosen: DataFrame) -> DataFrame:
    return chosen.groupBy("periodo").agg(rnd(F.sum("co2_t"), 3).alias("co2_t")).orderBy("periodo")


def dashboard_hourly(airport_hour: DataFrame, scenario: str = LOW) -> DataFrame:
    name = _co2(scenario)
    return airport_hour.groupBy("hora").agg(rnd(F.sum(name), 3).alias(name)).orderBy("hora")


def heat_map(airport_hour: DataFrame, scenario: str = LOW, top: int = 20) -> DataFrame:
    """Mean taxi-out by airport (rows, most CO2 first) and hour (columns)."""
    ranked = airport_hour.groupBy("aeropuerto").agg(rnd(F.sum(_co2(scenario)), 3).alias("total")).orderBy(
        F.desc("total"), F.asc_nulls_last("aeropuerto")).limit(top)
    table = airport_hour.groupBy("aeropuerto").pivot("hora", list(range(24))).agg(F.avg("min_promedio_salida"))
    return table.join(ranked, "aeropuerto").orderBy(F.desc("total"), F.asc_nulls_last("aeropuerto")).drop("total")
