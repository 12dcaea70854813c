"""What less taxiing would avoid, low scenario.

Two separate estimates that must not be added up: a uniform cut of all
taxiing, and slow large airports brought down to the median airport
(departures only).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundburn.functions.numeric import co2_tonnes, mean, rnd, share
from groundburn.operators.measures import DEPARTURE_MEASURES, roll_up
from groundburn.params import Params

# Concept names and explanatory texts of the published table.
CUT = "bajar_rodaje_10_porciento"
CUT_TEXT = "El CO2 baja el mismo 10 % porque el factor es lineal"
SLOW = "salida_lenta_hasta_mediana"
SLOW_TEXT = (
    "Aeropuertos con más de %d vuelos de salida cuyo promedio supera la mediana (%.2f min) "
    "bajan hasta esa mediana. Solo cuenta el rodaje de salida."
)
NOT_ADDITIVE = "No sumar las dos intervenciones"


def _estimate(departures: DataFrame, p: Params, flights_col: str, minutes_col: str) -> DataFrame:
    """One row: minutes of population A, the cut, the median and the minutes above it.

    The slow-airport part uses the population behind ``flights_col`` and
    ``minutes_col``. Only one row per airport leaves the first aggregation.
    """
    airports = roll_up(departures, ["aeropuerto"], DEPARTURE_MEASURES).select(
        (F.col("salida_ambos") + F.col("llegada_ambos")).alias("min_ambos"),
        F.col(flights_col).alias("n"),
        mean(F.col(minutes_col), F.col(flights_col)).alias("promedio"),
    )
    large = F.col("n") > p.ranking_floor
    median = airports.where(large).select(F.median("promedio")).scalar()
    above = F.col("promedio") - F.col("mediana")
    return airports.withColumn("mediana", median).agg(
        F.sum("min_ambos").alias("minutos"),
        F.first("mediana").alias("mediana"),
        F.sum(F.when(large, F.greatest(above, F.lit(0.0)) * F.col("n"))).alias("sobre_mediana"),
    )


def _slow_text(p: Params) -> Column:
    """NULL when no airport is large enough to have a median."""
    return F.when(F.col("mediana").isNotNull(), F.format_string(SLOW_TEXT, F.lit(p.ranking_floor), F.col("mediana")))


def savings(departures: DataFrame, p: Params) -> DataFrame:
    """Both estimates; slow airports measured on population B."""
    current = co2_tonnes(F.col("minutos"), p.fuel_low, p)
    cut = co2_tonnes(F.col("minutos") * F.lit(p.cut_share), p.fuel_low, p)
    slow = co2_tonnes(F.col("sobre_mediana"), p.fuel_low, p)

    def row(concept: str, text: Column, avoided: Column) -> Column:
        return F.struct(
            F.lit(concept).alias("concepto"),
            text.alias("detalle"),
            rnd(current, 3).alias("co2_t_bajo_actual"),
            rnd(avoided, 3).alias("co2_t_evitado"),
            rnd(current - avoided, 3).alias("co2_t_bajo_escenario"),
        )

    return _estimate(departures, p, "vuelos", "minutos").select(
        F.inline(F.array(row(CUT, F.lit(CUT_TEXT), cut), row(SLOW, _slow_text(p), slow))))


def savings_population_a(departures: DataFrame, p: Params) -> DataFrame:
    """Sensitivity: both estimates measured on population A."""
    reference = co2_tonnes(F.col("minutos"), p.fuel_low, p)

    def row(concept: str, text: Column, minutes: Column) -> Column:
        avoided = co2_tonnes(minutes, p.fuel_low, p)
        return F.struct(
            F.lit(concept).alias("concepto"),
            text.alias("detalle"),
            F.lit("ambos_validos").alias("universo"),
            rnd(reference, 3).alias("co2_t_referencia"),
            rnd(minutes, 1).alias("minutos_evitados"),
            rnd(avoided, 3).alias("co2_t_evitado"),
            rnd(reference - avoided, 3).alias("co2_t_posterior"),
            share(avoided, reference).alias("pct_reduccion"),
            F.lit(NOT_ADDITIVE).alias("nota_no_sumar"),
        )

    return _estimate(departures, p, "vuelos_ambos", "salida_ambos").select(F.inline(F.array(
        row(CUT, F.lit(CUT_TEXT), F.col("minutos") * F.lit(p.cut_share)),
        row(SLOW, _slow_text(p), F.col("sobre_mediana")),
    )))
