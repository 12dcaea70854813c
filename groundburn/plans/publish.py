"""The emissions batch: six published tables and the benchmark aggregation."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundburn.functions.files import read_text
from groundburn.functions.intermediate import materialise
from groundburn.operators import contracts, emissions, savings, verification, weather_effect
from groundburn.operators.exploration import cleaning_statistics
from groundburn.operators.measures import DEPARTURE_MEASURES, arrivals, departures, roll_up, segments_from
from groundburn.params import Params
from groundburn.plans.refresh import read_partials, refresh
from groundburn.sinks.tables import replace_tables

#: Level of the shared departure roll-up: fine enough for every published table.
ROLL_UP_KEYS = ["aeropuerto", "anio", "mes", "fecha", "hora"]


def departure_roll_up(flights: DataFrame, p: Params) -> DataFrame:
    """Population B summed to airport, day and hour.

    Its size is bounded by airports x days x hours, however many flights
    there are, and it is kept in the checkpoint folder so that the tables
    built from it do not read the flights again.
    """
    return materialise(roll_up(departures(flights, p), ROLL_UP_KEYS, DEPARTURE_MEASURES))


def emission_tables(flights: DataFrame, weather: DataFrame, p: Params) -> dict[str, DataFrame]:
    """Every published table from two scans of the flights."""
    return tables_from(departure_roll_up(flights, p), arrivals(flights, p), weather, p)


def tables_from(daily: DataFrame, landed: DataFrame, weather: DataFrame, p: Params) -> dict[str, DataFrame]:
    """Every published table from departures by airport, day and hour, and from
    arrivals, as flights or summed in any way."""
    return {
        "resumen_global": emissions.yearly_summary(daily, p),
        "co2_aeropuerto_mes": emissions.airport_month(segments_from(daily, landed), p),
        "co2_aeropuerto_hora": emissions.airport_hour(daily, p),
        "rodaje_clima": weather_effect.by_main_condition(daily, weather, p),
        "rodaje_clima_independiente": weather_effect.by_each_condition(daily, weather, p),
        "escenario_ahorro": savings.savings(daily, p),
        "benchmark_salida": emissions.departure_groups(daily),
    }


def lake_tables(spark: SparkSession, lake: str, weather: DataFrame, p: Params) -> dict[str, DataFrame]:
    """Every published table of a lake; only months that changed are read."""
    refresh(spark, lake, p)
    summed = read_partials(spark, lake)
    landed = summed["llegadas"].select("aeropuerto", "anio", "mes", "lado", "minutos", "vuelos")
    return tables_from(summed["salidas"], landed, weather, p)


def publish(
    tables: Mapping[str, DataFrame], folder: str, file_format: str = "parquet",
    check: Callable[[dict[str, DataFrame]], None] | None = None,
) -> list[str]:
    """Write the tables to contract; nothing is replaced unless all of them were
    computed and ``check`` let them pass."""
    return replace_tables(
        {name: contracts.to_contract(name, table) for name, table in tables.items()}, folder, file_format, check)


def read_figures(spark: SparkSession, location: str) -> dict:
    """Known figures and ranking: {"figures": {measure: value}, "ranking": [[airport, tonnes], ...]}, each optional."""
    text = read_text(spark, location)
    if text is None:
        raise FileNotFoundError(location)
    known = json.loads(text)
    if not isinstance(known, dict) or not known or set(known) - {"figures", "ranking"}:
        raise ValueError(f"{location}: an object with figures, ranking or both is wanted")
    return known


def verify_published(
    flights: DataFrame, tables: Mapping[str, DataFrame], p: Params, known: Mapping | None = None,
) -> DataFrame:
    """Re-compute the headline figures and the ranking from the flights, and
    hold them against known ones if there are any.

    Returns the checks; raises :class:`VerificationError` if one fails.
    """
    spark = flights.sparkSession
    published = materialise(verification.published_figures(tables, cleaning_statistics(flights, p)))
    checks = verification.compare(verification.recomputed_figures(flights, p), published)
    verification.require_all(checks)
    months = tables["co2_aeropuerto_mes"]
    verification.require_all(verification.verify_ranking(months, verification.ranking(flights, p)))
    known = known or {}
    if "figures" in known:
        wanted = verification.pinned(spark, known["figures"])
        pinned = verification.compare(wanted, published.join(wanted.select("medida"), "medida", "left_semi"))
        verification.require_all(pinned)
        checks = checks.unionByName(pinned.withColumn("medida", F.concat(F.lit("conocida_"), "medida")))
    if "ranking" in known:
        places = known["ranking"]
        verification.require_all(verification.verify_ranking(months, verification.pinned_ranking(spark, places), len(places)))
    return checks
