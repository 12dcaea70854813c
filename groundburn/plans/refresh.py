"""Partial aggregates by month, kept beside the flights in the lake.

Everything the published tables need adds up over months, so a month is summed
once and its sums are stored under its own partition. A month counts as done
for as long as its data files and the cap are those it was summed from; only
months for which that no longer holds are read again, and the tables are built
from the stored sums.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundburn.functions.files import file_system, path_exists
from groundburn.functions.intermediate import for_each
from groundburn.operators.exploration import TAXI_PAIR_SCHEMA, taxi_pairs
from groundburn.operators.measures import DEPARTURE_MEASURES, arrivals, departures, roll_up
from groundburn.params import Params
from groundburn.sinks.lake import flights_path, month_files
from groundburn.sources.flights import read_flights

_MONTH = ["anio", "mes"]
_DEPARTURE_KEYS = ["aeropuerto", "fecha", "hora"]


def _departures(flights: DataFrame, p: Params) -> DataFrame:
    return roll_up(departures(flights, p), [*_MONTH, *_DEPARTURE_KEYS], DEPARTURE_MEASURES)


def _arrivals(flights: DataFrame, p: Params) -> DataFrame:
    return roll_up(arrivals(flights, p), [*_MONTH, "aeropuerto", "lado"])


def _quality(flights: DataFrame, p: Params) -> DataFrame:
    return taxi_pairs(flights.withColumns({"anio": F.col("Year"), "mes": F.col("Month")}), p, _MONTH)


#: Name of each partial table: how a month is summed, and its stored columns.
PARTIALS: dict[str, tuple[Callable[[DataFrame, Params], DataFrame], str]] = {
    "salidas": (_departures, "aeropuerto string, fecha string, hora long, vuelos long, minutos double, "
                             "vuelos_ambos long, salida_ambos double, llegada_ambos double"),
    "llegadas": (_arrivals, "aeropuerto string, lado string, vuelos long, minutos double"),
    "calidad": (_quality, TAXI_PAIR_SCHEMA),
}
_DONE = "meses"


def _path(lake: str, name: str) -> str:
    return f"{lake}/parciales/{name}"


def _stored(spark: SparkSession, lake: str, name: str, columns: str) -> DataFrame:
    schema = T.StructType.fromDDL(f"{columns}, anio long, mes long")
    if not path_exists(spark, _path(lake, name)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(_path(lake, name))


def _versions(spark: SparkSession, lake: str, p: Params) -> DataFrame:
    """What each stored month is made of: its files and the cap, as one number."""
    files = F.array_sort(F.collect_list(F.struct("path", "length", "modificationTime")))
    return month_files(spark, lake).groupBy(*_MONTH).agg(F.xxhash64(files, F.lit(p.taxi_cap)).alias("version"))


def refresh(spark: SparkSession, lake: str, p: Params) -> list[tuple[int, int]]:
    """Bring the partial tables up to date; the months that were read.

    A month's mark is taken away before its sums are touched and set after all
    of them are stored, so a run that dies leaves months to be read again, never
    wrong sums that count as done.
    """
    now = _versions(spark, lake, p)
    done = _stored(spark, lake, _DONE, "version long")
    stale = now.join(done, [*_MONTH, "version"], "left_anti").collect()  # one row per month, here and below
    gone = done.join(now, _MONTH, "left_anti").collect()
    if not stale and not gone:
        return []
    fs, path = file_system(spark, lake)
    for name in (_DONE, *PARTIALS):
        for row in (*stale, *gone):
            fs.delete(path(f"{_path(lake, name)}/anio={row.anio}/mes={row.mes}"), True)
    months = sorted((row.anio, row.mes) for row in stale)
    if months:
        flights = read_flights(spark, flights_path(lake)).where(
            " OR ".join(f"(Year = {year} AND Month = {month})" for year, month in months))

        def write(name: str, table: DataFrame) -> None:
            table.repartition(*_MONTH).write.mode("overwrite").partitionBy(*_MONTH).option(
                "partitionOverwriteMode", "dynamic").parquet(_path(lake, name))

        for_each({name: summed(flights, p) for name, (summed, _) in PARTIALS.items()}, write)
        write(_DONE, spark.createDataFrame([(r.version, r.anio, r.mes) for r in stale], "version long, anio long, mes long"))
    return months


def read_partials(spark: SparkSession, lake: str) -> dict[str, DataFrame]:
    """The partial tables by name; sums of all months that are marked as done."""
    return {name: _stored(spark, lake, name, columns) for name, (_, columns) in PARTIALS.items()}
