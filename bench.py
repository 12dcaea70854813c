"""Time the headline queries; one JSON line on standard output.

    BENCH_SF_DIR   folder of test tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local threads (default 8)
    BENCH_COPIES   copies of the test tables' flights in a partitioned flight
                   table for the batch jobs (default 35, which at sf0.1 is the
                   size of the published measurements); 0 leaves them out
    BENCH_WORK     where that flight table is kept (default: a new temp folder,
                   removed at the end)

``value`` and ``queries`` are the queries over the test tables, ``batch_jobs``
the jobs over the flight table.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from groundburn.operators import coverage, emissions, exploration, taxi_quality  # noqa: E402
from groundburn.operators.measures import departures  # noqa: E402
from groundburn.plans.audit import audit_tables  # noqa: E402
from groundburn.plans.publish import emission_tables  # noqa: E402
from groundburn.registry import QUERIES  # noqa: E402
from groundburn.session import local_session  # noqa: E402
from groundburn.functions.intermediate import for_each  # noqa: E402
from groundburn.sinks.lake import flights_path, write_months  # noqa: E402
from groundburn.sources.flights import read_flights  # noqa: E402
from groundburn.sources.star import STAR_PARAMS, star_flights, star_weather  # noqa: E402

HEADLINE = (
    "benchmark_salida", "benchmark_total", "resumen_global", "co2_aeropuerto_mes", "co2_aeropuerto_hora",
    "rodaje_clima", "rodaje_clima_independiente", "escenario_ahorro", "limpieza", "co2_por_vuelo",
    "cobertura_resumen", "nulos_campos_criticos", "duplicados_resumen", "calidad_taxiout_por_anio",
    "universos_por_anio", "crsdeptime_clases", "desviados_pares", "clima_cobertura", "conciliacion_universos",
    "tendencia", "top_salida", "por_hora", "rodaje_excesivo", "etiqueta_excesivo",
    "estadisticas_atraso", "rutas_atrasadas", "atraso_aerolinea_mes",
    "kpi_tramos", "panel_lentos", "mapa_calor", "contract_check", "verificacion_exactitud",
)

#: On a machine where the queries take longer than this, the batch jobs are left out.
MOST_SECONDS = 300


def run(result: DataFrame) -> None:
    """Compute every row and column, keep none."""
    result.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def over_test_tables(spark: SparkSession, folder: str) -> dict[str, float]:
    run(QUERIES["total_vuelos"](spark, folder))  # start the executors
    return {name: timed(lambda: run(QUERIES[name](spark, folder))) for name in HEADLINE}


def flight_table(spark: SparkSession, folder: str, copies: int, work: str) -> DataFrame:
    """A partitioned flight table of n copies, written once per work folder."""
    root = flights_path(work)
    if not Path(root, "_SUCCESS").exists():
        copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copia")
        number = F.col("Flight_Number_Reporting_Airline")
        copied = (
            star_flights(spark, folder).select("*", copy)
            .withColumn("Flight_Number_Reporting_Airline", number + F.col("copia") * 1_000_000).drop("copia")
        )
        # One task per month, rows in no particular order.
        write_months(copied.repartition(64, "Year", "Month").sortWithinPartitions(
            "Year", "Month", F.xxhash64("FlightDate", "Flight_Number_Reporting_Airline")), work)
    return read_flights(spark, root)


def over_flight_table(spark: SparkSession, folder: str, copies: int, work: str) -> dict[str, float]:
    flights = flight_table(spark, folder, copies, work)
    weather = star_weather(spark, folder)
    p = STAR_PARAMS
    run(flights.agg(F.count(F.lit(1))))

    def all_of(tables: dict[str, DataFrame]) -> None:
        for_each(tables, lambda _, table: run(table))

    jobs = {
        "benchmark_salida": lambda: run(emissions.departure_groups(departures(flights, p))),
        "emission_tables": lambda: all_of(emission_tables(flights, weather, p)),
        "audit_tables": lambda: all_of(audit_tables(flights, weather, p)),
        "limpieza": lambda: run(exploration.cleaning_statistics(flights, p)),
        "duplicados_resumen": lambda: run(coverage.duplicates(flights)),
        "conciliacion_universos": lambda: run(taxi_quality.reconciliation(taxi_quality.taxi_state(flights, p), p)),
        "rodaje_excesivo": lambda: run(exploration.excessive_taxi(departures(flights, p), p)),
        "etiqueta_excesivo": lambda: run(exploration.excessive_label(flights, departures(flights, p), p)),
    }
    return {name: timed(job) for name, job in jobs.items()}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    copies = int(os.environ.get("BENCH_COPIES", "35"))
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench")
    times, more = over_test_tables(spark, folder), {}
    if copies and sum(times.values()) < MOST_SECONDS:
        with tempfile.TemporaryDirectory(prefix="groundburn-bench-") as own:
            jobs = over_flight_table(spark, folder, copies, os.environ.get("BENCH_WORK") or own)
        more = {"batch_jobs": jobs, "batch_copies": copies, "batch_total": round(sum(jobs.values()), 3)}
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": Path(folder).name.removeprefix("sf"), "cpus": cpus, **more,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
