"""Ingest: monthly archives into the flight lake, then every figure anew.

A month already converted is skipped, a damaged archive or one without the
required columns is reported and touches nothing, and a new month replaces
only itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundburn.functions.intermediate import materialise, materialised
from groundburn.functions.joins import join_sized
from groundburn.operators.exploration import cleaning_from
from groundburn.params import Params
from groundburn.plans.publish import lake_tables, publish, verify_published
from groundburn.plans.refresh import read_partials
from groundburn.schema import PARTITIONS
from groundburn.sinks.lake import (
    CONVERTED, SKIPPED, finished_months, flights_path, write_ledger, write_months,
)
from groundburn.sources.archives import (
    VALID, archive_statuses, flight_rows, list_archives, parse_archives, period_columns,
)
from groundburn.sources.flights import read_flights

_MONTH = ["anio", "mes"]

#: Archives are dealt to at most so many tasks.
MOST_TASKS = 10_000


def _judged(inspected: DataFrame, lake: str, run: str) -> DataFrame:
    """One row per archive with its final outcome.

    Of several sound archives for one month the first by name is taken. What
    this very run recorded before it was repeated does not count as finished.
    """
    finished = finished_months(inspected.sparkSession, lake, run).withColumn("hecho", F.lit(True))
    first = (
        inspected.where(F.col("estado") == VALID).groupBy(*_MONTH).agg(F.min("archivo").alias("elegido"))
    )
    known = inspected.join(finished, _MONTH, "left").join(first, _MONTH, "left")
    outcome = (
        F.when(F.col("hecho"), SKIPPED)
        .when(F.col("estado") != VALID, F.col("estado"))
        .when(F.col("archivo") == F.col("elegido"), CONVERTED)
        .otherwise(SKIPPED)
    )
    return known.select("archivo", *_MONTH, outcome.alias("estado"), "columnas_faltantes")


def convert(archives: DataFrame, lake: str, run: str) -> DataFrame:
    """Convert a set of archives (their paths in ``archivo``); the report of the run.

    Every archive is read once, into a typed table that is kept only until its
    months are written; what could be read of a bad archive is left behind
    there. From that table on, rows no longer belong to the task that unpacked
    them. The months are written before the ledger. A run that dies can be
    repeated under its name at any point, with the same result.
    """
    spark = archives.sparkSession
    paths = archives.select("archivo")
    paths = paths.repartition(max(1, min(paths.count(), MOST_TASKS)))
    with materialised(parse_archives(paths)) as parsed:
        judged = materialise(_judged(archive_statuses(parsed), lake, run))
        accepted = judged.where(F.col("estado") == CONVERTED)
        rows = join_sized(flight_rows(parsed), accepted.select("archivo"), ["archivo"], "left_semi")
        write_months(rows.drop("archivo"), lake)
    converted_rows = (
        read_flights(spark, flights_path(lake))
        .select(*[F.col(c).alias(name) for c, name in zip(PARTITIONS, _MONTH)])
        .join(accepted.select(*_MONTH), _MONTH, "left_semi")
        .groupBy(*_MONTH).agg(F.count(F.lit(1)).alias("filas"))
    )
    counted = accepted.join(converted_rows, _MONTH, "left")
    others = judged.where(F.col("estado") != CONVERTED).withColumn("filas", F.lit(None).cast("long"))
    columns = ["archivo", *_MONTH, "estado", "columnas_faltantes", "filas"]
    report = counted.select(columns).unionByName(others.select(columns))
    return write_ledger(report, lake, run)


def ingest(spark: SparkSession, folder: str, lake: str) -> DataFrame:
    """Bring the lake up to date with a folder of archives; one report row per archive.

    Archives of finished months are told from the listing and never opened.
    They are reported, but the ledger records only archives that were opened.
    """
    year, month = period_columns(F.col("archivo"))
    listed = materialise(list_archives(spark, folder).select("archivo", year.alias("anio"), month.alias("mes")))
    finished = materialise(finished_months(spark, lake))
    pending = listed.join(finished, _MONTH, "left_anti").select("archivo")
    skipped = listed.join(finished, _MONTH, "left_semi").select(
        "archivo", *_MONTH, F.lit(SKIPPED).alias("estado"),
        F.lit(None).cast("array<string>").alias("columnas_faltantes"), F.lit(None).cast("long").alias("filas"))
    if pending.isEmpty():
        return skipped
    return convert(pending, lake, uuid.uuid4().hex).unionByName(skipped)


def run_flow(
    spark: SparkSession, folder: str, lake: str, weather: DataFrame, out: str, p: Params,
    fuel_low: float | None = None, file_format: str = "parquet", verify: bool = False, known: Mapping | None = None,
) -> dict:
    """Ingest, measure data quality, and publish figures over the whole lake.

    Only months that changed are read. With ``verify`` the figures are computed
    again from all flights, and nothing is published unless they agree, with
    the ``known`` ones too. ``fuel_low`` replaces the low fuel rate for this run only.
    """
    if fuel_low is not None:
        p = replace(p, fuel_low=fuel_low)
    report = ingest(spark, folder, lake)
    tables = lake_tables(spark, lake, weather, p)
    quality = cleaning_from(read_partials(spark, lake)["calidad"])
    paths = publish(tables, out, file_format, gate(spark, lake, p, known) if verify else None)
    return {"report": report, "quality": quality, "published": paths}


def gate(spark: SparkSession, lake: str, p: Params, known: Mapping | None = None) -> Callable[[Mapping[str, DataFrame]], None]:
    """What keeps tables from being published unless the lake's flights give the same figures."""
    def check(tables: Mapping[str, DataFrame]) -> None:
        verify_published(read_flights(spark, flights_path(lake)), tables, p, known)

    return check
