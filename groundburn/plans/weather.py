"""The weather table kept up to date with newly saved answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundburn.functions.intermediate import materialised
from groundburn.schema import WEATHER
from groundburn.sinks.tables import read_table, replace_tables, table_exists
from groundburn.sources.weather import first_per_day, read_weather_csv, read_weather_json

TABLE = "clima"
#: Whose row of an airport and day stays.
STORED_FIRST, NEW_FIRST = "stored", "new"


def read_weather(spark: SparkSession, location: str) -> DataFrame:
    """The table kept by :func:`merge_weather` in a folder, or any weather CSV."""
    if table_exists(spark, location, TABLE, "csv"):
        return read_table(spark, location, TABLE, "csv").select(*WEATHER.names)
    return read_weather_csv(spark, location)


def merge_weather(spark: SparkSession, answers: str, folder: str, first: str = STORED_FIRST) -> DataFrame:
    """Merge a folder of saved answers into the table, by airport and day; one
    row about the outcome. A failure leaves the table as it was."""
    if first not in (STORED_FIRST, NEW_FIRST):
        raise ValueError(f"unknown order {first!r}")
    new = read_weather_json(spark, answers).withColumn("orden", F.lit(1 if first == STORED_FIRST else 0))
    if table_exists(spark, folder, TABLE, "csv"):
        stored = read_weather(spark, folder).withColumn("orden", F.lit(0 if first == STORED_FIRST else 1))
    else:
        stored = new.limit(0)
    rows = stored.select(*WEATHER.names, "orden").unionByName(new.select(*WEATHER.names, "orden"))
    with materialised(rows) as both:
        merged = first_per_day(both, ["orden"])
        replace_tables({TABLE: merged.orderBy("Origin", "Fecha")}, folder, "csv")
        total = both.count()
        summary = read_weather(spark, folder).agg(
            F.count(F.lit(1)).alias("filas"), F.count_distinct("Origin").alias("aeropuertos"),
            F.min("Fecha").alias("fecha_minima"), F.max("Fecha").alias("fecha_maxima"))
        return summary.withColumn("duplicados", F.lit(total) - F.col("filas"))
