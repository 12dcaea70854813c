"""The flight lake: monthly Parquet partitions and the ledger of what was ingested."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundburn.functions.files import path_exists
from groundburn.schema import PARTITIONS

CONVERTED, SKIPPED = "convertido", "omitido"

LEDGER = "archivo string, anio long, mes long, estado string, columnas_faltantes array<string>, filas long"

#: A month is split into files of this many rows.
ROWS_PER_FILE = 5_000_000


def flights_path(lake: str) -> str:
    return f"{lake}/vuelos"


def ledger_path(lake: str) -> str:
    return f"{lake}/ingesta"


def write_months(flights: DataFrame, lake: str) -> None:
    """Replace exactly the months present in ``flights``; other months stay.

    Dynamic overwrite swaps a month in at commit, so a failed write leaves the
    old month in place.
    """
    (
        flights.write.mode("overwrite").partitionBy(*PARTITIONS)
        .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", ROWS_PER_FILE)
        .parquet(flights_path(lake))
    )


def read_ledger(spark: SparkSession, lake: str) -> DataFrame:
    """Every archive ever looked at, with its outcome and the run it belongs to."""
    if not path_exists(spark, ledger_path(lake)):
        return spark.createDataFrame([], f"{LEDGER}, run string")
    return spark.read.schema(f"{LEDGER}, run string").parquet(ledger_path(lake))


def write_ledger(rows: DataFrame, lake: str, run: str) -> DataFrame:
    """Record one run and return it as written. Repeating a run replaces its record."""
    rows.write.mode("overwrite").parquet(f"{ledger_path(lake)}/run={run}")
    return read_ledger(rows.sparkSession, lake).where(F.col("run") == run).drop("run")


def month_files(spark: SparkSession, lake: str) -> DataFrame:
    """Data files of every month, from the listing alone: path, length, modificationTime, anio, mes."""
    root = flights_path(lake)
    empty = spark.createDataFrame([], "path string, length long, modificationTime timestamp, anio long, mes long")
    if not path_exists(spark, root):
        return empty
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(root)
    if not set(PARTITIONS) <= set(files.columns):
        return empty
    return files.select("path", "length", "modificationTime",
                        *[F.col(c).cast("long").alias(name) for c, name in zip(PARTITIONS, ("anio", "mes"))])


def stored_months(spark: SparkSession, lake: str) -> DataFrame:
    """Months that have data files."""
    return month_files(spark, lake).select("anio", "mes").distinct()


def finished_months(spark: SparkSession, lake: str, apart_from: str = "") -> DataFrame:
    """Months recorded as converted, by any run but one, whose files are still there."""
    converted = (F.col("estado") == CONVERTED) & (F.col("run") != apart_from)
    recorded = read_ledger(spark, lake).where(converted).select("anio", "mes").distinct()
    return recorded.join(stored_months(spark, lake), ["anio", "mes"], "left_semi")
