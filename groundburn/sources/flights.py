"""The flight-leg table: Parquet under Year=/Month= directories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundburn.schema import FLIGHT


def read_flights(spark: SparkSession, root: str, view: str | None = None) -> DataFrame:
    """All months, with the declared types. Columns are pruned by whoever uses them."""
    flights = spark.read.schema(FLIGHT).parquet(root)
    if view:
        flights.createOrReplaceTempView(view)
    return flights


def one_month(flights: DataFrame, year: int, month: int) -> DataFrame:
    """One month; over the partitioned table only that directory is opened."""
    return flights.where((F.col("Year") == year) & (F.col("Month") == month))
