"""Daily weather per airport, from CSV or from saved API answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundburn.schema import WEATHER

# Field of the answer -> column of the weather table.
ANSWER_FIELDS = {
    "precipitation_sum": "precipitacion_mm",
    "snowfall_sum": "nieve_cm",
    "wind_speed_10m_max": "viento_max_kmh",
    "temperature_2m_mean": "temp_media_c",
}

_ANSWER = T.StructType([
    T.StructField("daily", T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()))]
        + [T.StructField(name, T.ArrayType(T.DoubleType())) for name in ANSWER_FIELDS]
    )),
])


def read_weather_csv(spark: SparkSession, path: str) -> DataFrame:
    """Weather table with declared types; the date stays text until it is used."""
    return spark.read.schema(WEATHER).csv(path, header=True)


def read_weather_json(spark: SparkSession, path: str) -> DataFrame:
    """Answers saved as ``<airport>.json``, one row per day, first of equal days kept.

    Each answer holds one array per measure; a measure it lacks is NULL. Days
    whose date cannot be read are dropped, and so are answers without dates.
    """
    def values(name: str) -> Column:
        return F.coalesce(F.col(f"daily.{name}"), F.array()).alias(name)

    days = (
        spark.read.schema(_ANSWER).json(path, multiLine=True)
        .select(
            F.col("_metadata.file_path").alias("archivo"),
            F.regexp_extract("_metadata.file_name", r"^(.*)\.json$", 1).alias("Origin"),
            F.posexplode(F.arrays_zip(values("time"), *map(values, ANSWER_FIELDS))),
        )
        .select(
            "archivo", "pos", "Origin",
            F.date_format(F.expr("try_cast(col.time AS DATE)"), "yyyy-MM-dd").alias("Fecha"),
            *[F.col(f"col.{name}").alias(column) for name, column in ANSWER_FIELDS.items()],
        )
        .where(F.col("Fecha").isNotNull())
    )
    return first_per_day(days, ["archivo", "pos"])


def first_per_day(weather: DataFrame, order: list[str]) -> DataFrame:
    """One row per (Origin, Fecha): the first in ``order``.

    An aggregate rather than a ranking window, so copies of one day collapse
    before the shuffle.
    """
    measures = [c for c in WEATHER.names if c not in ("Origin", "Fecha")]
    first = F.min_by(F.struct(*measures), F.struct(*order))
    return (
        weather.groupBy("Origin", "Fecha").agg(first.alias("m"))
        .select("Origin", "Fecha", *[F.col(f"m.{name}").alias(name) for name in measures])
    )
