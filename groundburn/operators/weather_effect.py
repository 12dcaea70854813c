"""Departure taxi time against the day's weather (population B).

Flights are summed per airport and day before the join, so the join works on
airports x days whatever the number of flights, no key is hot and no side has
to be broadcast. A day reported twice still counts its flights twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundburn.functions.numeric import mean, rnd, share
from groundburn.functions.weather import main_condition, overlapping_conditions
from groundburn.operators.measures import roll_up
from groundburn.params import Params


def _by_day(departures: DataFrame) -> DataFrame:
    daily = roll_up(departures, ["aeropuerto", "fecha"])
    return daily.withColumn("fecha", F.expr("try_cast(fecha AS DATE)"))


def _weather_days(weather: DataFrame) -> DataFrame:
    return weather.withColumnRenamed("Origin", "aeropuerto").withColumn(
        "fecha", F.expr("try_cast(Fecha AS DATE)"))


def _joined(departures: DataFrame, weather: DataFrame) -> DataFrame:
    return _by_day(departures).join(_weather_days(weather), ["aeropuerto", "fecha"])


def by_main_condition(
    departures: DataFrame, weather: DataFrame, p: Params, mean_name: str = "min_promedio_salida",
) -> DataFrame:
    """One condition per flight, by priority."""
    labelled = _joined(departures, weather).withColumn("condicion", main_condition(p))
    return roll_up(labelled, ["condicion"]).select(
        "condicion", "vuelos", rnd(mean(F.col("minutos"), F.col("vuelos")), 2).alias(mean_name),
    ).orderBy(F.desc_nulls_last(mean_name), "condicion")


def by_each_condition(
    departures: DataFrame, weather: DataFrame, p: Params, mean_name: str = "min_promedio_salida",
) -> DataFrame:
    """Every condition on its own; one nobody met is a row with 0 and NULL."""
    conditions = overlapping_conditions(p)
    sums = []
    for name, holds in conditions.items():
        sums += [F.sum(F.when(holds, F.col("vuelos"))).alias(f"n_{name}"),
                 F.sum(F.when(holds, F.col("minutos"))).alias(f"m_{name}")]
    rows = [
        F.struct(
            F.lit(name).alias("condicion"),
            F.coalesce(F.col(f"n_{name}"), F.lit(0)).alias("vuelos"),
            rnd(mean(F.col(f"m_{name}"), F.col(f"n_{name}")), 2).alias(mean_name),
        )
        for name in conditions
    ]
    return _joined(departures, weather).agg(*sums).select(F.inline(F.array(*rows)))


def weather_coverage(departures: DataFrame, weather: DataFrame) -> DataFrame:
    """Valid departures with and without a weather day."""
    days = _weather_days(weather).select("aeropuerto", "fecha", F.lit(True).alias("hay"))
    matched = _by_day(departures).join(days, ["aeropuerto", "fecha"], "left").agg(
        F.coalesce(F.sum("vuelos"), F.lit(0)).alias("salidas_validas"),
        F.sum(F.col("vuelos") * F.col("hay").isNotNull().cast("long")).alias("con_clima"),
        F.sum(F.col("vuelos") * F.col("hay").isNull().cast("long")).alias("sin_clima"),
    )
    return matched.withColumn("pct_con_clima", share(F.col("con_clima"), F.col("salidas_validas")))


def weather_quality(weather: DataFrame) -> DataFrame:
    """Rows, airports and (airport, date) pairs that occur more than once."""
    pairs = weather.groupBy("Origin", "Fecha").agg(F.count(F.lit(1)).alias("n"))
    per_airport = pairs.groupBy("Origin").agg(
        F.sum("n").alias("filas"),
        F.sum((F.col("n") > 1).cast("long")).alias("pares"),
        F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("repetidas"),
    )
    return per_airport.agg(
        F.coalesce(F.sum("filas"), F.lit(0)).alias("filas_clima"),
        F.count("Origin").alias("aeropuertos"),
        F.coalesce(F.sum("pares"), F.lit(0)).alias("pares_origin_fecha_duplicados"),
        F.coalesce(F.sum("repetidas"), F.lit(0)).alias("filas_en_duplicados"),
    )


def weather_multiplication(weather: DataFrame) -> DataFrame:
    """Days on which the weather join would multiply flights."""
    days = _weather_days(weather).groupBy("aeropuerto", "fecha").agg(F.count(F.lit(1)).alias("n"))
    return days.agg(
        F.sum((F.col("n") > 1).cast("long")).alias("dias_con_mas_de_una_fila"),
        F.max("n").alias("max_filas_por_dia"),
    )
