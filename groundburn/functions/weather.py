"""Daily weather conditions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from groundburn.params import Params


def main_condition(p: Params) -> Column:
    """One label per day. A missing measure falls through to the next rule."""
    rain, snow, wind = F.col("precipitacion_mm"), F.col("nieve_cm"), F.col("viento_max_kmh")
    # Labels in order of priority.
    return (
        F.when(snow > 0, "nieve")
        .when(rain > p.heavy_rain_mm, "lluvia_fuerte")
        .when(wind >= p.strong_wind_kmh, "viento_fuerte")
        .when(rain > 0, "lluvia_leve")
        .otherwise("normal")
    )


def overlapping_conditions(p: Params) -> dict[str, Column]:
    """Six conditions that are looked at one by one; a day may meet several."""
    rain, snow, wind = F.col("precipitacion_mm"), F.col("nieve_cm"), F.col("viento_max_kmh")
    # Labels.
    return {
        "lluvia_fuerte": rain > p.heavy_rain_mm,
        "sin_lluvia": (rain == 0) & (snow == 0),
        "nieve": snow > 0,
        "sin_nieve": snow == 0,
        "viento_fuerte": wind >= p.strong_wind_kmh,
        "viento_normal": wind < p.strong_wind_kmh,
    }
