"""The data-quality audit: every audit table over one flight table and its weather."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundburn.functions.intermediate import materialise, materialise_all
from groundburn.operators import coverage, taxi_quality, weather_effect
from groundburn.operators.measures import departures
from groundburn.params import Params
from groundburn.sinks.tables import replace_tables


def audit_tables(flights: DataFrame, weather: DataFrame | None, p: Params) -> dict[str, DataFrame]:
    """All audit tables. Without weather its tables are left out.

    What feeds several tables is computed once, into the checkpoint folder: the
    flights are read at most eight times, whatever the number of tables.
    """
    dates = materialise(coverage.date_counts(flights))
    measured = dates.agg(F.sum("n").alias("n"), F.sum("claves").alias("claves")).first()
    unique = coverage.few_repeats(measured["n"] or 0, measured["claves"] or 0)
    shared = materialise_all({
        "months": coverage.month_coverage_from(dates),
        "repeated": coverage.repeated_keys(flights, unique=unique),
        "state": taxi_quality.taxi_state(flights, p),
        "profile": coverage.schema_profile(flights),
    })
    months, repeated, state, profile = shared.values()
    minutes = taxi_quality.taxi_histogram(state)
    times, diversions = taxi_quality.time_and_diversion_counts(flights, p)
    tables = {
        "cobertura_anio_mes": months,
        "cobertura_resumen": coverage.coverage_summary(months, p),
        "esquema": profile,
        "nulos_campos_criticos": coverage.critical_nulls(profile),
        "duplicados_resumen": coverage.duplicate_summary(dates, repeated),
        "duplicados_ejemplos": coverage.duplicate_examples(repeated),
        "calidad_taxiout_por_anio": taxi_quality.taxi_time_quality(minutes, "TaxiOut", p),
        "calidad_taxiin_por_anio": taxi_quality.taxi_time_quality(minutes, "TaxiIn", p),
        "universos_por_anio": taxi_quality.populations_by_year(state, p),
        "crsdeptime_clases": taxi_quality.scheduled_time_classes(times),
        "crsdeptime_grupos24": taxi_quality.hour_24_groups(state, p),
        "crsdeptime_invalidos": taxi_quality.invalid_times(times),
        "desviados_resumen": taxi_quality.diversion_summary(state, p),
        "desviados_pares": taxi_quality.diversion_pairs(diversions, p),
        "desviados_alcanza_destino": taxi_quality.diversion_outcome(diversions, p),
        "conciliacion_universos": taxi_quality.reconciliation(state, p),
        "meta_ejecucion": coverage.run_summary(months, p),
    }
    if weather is not None:
        tables |= {
            "clima_calidad": weather_effect.weather_quality(weather),
            "clima_cobertura": weather_effect.weather_coverage(departures(flights, p), weather),
            "clima_multiplicacion": weather_effect.weather_multiplication(weather),
        }
    return tables


def audit(flights: DataFrame, weather: DataFrame | None, p: Params, folder: str, file_format: str = "parquet") -> list[str]:
    """Compute and write the audit."""
    return replace_tables(audit_tables(flights, weather, p), folder, file_format)
