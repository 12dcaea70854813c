"""Every query by name, bound to the star-schema test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from groundburn.functions.intermediate import materialise, materialise_all
from groundburn.operators import contracts as K
from groundburn.operators import coverage as C
from groundburn.operators import delays as D
from groundburn.operators import emissions as E
from groundburn.operators import exploration as X
from groundburn.operators import savings as S
from groundburn.operators import serving as G
from groundburn.operators import taxi_quality as T
from groundburn.operators import verification as V
from groundburn.operators import weather_effect as W
from groundburn.operators.measures import DEPARTURE_MEASURES, departures, roll_ups, segments
from groundburn.params import HIGH
from groundburn.plans.publish import emission_tables
from groundburn.schema import FLIGHT_KEY
from groundburn.sources.star import STAR_PARAMS as P
from groundburn.sources.star import star_flights, star_weather, star_weather_reports
from groundburn.sources.weather import first_per_day

Query = Callable[[SparkSession, str], DataFrame]

#: Shorter identity under which the test tables do hold duplicates.
ROUTE_DAY = ("FlightDate", "Origin", "Dest")
#: Airports of the fixed-list panel on the test tables.
PANEL_AIRPORTS = tuple(f"NATION_{n}" for n in range(10))
#: Month re-computed on its own.
CHECK_MONTH = (1997, 3)


def _over_flights(fn, *args) -> Query:
    return lambda spark, sf: fn(star_flights(spark, sf), *args)


def _stored(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Columns of the flights that several steps read: joined once and stored. Runs a job."""
    return materialise(star_flights(spark, sf).select(*columns))


def _over_keys(fn, key) -> Query:
    return lambda spark, sf: fn(_stored(spark, sf, *key), key)


def _over_departures(fn, *args) -> Query:
    return lambda spark, sf: fn(departures(star_flights(spark, sf), P), *args)


def _over_weather(fn, *args) -> Query:
    return lambda spark, sf: fn(departures(star_flights(spark, sf), P), star_weather(spark, sf), *args)


def _over_airport_month(fn, *args) -> Query:
    return lambda spark, sf: fn(airport_month(spark, sf), *args)


def _over_airport_hour(fn, *args) -> Query:
    return lambda spark, sf: fn(airport_hour(spark, sf), *args)


def airport_month(spark: SparkSession, sf: str) -> DataFrame:
    return E.airport_month(segments(star_flights(spark, sf), P), P)


def _duplicate_examples(flights: DataFrame, key) -> DataFrame:
    return C.duplicate_examples(C.repeated_keys(flights, key), key)


def _taxi_quality(flights: DataFrame, variable: str) -> DataFrame:
    return T.taxi_time_quality(T.taxi_histogram(T.taxi_state(flights, P)), variable, P)


def _over_state(fn) -> Query:
    return lambda spark, sf: fn(T.taxi_state(star_flights(spark, sf), P), P)


def _over_times(fn) -> Query:
    return lambda spark, sf: fn(T.time_counts(star_flights(spark, sf)))


def _over_diversions(fn) -> Query:
    return lambda spark, sf: fn(T.diversion_counts(star_flights(spark, sf), P), P)


coverage = _over_flights(C.month_coverage)
airport_hour = _over_departures(E.airport_hour, P)
yearly = _over_departures(E.yearly_summary, P)
main_weather = _over_weather(W.by_main_condition, P)
each_weather = _over_weather(W.by_each_condition, P)
savings = _over_departures(S.savings, P)
benchmark = _over_departures(E.departure_groups)

#: The published tables.
PUBLISHED: dict[str, Query] = {
    "resumen_global": yearly,
    "co2_aeropuerto_mes": airport_month,
    "co2_aeropuerto_hora": airport_hour,
    "rodaje_clima": main_weather,
    "rodaje_clima_independiente": each_weather,
    "escenario_ahorro": savings,
    "benchmark_salida": benchmark,
}


def published(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """All published tables as the batch computes and stores them, from shared roll-ups."""
    tables = emission_tables(star_flights(spark, sf), star_weather(spark, sf), P)
    return materialise_all({name: K.to_contract(name, table) for name, table in tables.items()})


def _exchanged(spark: SparkSession, sf: str) -> DataFrame:
    """Tables in each other's place, so that the check meets every kind of fault.

    They are built from roll-ups by hour of a month and by day, both of one scan.
    """
    by_hour, by_day = roll_ups(
        departures(star_flights(spark, sf), P), (("aeropuerto", "anio", "mes", "hora"), ("aeropuerto", "fecha")), DEPARTURE_MEASURES)
    return K.contract_check(spark, {
        "resumen_global": E.yearly_summary(by_hour, P),
        "co2_aeropuerto_hora": E.departure_groups(by_hour),
        "rodaje_clima": X.by_hour(by_hour, P),
        "rodaje_clima_independiente": W.by_each_condition(by_day, star_weather(spark, sf), P, "min_promedio"),
        "escenario_ahorro": S.savings_population_a(by_hour, P),
        "benchmark_salida": G.co2_by_hour_kilotonnes(E.airport_hour(by_hour, P)),
    })


def _exactly(spark: SparkSession, sf: str) -> DataFrame:
    flights = star_flights(spark, sf)
    return V.verify_exactly(flights, X.global_check(flights, P), P)


def _chosen(spark: SparkSession, sf: str) -> DataFrame:
    return G.selection(airport_month(spark, sf), P.years)


def _accuracy(spark: SparkSession, sf: str) -> DataFrame:
    flights = _stored(
        spark, sf, "Origin", "Dest", "Year", "Month", "CRSDepTime", "TaxiOut", "TaxiIn", "Cancelled", "Diverted")
    tables = {
        "resumen_global": E.yearly_summary(departures(flights, P), P),
        "co2_aeropuerto_mes": E.airport_month(segments(flights, P), P),
    }
    return V.verify_accuracy(flights, tables, X.cleaning_statistics(flights, P), CHECK_MONTH, P)


def _routes(spark: SparkSession, sf: str) -> DataFrame:
    flights = _stored(spark, sf, "Origin", "Dest", "Year", "Month", "CRSDepTime", "TaxiOut", "TaxiIn")
    return V.verify_routes(departures(flights, P), E.airport_month(segments(flights, P), P), flights, P)


def _label(spark: SparkSession, sf: str) -> DataFrame:
    flights = _stored(spark, sf, *FLIGHT_KEY, "DayOfWeek", "Month", "TaxiOut")
    return X.excessive_label(flights, departures(flights, P), P)


QUERIES: dict[str, Query] = {
    **PUBLISHED,
    "benchmark_total": _over_departures(E.departure_groups_total, P),
    "co2_por_vuelo": _over_flights(E.flight_co2, P),
    "escenario_ahorro_universo_a": _over_departures(S.savings_population_a, P),
    "limpieza": _over_flights(X.cleaning_statistics, P),
    # Audit
    "cobertura_anio_mes": coverage,
    "cobertura_resumen": lambda spark, sf: C.coverage_summary(coverage(spark, sf), P),
    "cobertura_diferencias": _over_flights(C.calendar_differences, P),
    "meta_ejecucion": lambda spark, sf: C.run_summary(coverage(spark, sf), P),
    "esquema": _over_flights(C.schema_profile),
    "nulos_campos_criticos": _over_flights(C.null_profile),
    "duplicados_resumen": _over_keys(C.duplicates, FLIGHT_KEY),
    "duplicados_ejemplos": _over_keys(_duplicate_examples, FLIGHT_KEY),
    "duplicados_resumen_ruta_dia": _over_keys(C.duplicates, ROUTE_DAY),
    "duplicados_ejemplos_ruta_dia": _over_keys(_duplicate_examples, ROUTE_DAY),
    "calidad_taxiout_por_anio": _over_flights(_taxi_quality, "TaxiOut"),
    "calidad_taxiin_por_anio": _over_flights(_taxi_quality, "TaxiIn"),
    "universos_por_anio": _over_state(T.populations_by_year),
    "crsdeptime_clases": _over_times(T.scheduled_time_classes),
    "crsdeptime_grupos24": _over_state(T.hour_24_groups),
    "crsdeptime_invalidos": _over_times(T.invalid_times),
    "desviados_resumen": _over_state(T.diversion_summary),
    "desviados_pares": _over_diversions(T.diversion_pairs),
    "desviados_alcanza_destino": _over_diversions(T.diversion_outcome),
    "clima_calidad": lambda spark, sf: W.weather_quality(star_weather(spark, sf)),
    "clima_calidad_informes": lambda spark, sf: W.weather_quality(star_weather_reports(spark, sf)),
    "clima_cobertura": _over_weather(W.weather_coverage),
    "clima_multiplicacion": lambda spark, sf: W.weather_multiplication(star_weather(spark, sf)),
    "clima_multiplicacion_informes":
        lambda spark, sf: W.weather_multiplication(star_weather_reports(spark, sf)),
    "clima_sin_duplicados":
        lambda spark, sf: first_per_day(star_weather_reports(spark, sf), ["informe"]),
    "conciliacion_universos": _over_state(T.reconciliation),
    # Exploration of taxi times
    "verificacion_global": _over_flights(X.global_check, P),
    "hora_mal": _over_flights(X.wrong_hour_summary, P),
    "hora_ejemplos": _over_flights(X.wrong_hour_examples),
    "calidad_global": _over_flights(X.global_quality, P),
    "tendencia": _over_flights(X.tendency),
    "histograma_salida": _over_flights(X.departure_histogram),
    "top_salida": _over_departures(X.top_airports, P),
    "aeropuertos_lentos": _over_departures(X.slow_airports, P),
    "por_hora": _over_departures(X.by_hour, P),
    "hora_pico": _over_departures(X.peak_hours, P),
    "por_dia": _over_departures(X.by_weekday),
    "por_mes": _over_departures(X.by_calendar_month),
    "por_aerolinea": _over_departures(X.by_airline, P),
    "rodaje_excesivo": _over_departures(X.excessive_taxi, P),
    "etiqueta_excesivo": _label,
    "clima_prioridad": _over_weather(W.by_main_condition, P, "min_promedio"),
    "clima_independiente": _over_weather(W.by_each_condition, P, "min_promedio"),
    "resumen_anual": _over_departures(E.yearly_summary_units, P),
    # Exploration of delays
    "objetivo_atraso": _over_flights(D.late_distribution),
    "estadisticas_atraso": _over_flights(D.delay_statistics),
    "nulos_atraso": _over_flights(C.null_share),
    "atraso_por_dia": _over_flights(D.late_by_weekday),
    "atraso_por_hora": _over_flights(D.late_by_hour),
    "atraso_por_aerolinea": _over_flights(D.late_by_airline),
    "rutas_atrasadas": _over_flights(D.late_routes, P),
    "total_vuelos": _over_flights(D.flight_count),
    "atraso_aerolinea_mes": _over_flights(D.late_by_airline_month),
    # Panels
    "kpi_tramos": _over_airport_month(G.segment_kpi),
    "kpi_co2": lambda spark, sf: G.co2_kpi(yearly(spark, sf)),
    "kpi_co2_alto": lambda spark, sf: G.co2_kpi(yearly(spark, sf), HIGH),
    "co2_por_anio": lambda spark, sf: G.co2_by_year(yearly(spark, sf)),
    "co2_por_anio_alto": lambda spark, sf: G.co2_by_year(yearly(spark, sf), HIGH),
    "top10_salida": _over_airport_month(G.top_departure_airports),
    "top10_salida_alto": _over_airport_month(G.top_departure_airports, HIGH),
    "co2_por_hora": _over_airport_hour(G.co2_by_hour_kilotonnes),
    "co2_por_hora_toneladas": _over_airport_hour(G.co2_by_hour_tonnes),
    "mapa_hora_aeropuerto": _over_airport_hour(G.hour_map, PANEL_AIRPORTS),
    "mapa_hora_top10":
        lambda spark, sf: G.hour_map_of_top(airport_hour(spark, sf), airport_month(spark, sf)),
    "panel_lentos": _over_airport_month(G.slow_airport_panel, P),
    "panel_ahorro": lambda spark, sf: G.savings_panel(savings(spark, sf)),
    "panel_clima": lambda spark, sf: G.weather_panel(each_weather(spark, sf)),
    # Dashboard
    "tablero_kpi": _over_airport_month(G.dashboard_kpi, P, P.years),
    "tablero_kpi_salida_alto": _over_airport_month(G.dashboard_kpi, P, (1996, 1997), ("salida",), HIGH),
    "tablero_top15": lambda spark, sf: G.dashboard_top(_chosen(spark, sf)),
    "tablero_mensual": lambda spark, sf: G.dashboard_monthly(_chosen(spark, sf)),
    "tablero_hora": _over_airport_hour(G.dashboard_hourly),
    "mapa_calor": _over_airport_hour(G.heat_map),
    # Published-table checks and verification
    "contract_check": lambda spark, sf: K.contract_check(spark, published(spark, sf)),
    "contract_check_cambiadas": _exchanged,
    "conteo_publicado": lambda spark, sf: K.row_counts(published(spark, sf)),
    "verificacion_exacta": _exactly,
    "verificacion_exactitud": _accuracy,
    "verificacion_top10":
        lambda spark, sf: V.verify_ranking(airport_month(spark, sf), V.ranking(star_flights(spark, sf), P)),
    "verificacion_mes": _over_flights(V.verify_month, *CHECK_MONTH, P),
    "verificacion_cruzada": _routes,
}
