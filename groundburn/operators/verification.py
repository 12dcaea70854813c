"""Independent re-computation of published figures.

A figure is computed along two routes and both values are put side by side;
nothing is taken from the route under test.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from groundburn.functions.intermediate import materialise
from groundburn.functions.numeric import co2_tonnes, rnd
from groundburn.functions.validity import both_valid
from groundburn.operators.measures import segments
from groundburn.operators.serving import top_departure_airports
from groundburn.params import LOW, Params
from groundburn.sources.flights import one_month

#: Figures may differ by rounding of the published rows.
TOLERANCE = 0.6


# Figures known for all US flights of 2023-2025 at the default
# parameters, and the ten airports with most departure CO2 (low scenario, t).
KNOWN_FIGURES = {
    "filas": 20_928_579,
    "taxiout_nulo": 285_189,
    "taxiin_nulo": 292_087,
    "vuelos_validos": 20_636_222,
    "vuelos_en_resumen": 20_636_222,
    "horas_salida": 6_187_796,
    "horas_llegada": 2_869_540,
    "horas_total": 9_057_336,
    "co2_t_bajo": 10_303_625,
    "co2_t_alto": 20_607_251,
    "grupo_hora_24_cast": 59_378,
    "taxiout_media": 17.99,
    "taxiin_media": 8.35,
}
KNOWN_RANKING = (
    ("ORD", 392_002), ("DFW", 335_161), ("DEN", 321_352), ("ATL", 306_815), ("CLT", 239_863),
    ("LGA", 206_315), ("SEA", 198_740), ("LAX", 196_097), ("LAS", 192_275), ("JFK", 181_070),
)


class VerificationError(AssertionError):
    """A published figure does not match its re-computation."""


def _agrees(tolerance: float) -> Column:
    # Each side NULL is agreement; one side NULL is not.
    close = F.abs(F.col("obtenido") - F.col("esperado")) <= tolerance
    return F.coalesce(close, F.col("obtenido").isNull() & F.col("esperado").isNull())


def _long(one_row: DataFrame, value: str) -> DataFrame:
    columns = one_row.columns
    return one_row.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "medida", value)


def compare(expected: DataFrame, obtained: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Match two (medida, value) tables by measure; each holds a measure once."""
    both = expected.select("medida", "esperado").unionByName(
        obtained.select("medida", "obtenido"), allowMissingColumns=True)
    return both.groupBy("medida").agg(
        rnd(F.max("esperado"), 6).alias("esperado"), rnd(F.max("obtenido"), 6).alias("obtenido"),
    ).withColumn("cuadra", _agrees(tolerance))


def published_figures(tables: Mapping[str, DataFrame], cleaning: DataFrame) -> DataFrame:
    """Headline figures as a reader of the published tables would add them up."""
    yearly = _long(tables["resumen_global"].agg(
        F.sum("vuelos").alias("vuelos_en_resumen"),
        F.sum("horas_salida").alias("horas_salida"),
        F.sum("horas_llegada").alias("horas_llegada"),
        F.sum("horas").alias("horas_total"),
        rnd(F.sum("co2_t_bajo")).alias("co2_t_bajo"),
        rnd(F.sum("co2_t_alto")).alias("co2_t_alto"),
    ), "obtenido")
    stats = _long(cleaning.select(
        "filas", "taxiout_nulo", "taxiin_nulo", "vuelos_validos", "grupo_hora_24_cast",
        "taxiout_media", "taxiin_media",
    ), "obtenido")
    return yearly.unionByName(stats)


#: The figures from the flights alone. Conditions and factors are written out
#: here, so that a mistake in the shared definitions cannot agree with itself.
_FIGURES = """
SELECT filas, taxiout_nulo, taxiin_nulo, validos AS vuelos_validos, validos AS vuelos_en_resumen,
  salida / 60 AS horas_salida, llegada / 60 AS horas_llegada, (salida + llegada) / 60 AS horas_total,
  round((salida + llegada) * {low} * {factor} / 1000) AS co2_t_bajo,
  round((salida + llegada) * {high} * {factor} / 1000) AS co2_t_alto,
  hora24 AS grupo_hora_24_cast, round(media_salida * 100) / 100 AS taxiout_media, round(media_llegada * 100) / 100 AS taxiin_media
FROM (
  SELECT count(*) AS filas,
    sum(if(TaxiOut IS NULL, 1, 0)) AS taxiout_nulo, sum(if(TaxiIn IS NULL, 1, 0)) AS taxiin_nulo,
    sum(if(TaxiOut <= {cap} AND TaxiIn <= {cap}, 1, 0)) AS validos,
    sum(CASE WHEN TaxiOut <= {cap} AND TaxiIn <= {cap} THEN TaxiOut END) AS salida,
    sum(CASE WHEN TaxiOut <= {cap} AND TaxiIn <= {cap} THEN TaxiIn END) AS llegada,
    sum(CASE WHEN TaxiOut > {cap} OR TaxiOut IS NULL THEN 0 WHEN CRSDepTime BETWEEN 2350 AND 2399 THEN 1
             WHEN CRSDepTime IS NOT NULL THEN 0 END) AS hora24,
    avg(TaxiOut) AS media_salida, avg(TaxiIn) AS media_llegada
  FROM {flights}
)
"""

#: Those of them that must agree to the last digit: measure, and its name above or a rounding of it.
EXACT = ("filas", "taxiout_nulo", "taxiin_nulo", "vuelos_validos", "horas_total", "co2_t_bajo", "co2_t_alto", "grupo_hora_24_cast")


def _spelled_out(flights: DataFrame, p: Params) -> DataFrame:
    return flights.sparkSession.sql(
        _FIGURES, flights=flights, cap=float(p.taxi_cap), low=float(p.fuel_low), high=float(p.fuel_high), factor=float(p.co2_factor))


def recomputed_figures(flights: DataFrame, p: Params) -> DataFrame:
    """The same figures straight from the flights, in one scan, by a statement
    that shares no definition with the route under test."""
    return _long(_spelled_out(flights, p), "esperado")


def verify_exactly(flights: DataFrame, obtained: DataFrame, p: Params) -> DataFrame:
    """Eight global figures, one row of :func:`global_check`, against the statement: no tolerance."""
    some = F.col("filas") > 0  # rows without a valid one have no minutes; no rows have no figure
    sums = {c: F.when(some, F.coalesce(F.round(c), F.lit(0.0))) for c in ("horas_total", "co2_t_bajo", "co2_t_alto")}
    expected = _spelled_out(flights, p).withColumns(sums).select(*EXACT)
    return compare(_long(expected, "esperado"), _long(obtained.select(*EXACT), "obtenido"), tolerance=0.0)


def pinned(spark: SparkSession, figures: Mapping[str, float]) -> DataFrame:
    """Known-good numbers as an expected table."""
    return spark.createDataFrame([(k, float(v)) for k, v in figures.items()], "medida string, esperado double")


def ranking(flights: DataFrame, p: Params, top: int = 10) -> DataFrame:
    """Top departure airports straight from the flights: (aeropuerto, t).

    An airport with arrivals only is published too, with no departure CO2.
    """
    minutes = F.sum(F.when(F.col("lado") == "salida", F.col("minutos")).otherwise(0.0))
    return (
        segments(flights, p).groupBy("aeropuerto").agg(rnd(co2_tonnes(minutes, p.fuel_low, p)).alias("t"))
        .orderBy(F.desc("t"), F.asc_nulls_last("aeropuerto")).limit(top)
    )


def pinned_ranking(spark: SparkSession, places: Sequence[tuple[str, float]]) -> DataFrame:
    """A known ranking as an expected table."""
    return spark.createDataFrame([(a, float(t)) for a, t in places], "aeropuerto string, t double")


def verify_ranking(airport_month: DataFrame, expected: DataFrame, top: int = 10) -> DataFrame:
    """Top departure airports of the published table against an expected ranking, place by place.

    The order follows tonnes rounded to units, then the name.
    """
    place = Window.partitionBy(F.lit(0)).orderBy(rnd(F.col("t")).desc_nulls_last(), F.asc_nulls_last("aeropuerto"))

    def placed(ranked: DataFrame, suffix: str) -> DataFrame:
        return ranked.withColumn("puesto", F.row_number().over(place)).select(
            "puesto", F.col("aeropuerto").alias(f"aeropuerto_{suffix}"), F.col("t").alias(suffix))

    published = top_departure_airports(airport_month, LOW, top).withColumnRenamed("co2_salida_t", "t")
    return placed(expected, "esperado").join(placed(published, "obtenido"), "puesto", "full_outer").select(
        "puesto", "aeropuerto_esperado", "aeropuerto_obtenido", "esperado", "obtenido",
        (F.col("aeropuerto_esperado").eqNullSafe(F.col("aeropuerto_obtenido")) & _agrees(TOLERANCE)).alias("cuadra"),
    )


def verify_month(flights: DataFrame, year: int, month: int, p: Params) -> DataFrame:
    """One month's minutes (population A), aggregated and by SQL over the same rows."""
    rows = one_month(flights, year, month)
    by_api = rows.where(both_valid(p)).agg(F.sum(F.col("TaxiOut") + F.col("TaxiIn")).alias("m"))
    by_sql = flights.sparkSession.sql(
        "SELECT sum(TaxiOut) + sum(TaxiIn) AS m FROM {rows} WHERE TaxiOut <= {cap} AND TaxiIn <= {cap}",
        rows=rows, cap=p.taxi_cap,
    )
    name = F.lit(f"minutos_{year}_{month:02d}").alias("medida")
    return compare(
        by_api.select(name, F.col("m").alias("esperado")),
        by_sql.select(name, F.col("m").alias("obtenido")), tolerance=0.01,
    )


def verify_routes(departures: DataFrame, airport_month: DataFrame, flights: DataFrame, p: Params) -> DataFrame:
    """Departure CO2 with a decodable hour: through fine groups, coarse groups and directly.

    The published monthly table holds all departures, so it is compared with
    the direct sum of all of them, which spells its conditions out.
    """
    def tonnes(minutes: Column) -> Column:
        return rnd(co2_tonnes(minutes, p.fuel_low, p), 1)

    with_hour = departures.where(F.col("hora").isNotNull())

    def through(keys: list[str]) -> DataFrame:
        return with_hour.groupBy(*keys).agg(F.sum("minutos").alias("m")).agg(tonnes(F.sum("m")).alias("obtenido"))

    direct = flights.sparkSession.sql(
        """
        SELECT round(a.con_hora * 10) / 10 AS grupos_finos, round(a.con_hora * 10) / 10 AS grupos_gruesos, round(a.todas * 10) / 10 AS tabla_mensual
        FROM (
          SELECT sum(CASE WHEN CRSDepTime BETWEEN 0 AND 2359 OR CRSDepTime = 2400 THEN TaxiOut END) * {low} * {factor} / 1000 AS con_hora,
            sum(TaxiOut) * {low} * {factor} / 1000 AS todas
          FROM {flights} WHERE TaxiOut <= {cap}
        ) a
        """,
        flights=flights, cap=float(p.taxi_cap), low=float(p.fuel_low), factor=float(p.co2_factor))
    obtained = (
        through(["aeropuerto", "anio", "mes", "hora"]).select(F.lit("grupos_finos").alias("medida"), "obtenido")
        .unionByName(through(["anio", "mes"]).select(F.lit("grupos_gruesos").alias("medida"), "obtenido"))
        .unionByName(airport_month.agg(rnd(F.sum("co2_t_bajo_salida"), 1).alias("obtenido"))
                     .select(F.lit("tabla_mensual").alias("medida"), "obtenido"))
    )
    return compare(_long(direct, "esperado"), obtained, tolerance=1.0)


def require_all(checks: DataFrame) -> None:
    """Raise with the failing rows unless every check holds."""
    failed = checks.where(~F.col("cuadra")).collect()  # one row per figure
    if failed:
        raise VerificationError("; ".join(str(row.asDict()) for row in failed))


#: Departure CO2 by airport, its months rounded as they are published and added up,
#: with conditions and factors written out as above.
_PLACES = """
SELECT aeropuerto, round(sum(t) * 1000000) / 1000000 AS t
FROM (
  SELECT aeropuerto, round(sum(m) * {low} * {factor} / 1000 * 1000) / 1000 AS t
  FROM (SELECT Origin AS aeropuerto, Year, Month, TaxiOut AS m FROM {flights} WHERE TaxiOut <= {cap}
        UNION ALL SELECT Dest, Year, Month, 0 FROM {flights} WHERE TaxiIn <= {cap})
  GROUP BY aeropuerto, Year, Month
)
GROUP BY aeropuerto
"""


def recomputed_ranking(flights: DataFrame, p: Params, top: int = 10) -> DataFrame:
    """The ranking that adding up the published months gives, by a statement that
    shares no definition with them: (aeropuerto, t), t not rounded to units."""
    found = flights.sparkSession.sql(
        _PLACES, flights=flights, cap=float(p.taxi_cap), low=float(p.fuel_low), factor=float(p.co2_factor))
    return found.orderBy(rnd(F.col("t")).desc_nulls_last(), F.asc_nulls_last("aeropuerto")).limit(top)


def verify_accuracy(
    flights: DataFrame, tables: Mapping[str, DataFrame], cleaning: DataFrame, month: tuple[int, int], p: Params,
) -> DataFrame:
    """The whole check: figures, top departure airports place by place, and one month by two routes.

    Returns a row per figure and per airport of the ranking; raises
    :class:`VerificationError` at the first of the three that fails. Runs jobs.
    """
    figures = materialise(compare(recomputed_figures(flights, p), published_figures(tables, cleaning)))
    require_all(figures)
    places = materialise(verify_ranking(tables["co2_aeropuerto_mes"], recomputed_ranking(flights, p)))
    require_all(places)
    require_all(verify_month(flights, *month, p))
    name = F.concat_ws("_", F.lit("top_salida"), "aeropuerto_esperado").alias("medida")
    return figures.unionByName(places.select(name, "esperado", "obtenido", "cuadra"))
