"""Audit: taxi times, populations, scheduled hours, diversions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundburn.functions import quantiles as Q
from groundburn.functions.clock import hour, off_clock, rounded_hour, strict_hour, time_class
from groundburn.functions.intermediate import materialise
from groundburn.functions.numeric import co2_tonnes, hours, rnd, tally
from groundburn.functions.validity import arrival_valid, both_valid, departure_valid, flagged
from groundburn.params import Params


def taxi_state(flights: DataFrame, p: Params) -> DataFrame:
    """What most audit tables are made of, from one scan: counts per year and
    pair of taxi times. They add up, and validity follows from the pair."""
    t, sent, diverted = F.col("CRSDepTime"), F.col("Div1Airport"), flagged("Diverted")
    other = F.col("Dest") != sent
    return flights.groupBy("Year", "TaxiOut", "TaxiIn").agg(
        F.count(F.lit(1)).alias("filas"),
        tally(flagged("Cancelled")).alias("cancelados"),
        tally(diverted).alias("desviados"),
        F.count(hour(t)).alias("con_hora"),
        tally(hour(t) == 24).alias("hora24_actual"),
        tally(strict_hour(t) == 24).alias("hora24_estricta"),
        tally((rounded_hour(t) == 24) & (t < 2400)).alias("hora24_cast"),
        tally(t.between(0, 2359) & (t % 100 > 59)).alias("minuto_invalido"),
        tally(t == 2400).alias("valor_2400"),
        tally(t < 0).alias("negativos"),
        tally(t > 2400).alias("mayores_2400"),
        tally(diverted & sent.isNotNull()).alias("con_div1"),
        tally(diverted & F.col("Dest").isNotNull()).alias("con_dest"),
        tally(diverted & other & sent.isNotNull()).alias("otro_dest"),
        tally(diverted & ~other & sent.isNotNull()).alias("mismo_dest"),
    )


def taxi_histogram(state: DataFrame) -> DataFrame:
    """Rows per year, taxi column and minute, from :func:`taxi_state`."""
    return state.unpivot(["Year", "filas"], ["TaxiOut", "TaxiIn"], Q.VARIABLE, Q.VALUE).groupBy(
        "Year", Q.VARIABLE, Q.VALUE).agg(F.sum("filas").alias(Q.WEIGHT))


def taxi_time_quality(histogram: DataFrame, variable: str, p: Params) -> DataFrame:
    """Distribution of one taxi column per year, cap not applied.

    Takes :func:`taxi_histogram`.
    """
    value, rows = F.col(Q.VALUE), F.col(Q.WEIGHT)
    above = F.sum(F.when(value > p.taxi_cap, value * rows).otherwise(0.0))
    own = histogram.where(F.col(Q.VARIABLE) == variable).withColumnRenamed("Year", "anio")
    found = Q.summarised(own, ["anio"], [
        F.sum(rows).alias("filas"),
        tally(value.isNull(), rows).alias("nulos"),
        tally(value.isNotNull() & (value < 0), rows).alias("negativos"),
        tally(value == 0, rows).alias("cero"),
        tally((value > 0) & (value < p.taxi_cap), rows).alias("entre_0_y_tope"),
        tally(value == p.taxi_cap, rows).alias("igual_tope"),
        tally(value > p.taxi_cap, rows).alias("sobre_tope"),
        rnd(F.min(value), 2).alias("minimo"),
        rnd(F.max(value), 2).alias("maximo"),
        rnd(Q.average(), 4).alias("media"),
        rnd(above, 1).alias("minutos_sobre_tope"),
        rnd(co2_tonnes(above, p.fuel_low, p), 1).alias("co2_t_bajo_si_se_incluyeran_sobre_tope"),
    ], {"mediana": 0.5, "p90": 0.9, "p99": 0.99})
    return found.select(
        "anio", "filas", "nulos", "negativos", "cero", "entre_0_y_tope", "igual_tope", "sobre_tope", "minimo", "maximo",
        "media", "mediana", "p90", "p99", "minutos_sobre_tope", "co2_t_bajo_si_se_incluyeran_sobre_tope",
    ).orderBy(F.asc_nulls_last("anio"))


def populations_by_year(state: DataFrame, p: Params) -> DataFrame:
    """How the rows of each year split over the populations, from :func:`taxi_state`."""
    b, c, a = departure_valid(p), arrival_valid(p), both_valid(p)
    rows, cancelled, diverted = F.col("filas"), F.col("cancelados"), F.col("desviados")

    def minutes(out, arr):
        return rnd(F.sum((F.coalesce(out, F.lit(0.0)) + F.coalesce(arr, F.lit(0.0))) * rows), 1)

    out, arr = F.col("TaxiOut"), F.col("TaxiIn")
    return state.groupBy(F.col("Year").alias("anio")).agg(
        tally(a, rows).alias("ambos_validos"),
        tally(b & ~c, rows).alias("solo_salida_valida"),
        tally(c & ~b, rows).alias("solo_llegada_valida"),
        tally(~b & ~c, rows).alias("ninguno_valido"),
        F.sum(cancelled).alias("cancelados"),
        F.sum(diverted).alias("desviados"),
        tally(a, cancelled).alias("cancelados_en_ambos"),
        tally(a, diverted).alias("desviados_en_ambos"),
        minutes(out, arr).alias("min_sin_tope_ambos_disponibles_por_separado"),
        minutes(F.when(b, out), F.when(c, arr)).alias("min_con_tope_por_separado"),
    ).orderBy(F.asc_nulls_last("anio"))


def reconciliation(state: DataFrame, p: Params) -> DataFrame:
    """Populations A, B, C and D side by side, from :func:`taxi_state`."""
    a, b, c = both_valid(p), departure_valid(p), arrival_valid(p)
    out, arr, rows, timed = F.col("TaxiOut"), F.col("TaxiIn"), F.col("filas"), F.col("con_hora")

    def flights(population, weight):
        return F.coalesce(F.sum(F.when(population, weight)), F.lit(0))

    def minutes(population, value, weight):
        return F.sum(F.when(population & (weight > 0), value * weight))

    totals = state.agg(
        flights(a, rows).alias("a"), flights(b, rows).alias("b"), flights(c, rows).alias("c"), flights(b, timed).alias("d"),
        minutes(a, out + arr, rows).alias("min_a"), minutes(b, out, rows).alias("min_b"),
        minutes(c, arr, rows).alias("min_c"), minutes(b, out, timed).alias("min_d"),
    )

    def co2(minutes: str):
        return rnd(co2_tonnes(F.col(minutes), p.fuel_low, p), 3)

    return totals.select(
        F.col("a").alias("vuelos_ambos_validos"),
        rnd(hours(F.col("min_a")), 2).alias("horas_global"),
        co2("min_a").alias("co2_t_bajo_global"),
        F.col("b").alias("obs_salida_valida"),
        co2("min_b").alias("co2_t_bajo_solo_salida"),
        F.col("c").alias("obs_llegada_valida"),
        co2("min_c").alias("co2_t_bajo_solo_llegada"),
        (F.col("b") + F.col("c")).alias("tramos_salida_mas_llegada"),
        F.col("d").alias("obs_salida_con_hora_codigo_actual"),
        co2("min_d").alias("co2_t_bajo_salida_hora"),
    )


def time_counts(flights: DataFrame) -> DataFrame:
    """Flights per scheduled-time value."""
    return flights.groupBy("CRSDepTime").agg(F.count(F.lit(1)).alias("n"))


_DIVERSION = ["Dest", "Div1Airport", "DivReachedDest"]


def diversion_counts(flights: DataFrame, p: Params) -> DataFrame:
    """Diverted flights and their valid taxi-in by airports and outcome."""
    c = arrival_valid(p)
    return flights.where(flagged("Diverted")).groupBy(*_DIVERSION).agg(
        F.count(F.lit(1)).alias("vuelos"), tally(c).alias("con_taxiin"), F.sum(F.when(c, F.col("TaxiIn"))).alias("minutos"))


def time_and_diversion_counts(flights: DataFrame, p: Params) -> tuple[DataFrame, DataFrame]:
    """:func:`time_counts` and :func:`diversion_counts` from one scan, stored."""
    c, diverted = arrival_valid(p), flagged("Diverted")
    rows = flights.select(
        "CRSDepTime", diverted.alias("desviado"), *[F.when(diverted, F.col(k)).alias(k) for k in _DIVERSION],
        c.cast("long").alias("valido"), F.when(c, F.col("TaxiIn")).alias("TaxiIn"))
    both = materialise(flights.sparkSession.sql(
        """
        SELECT grouping(CRSDepTime) = 0 AS por_hora, CRSDepTime, desviado, Dest, Div1Airport, DivReachedDest,
          count(*) AS n, sum(valido) AS con_taxiin, sum(TaxiIn) AS minutos
        FROM {rows} GROUP BY GROUPING SETS ((CRSDepTime), (desviado, Dest, Div1Airport, DivReachedDest))
        """, rows=rows))
    return (both.where("por_hora").select("CRSDepTime", "n"),
            both.where("NOT por_hora AND desviado").select(*_DIVERSION, F.col("n").alias("vuelos"), "con_taxiin", "minutos"))


def scheduled_time_classes(times: DataFrame) -> DataFrame:
    """Flights per kind of scheduled-time value, from :func:`time_counts`."""
    return (
        times.groupBy(time_class(F.col("CRSDepTime")).alias("clase"))
        .agg(F.sum("n").alias("vuelos")).orderBy(F.desc("vuelos"), "clase")
    )


def hour_24_groups(state: DataFrame, p: Params) -> DataFrame:
    """Population B: who lands in a false hour 24 under each decoding, from :func:`taxi_state`."""
    return state.where(departure_valid(p)).agg(
        F.sum("hora24_actual").alias("grupo24_codigo_actual"),
        F.sum("hora24_estricta").alias("grupo24_hhmm_estricto"),
        F.sum("hora24_cast").alias("grupo24_cast"),
        F.sum("minuto_invalido").alias("minuto_invalido_total"),
        F.sum("valor_2400").alias("valor_2400"),
        F.sum("negativos").alias("negativos"),
        F.sum("mayores_2400").alias("mayores_2400"),
    )


def invalid_times(times: DataFrame, top: int = 30) -> DataFrame:
    """The most frequent scheduled-time values that are off the clock, from :func:`time_counts`."""
    return times.where(off_clock(F.col("CRSDepTime"))).orderBy(F.desc("n"), "CRSDepTime").limit(top)


def diversion_summary(state: DataFrame, p: Params) -> DataFrame:
    """Diverted flights: where they were sent and what taxi-in they report, from :func:`taxi_state`."""
    diverted, arrived = F.col("desviados"), arrival_valid(p)
    minutes = F.sum(F.when(arrived, F.col("TaxiIn") * diverted).otherwise(0.0))
    return state.agg(
        F.sum(diverted).alias("desviados"),
        F.sum("con_div1").alias("con_div1"),
        F.sum(diverted - F.col("con_div1")).alias("sin_div1"),
        F.sum("con_dest").alias("con_dest"),
        F.sum("otro_dest").alias("dest_distinto_div1"),
        F.sum("mismo_dest").alias("dest_igual_div1"),
        tally(arrived, diverted).alias("desviados_taxiin_valido"),
        tally(both_valid(p), diverted).alias("desviados_ambos_validos"),
        rnd(minutes, 1).alias("minutos_taxiin_desviado_valido"),
        rnd(co2_tonnes(minutes, p.fuel_low, p), 3).alias("co2_t_bajo_taxiin_desviado"),
    )


def diversion_pairs(counts: DataFrame, p: Params, top: int = 20) -> DataFrame:
    """Taxi-in of diverted flights by planned and first diversion airport, from :func:`diversion_counts`."""
    pairs = (
        counts.where((F.col("con_taxiin") > 0) & (F.col("Dest") != F.col("Div1Airport")))
        .groupBy(F.col("Dest").alias("aeropuerto_dest"), F.col("Div1Airport").alias("aeropuerto_div1"))
        .agg(F.sum("con_taxiin").alias("vuelos"), F.sum("minutos").alias("minutos"))
    )
    return pairs.select(
        "aeropuerto_dest", "aeropuerto_div1", "vuelos",
        rnd(F.col("minutos"), 1).alias("min_taxiin"),
        rnd(co2_tonnes(F.col("minutos"), p.fuel_low, p), 3).alias("co2_t_bajo"),
    ).orderBy(F.desc("co2_t_bajo"), "aeropuerto_dest", "aeropuerto_div1").limit(top)


def diversion_outcome(counts: DataFrame, p: Params) -> DataFrame:
    """Diverted flights by whether they reached their destination, from :func:`diversion_counts`.

    Taxi-in is reported when the destination was reached, which is why it is
    attributed to the destination.
    """
    minutes = F.coalesce(F.sum("minutos"), F.lit(0.0))
    return counts.groupBy(F.col("DivReachedDest").alias("alcanza_destino")).agg(
        F.sum("vuelos").alias("vuelos"),
        F.sum("con_taxiin").alias("con_taxiin_valido"),
        rnd(co2_tonnes(minutes, p.fuel_low, p), 3).alias("co2_t_bajo"),
    ).orderBy(F.desc_nulls_last("alcanza_destino"))
