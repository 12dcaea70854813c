"""Relations that hold on any data, and figures measured on the test tables."""

from __future__ import annotations

from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from groundburn import registry
from groundburn.functions import numeric, validity
from groundburn.operators import exploration, verification
from groundburn.operators.emissions import airport_hour, airport_month, departure_groups, departure_groups_total, yearly_summary
from groundburn.operators.exploration import by_hour, cleaning_statistics, global_check
from groundburn.operators.measures import departures, segments
from groundburn.operators.taxi_quality import hour_24_groups, populations_by_year, reconciliation, taxi_state
from groundburn.operators.weather_effect import by_main_condition, weather_coverage
from groundburn.sources.star import STAR_PARAMS as P
from groundburn.sources.star import star_flights, star_weather
from tests.edge_rows import FLIGHT_DDL, FLIGHTS, WEATHER_DDL, WEATHER_ROWS


@pytest.fixture(scope="module", params=["edge", "tables"])
def data(request, spark):
    if request.param == "edge":
        pair = spark.createDataFrame(FLIGHTS, FLIGHT_DDL), spark.createDataFrame(WEATHER_ROWS, WEATHER_DDL)
    else:
        sf = request.getfixturevalue("sf")
        pair = star_flights(spark, sf), star_weather(spark, sf)
    kept = tuple(df.persist() for df in pair)
    yield kept
    for df in kept:
        df.unpersist()


def test_validity_classes_partition_the_rows(data):
    flights, _ = data
    row = populations_by_year(taxi_state(flights, P), P).agg(
        F.sum(F.col("ambos_validos") + F.col("solo_salida_valida") + F.col("solo_llegada_valida")
              + F.col("ninguno_valido")).alias("all"), F.sum("ambos_validos").alias("a")).first()
    pops = reconciliation(taxi_state(flights, P), P).first()
    assert row["all"] == flights.count()
    assert row.a == pops.vuelos_ambos_validos <= min(pops.obs_salida_valida, pops.obs_llegada_valida)
    assert pops.tramos_salida_mas_llegada == segments(flights, P).count()


def test_high_scenario_is_twice_the_low_one(data):
    flights, _ = data
    for row in yearly_summary(departures(flights, P), P).collect():
        assert row.co2_t_alto == pytest.approx(2 * row.co2_t_bajo, abs=0.002)
    for row in airport_month(segments(flights, P), P).collect():
        assert row.co2_t_alto_salida == pytest.approx(2 * row.co2_t_bajo_salida, abs=0.002)
        assert row.co2_t_alto == pytest.approx(2 * row.co2_t_bajo, abs=0.002)


def test_hour_tables_add_up(data):
    flights, _ = data
    d = departures(flights, P)
    minutes = [df.agg(F.sum(c)).first()[0] for df, c in (
        (airport_hour(d, P), "min_rodaje_salida"), (departure_groups(d), "min_rodaje_salida"),
        (d.where(F.col("hora").isNotNull()), "minutos"))]
    assert len(set(minutes)) == 1


def test_hour_24_exists_only_under_the_wrong_decoding(data):
    flights, _ = data
    assert by_hour(departures(flights, P), P).where((F.col("hora") < 0) | (F.col("hora") > 23)).count() == 0
    row = hour_24_groups(taxi_state(flights, P), P).first()
    assert (row.grupo24_codigo_actual, row.grupo24_hhmm_estricto) == (0, 0) and row.grupo24_cast > 0


def test_weather_labels_cover_exactly_the_flights_with_weather(data):
    flights, weather = data
    d = departures(flights, P)
    assert by_main_condition(d, weather, P).agg(F.sum("vuelos")).first()[0] == weather_coverage(d, weather).first().con_clima


def test_partitioning_does_not_change_the_total(data):
    flights, _ = data
    totals = {tuple(departure_groups_total(departures(flights.repartition(n), P), P).first()) for n in (1, 3, 11)}
    assert len(totals) == 1


def test_verification_passes_and_fails(data, spark):
    flights, _ = data
    d = departures(flights, P)
    obtained = verification.published_figures({"resumen_global": yearly_summary(d, P)}, cleaning_statistics(flights, P))
    checks = verification.compare(verification.recomputed_figures(flights, P), obtained)
    assert checks.count() == 13
    verification.require_all(checks)
    right = {r.medida: r.obtenido for r in checks.collect()}
    verification.require_all(verification.compare(verification.pinned(spark, right), obtained))
    wrong = {**right, "filas": right["filas"] + 1}
    with pytest.raises(verification.VerificationError, match="filas"):
        verification.require_all(verification.compare(verification.pinned(spark, wrong), obtained))
    with pytest.raises(verification.VerificationError, match="no_such"):
        verification.require_all(verification.compare(verification.pinned(spark, {**right, "no_such": 1.0}), obtained))


def _months(spark, places):
    """A published table whose departure CO2 adds up to the given tonnes."""
    return spark.createDataFrame([(a, t * share) for a, t in places for share in (0.25, 0.75)] + [("ZZZ", 5.0)],
                                 "aeropuerto string, co2_t_bajo_salida double")


def test_known_ranking(spark):
    expected = verification.pinned_ranking(spark, verification.KNOWN_RANKING)
    checks = verification.verify_ranking(_months(spark, verification.KNOWN_RANKING), expected)
    assert checks.count() == 10
    verification.require_all(checks)
    swapped = [("DFW", 392_002), ("ORD", 335_161), *verification.KNOWN_RANKING[2:]]
    with pytest.raises(verification.VerificationError, match="ORD"):
        verification.require_all(verification.verify_ranking(_months(spark, swapped), expected))
    with pytest.raises(verification.VerificationError, match="JFK"):
        verification.require_all(verification.verify_ranking(
            _months(spark, verification.KNOWN_RANKING[:-1]), expected))


def test_accuracy_includes_the_ranking_and_a_month(data, monkeypatch):
    """Ten airports beside the thirteen figures; a wrong ranking or month stops the check."""
    flights, _ = data
    tables = {"resumen_global": yearly_summary(departures(flights, P), P), "co2_aeropuerto_mes": airport_month(segments(flights, P), P)}

    def run(**changed):
        return verification.verify_accuracy(flights, tables | changed, cleaning_statistics(flights, P), (1996, 5), P)

    rows = run().collect()
    minutes = flights.where(F.col("TaxiOut") <= P.taxi_cap).groupBy("Origin").agg(F.sum("TaxiOut").alias("m")).collect()
    tonnes = [int(r.m * P.fuel_low * P.co2_factor / 1000 + 0.5) for r in minutes]
    ranked = [r for r in rows if r.medida.startswith("top_salida")]
    assert len(rows) == 13 + len(ranked) and all(r.cuadra for r in rows)
    assert [r.obtenido for r in ranked if r.obtenido > 0] == [t for t in sorted(tonnes, reverse=True)[:10] if t > 0]
    with pytest.raises(verification.VerificationError, match="puesto"):
        run(co2_aeropuerto_mes=tables["co2_aeropuerto_mes"].withColumn("co2_t_bajo_salida", F.lit(9.0)))
    monkeypatch.setattr(verification, "both_valid", lambda p: F.col("TaxiOut") < 12)
    with pytest.raises(verification.VerificationError, match="minutos_1996_05"):
        run()


def test_accuracy_query_has_a_row_for_each_of_the_ten_airports(spark, sf):
    names = [r.medida for r in registry.QUERIES["verificacion_exactitud"](spark, sf).collect()]
    assert set(names) >= set(verification.KNOWN_FIGURES) and len(names) == 23
    assert sum(name.startswith("top_salida_") for name in names) == 10


def test_ranking_may_round_to_other_units_than_its_rows(spark):
    """Months are published to the kilogram; a total beside half a tonne agrees whichever way it is rounded."""
    months = spark.createDataFrame([("A", 70.5004), ("B", 10.0)], "aeropuerto string, co2_t_bajo_salida double")
    expected = verification.pinned_ranking(spark, [("A", 70.4997), ("B", 10.0004)])
    rows = verification.verify_ranking(months, expected).orderBy("puesto").collect()
    assert [(r.aeropuerto_esperado, r.obtenido, r.cuadra) for r in rows] == [("A", 71.0, True), ("B", 10.0, True)]


def test_known_figures_name_every_published_figure(spark, data):
    flights, _ = data
    names = {r.medida for r in verification.recomputed_figures(flights, P).collect()}
    assert names == set(verification.KNOWN_FIGURES)


# Measured independently on the test tables: rows, populations A / B / C,
# false hour 24, 2400 rows in B, diverted that reached / did not reach.
MEASURED = {
    "sf0.001": (6_000, 5_869, 5_913, 5_880, 36, 17),
    "sf0.01": (60_000, 58_719, 59_084, 58_850, 430, 136),
    "sf0.1": (600_000, 587_082, 590_595, 588_329, 4_049, 1_205),
}


@pytest.mark.parametrize("scale", sorted(MEASURED))
def test_measured_figures(spark, scale):
    folder = Path("/root/testdata") / scale
    if not folder.exists():
        pytest.skip("test tables not present")
    flights = star_flights(spark, str(folder))
    pops, hours = reconciliation(taxi_state(flights, P), P).first(), hour_24_groups(taxi_state(flights, P), P).first()
    assert (flights.count(), pops.vuelos_ambos_validos, pops.obs_salida_valida, pops.obs_llegada_valida,
            hours.grupo24_cast, hours.valor_2400) == MEASURED[scale]


def test_exact_figures_do_not_share_the_rules_they_check(data, monkeypatch):
    """Another cap, hour or rate in the shared definitions is noticed, without any tolerance."""
    flights, _ = data
    assert len(verification.verify_exactly(flights, global_check(flights, P), P).collect()) == 8
    verification.require_all(verification.verify_exactly(flights, global_check(flights, P), P))
    kept = validity.valid_minutes
    monkeypatch.setattr(validity, "valid_minutes", lambda minutes, p: kept(minutes, replace(p, taxi_cap=p.taxi_cap + 40)))
    failed = verification.verify_exactly(flights, global_check(flights, P), P).where("NOT cuadra").select("medida").collect()
    assert "vuelos_validos" in {r.medida for r in failed}
    monkeypatch.undo()
    monkeypatch.setattr(numeric, "hours", lambda minutes: minutes / F.lit(60.5))
    monkeypatch.setattr(exploration, "hours", numeric.hours)
    failed = verification.verify_exactly(flights, global_check(flights, P), P).where("NOT cuadra").collect()
    assert [r.medida for r in failed] == ["horas_total"]


def test_recomputed_figures_notice_a_changed_cap(data, monkeypatch):
    flights, _ = data
    kept = validity.valid_minutes
    monkeypatch.setattr(validity, "valid_minutes", lambda minutes, p: kept(minutes, replace(p, taxi_cap=p.taxi_cap + 40)))
    tables = {"resumen_global": yearly_summary(departures(flights, P), P)}
    checks = verification.compare(
        verification.recomputed_figures(flights, P), verification.published_figures(tables, cleaning_statistics(flights, P)))
    assert not checks.where("NOT cuadra AND medida = 'vuelos_validos'").isEmpty()
