"""What the plans must look like, whatever the size of the data."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import groundburn.registry as registry
import groundburn.sources.star as star
from groundburn.functions import joins, quantiles
from groundburn.operators import coverage, delays, emissions, exploration, taxi_quality, weather_effect
from groundburn.operators.measures import arrivals, departures, roll_ups, segments
from groundburn.plans.audit import audit
from groundburn.schema import FLIGHT, FLIGHT_KEY, WEATHER
from groundburn.sources.flights import read_flights
from groundburn.sources.star import STAR_PARAMS as P
from groundburn.sources.star import star_flights, star_weather
from tests.edge_rows import FLIGHT_DDL, FLIGHTS, flight

#: Read the flights once however their result is put together.
ONE_SCAN = (
    "co2_aeropuerto_mes", "co2_aeropuerto_hora", "resumen_global", "escenario_ahorro", "limpieza",
    "conciliacion_universos", "universos_por_anio", "tendencia", "rodaje_excesivo", "estadisticas_atraso",
    "calidad_taxiout_por_anio", "cobertura_resumen", "nulos_campos_criticos", "hora_pico", "mapa_calor",
)


def executed(df) -> str:
    """The final plan, after running it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def nothing_is_small(spark, monkeypatch):
    """Plan as if every table were too large to broadcast."""
    monkeypatch.setattr(star, "BROADCAST_BYTES", -1)
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_query_crosses_its_inputs(spark, sf, nothing_is_small, name):
    plan = planned(registry.QUERIES[name](spark, sf))
    assert not re.search("CartesianProduct|BroadcastNestedLoop", plan)


@pytest.mark.parametrize("name", ONE_SCAN)
def test_flights_are_scanned_once(spark, sf, nothing_is_small, name, monkeypatch):
    """In the result's plan, or in that of the one histogram that is stored and measured beforehand."""
    stored = []
    for module in (quantiles, exploration):
        kept = module.materialise
        monkeypatch.setattr(module, "materialise", lambda df, kept=kept: (stored.append(planned(df)), kept(df))[1])
    plans = [executed(registry.QUERIES[name](spark, sf)), *stored]
    assert sum(len(re.findall(r"FileScan parquet [^\n]*lineitem", plan)) for plan in plans) == 1


#: Go over the flights several times, but over a table of them or of their sums.
JOINED_ONCE = (
    "contract_check_cambiadas",
    "duplicados_resumen", "duplicados_resumen_ruta_dia",
    "verificacion_cruzada",
    "duplicados_ejemplos", "duplicados_ejemplos_ruta_dia",
    "etiqueta_excesivo",
    "verificacion_exactitud",
)


@pytest.mark.parametrize("name", JOINED_ONCE)
def test_flights_are_joined_once(spark, sf, monkeypatch, name):
    """Every leg that comes out of the join of the test tables is counted."""
    counted = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def seen(_):
        counted.add(1)
        return True

    flights = star_flights(spark, sf)
    monkeypatch.setattr(registry, "star_flights", lambda *_: flights.where(seen.asNondeterministic()("CRSDepTime")))
    registry.QUERIES[name](spark, sf).collect()
    assert counted.value == flights.count()


def test_levels_of_one_scan(spark):
    """NULL keys are groups of their own, not sums over the key."""
    rows = spark.createDataFrame([("a", 1, 2.0), ("a", None, 3.0), (None, None, 4.0), (None, 1, None)], "k string, h int, m double")
    for level, got in zip((["k", "h"], ["k"], ["h"]), roll_ups(rows, (["k", "h"], ["k"], ["h"]), ("m",)), strict=True):
        want = rows.groupBy(*level).agg(F.sum("m").alias("m"))
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
        assert got.columns == want.columns


def test_large_tables_are_not_broadcast(spark, sf, nothing_is_small):
    assert "BroadcastExchange" not in planned(star_flights(spark, sf))
    daily = weather_effect.by_main_condition(departures(star_flights(spark, sf), P), star_weather(spark, sf), P)
    assert "BroadcastExchange" not in planned(daily)


def test_lines_move_as_what_the_query_uses(spark, sf, nothing_is_small):
    """Month and taxi-out beside the key, not the quantities and keys they are worked out from."""
    plan = planned(registry.QUERIES["por_mes"](spark, sf))
    moved = re.search(r"Exchange hashpartitioning\(l_orderkey[^\n]*\n[^\n]*Project \[([^\n]*)\]\n", plan)[1]
    assert re.fullmatch(r"l_orderkey#\d+L, cast\(l_shipdate#\d+ as date\) AS day#\d+, CASE WHEN .* END AS TaxiOut#\d+", moved)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake") / "vuelos")
    spark.createDataFrame(FLIGHTS, FLIGHT_DDL).write.partitionBy("Year", "Month").parquet(root)
    return read_flights(spark, root)


def test_filters_and_columns_reach_the_files(lake):
    plan = planned(emissions.departure_groups(departures(lake, P)))
    assert "LessThanOrEqual(TaxiOut,180.0)" in plan
    assert set(re.search(r"ReadSchema: struct<([^>]*)>", plan)[1].split(",")) == {
        "Origin:string", "CRSDepTime:bigint", "TaxiOut:double"}
    assert "LessThanOrEqual(TaxiIn,180.0)" in planned(arrivals(lake, P))
    assert "IsNotNull(ArrDel15)" in planned(delays.late_by_airline(lake))


def test_aggregates_combine_before_the_shuffle(lake):
    for df in (emissions.departure_groups(departures(lake, P)), emissions.airport_month(segments(lake, P), P),
               taxi_quality.taxi_state(lake, P)):
        before = planned(df).rsplit("Exchange hashpartitioning", 1)[1]
        assert "partial_" in before


def test_rows_are_narrowed_to_shared_hashes_before_keys_are_grouped(lake):
    plan = planned(coverage.repeated_keys(lake, unique=True))
    assert plan.index("Exchange hashpartitioning") < plan.index("LeftSemi")


def test_unique_hashes_are_not_counted_before_the_shuffle(lake, monkeypatch):
    """A map side full of keys of their own collapses nothing and spills."""
    stored, kept = [], joins.materialise
    monkeypatch.setattr(joins, "materialise", lambda df: (stored.append(planned(df)), kept(df))[1])
    coverage.repeated_keys(lake, unique=True)
    above, below = stored[0].split("Exchange hashpartitioning(_h")
    assert "HashAggregate" in above and "HashAggregate" not in below


def test_hash_collisions_are_settled(spark, monkeypatch):
    """With one hash for everything the answer must not change."""
    rows = spark.createDataFrame([flight(Origin=o) for o in ("A", "A", "B", None, None, "C", "C", "C")], FLIGHT_DDL)
    monkeypatch.setattr(coverage.F, "xxhash64", lambda *_: F.lit(1).cast("long"))
    repeated = coverage.repeated_keys(rows, unique=True)
    assert {r.Origin: r.n for r in repeated.collect()} == {"A": 2, None: 2, "C": 3}
    assert tuple(coverage.duplicate_summary(rows.agg(F.count("*").alias("n")), repeated).first()) == (4, 8, 3, 7, 3)


def test_equal_numbers_are_one_key(spark):
    rows = spark.createDataFrame([(0.0,), (-0.0,), (1.0,), (float("nan"),), (float("nan"),)], "x double")
    for unique in (True, False, None):
        assert sorted(r.n for r in coverage.repeated_keys(rows, ["x"], unique).collect()) == [2, 2]


def test_a_key_with_a_third_of_the_rows(spark):
    """Copies of one key, one airport and one day do not change any result."""
    hot = [flight(Origin="HOT", TaxiOut=20.0)] * 500
    rest = [flight(Origin=f"A{i % 50}", Flight_Number_Reporting_Airline=i, TaxiOut=float(5 + i % 30)) for i in range(1000)]
    rows = spark.createDataFrame(hot + rest, FLIGHT_DDL).repartition(7)
    total = rows.agg(F.count("*").alias("n"))
    for unique in (True, False):
        assert tuple(coverage.duplicate_summary(total, coverage.repeated_keys(rows, unique=unique)).first()) == (1001, 1500, 1, 500, 500)
    assert tuple(coverage.duplicates(rows).first()) == (1001, 1500, 1, 500, 500)
    by_airport = {r.aeropuerto: r.vuelos for r in emissions.airport_hour(departures(rows, P), P).collect()}
    assert by_airport["HOT"] == 500 and sum(by_airport.values()) == 1500


def _shuffles(plan: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning", plan))


def test_many_duplicates_take_one_scan_and_one_shuffle(spark, tmp_path):
    """A route and day that most rows share: grouped at once. Keys nearly all unique: hashes first."""
    rows = [flight(Origin=f"A{i % 9}", FlightDate=f"2023-01-{1 + i % 20:02d}", Flight_Number_Reporting_Airline=i) for i in range(2000)]
    spark.createDataFrame(rows, FLIGHT_DDL).write.partitionBy("Year", "Month").parquet(f"{tmp_path}/vuelos")
    flights = read_flights(spark, f"{tmp_path}/vuelos")
    assert not coverage.mostly_unique(flights, registry.ROUTE_DAY) and coverage.mostly_unique(flights)
    for found in (coverage.duplicates(flights, registry.ROUTE_DAY), coverage.repeated_keys(flights, registry.ROUTE_DAY)):
        plan = planned(found)
        assert (len(re.findall("FileScan parquet", plan)), _shuffles(plan), "LeftSemi" in plan) == (1, 1, False)
        assert "partial_count" in plan
    assert "LeftSemi" in planned(coverage.repeated_keys(flights))
    for key in (registry.ROUTE_DAY, FLIGHT_KEY):
        total = flights.agg(F.count("*").alias("n"))
        both = [tuple(coverage.duplicate_summary(total, coverage.repeated_keys(flights, key, unique)).first()) for unique in (True, False)]
        assert both == [tuple(coverage.duplicates(flights, key).first())] * 2


def test_the_audit_reads_the_flights_at_most_eight_times(spark, tmp_path):
    n = 20_000
    rows = spark.range(n).selectExpr(
        "2023L AS Year", "1 + id % 3 AS Month", "concat('2023-0', 1 + id % 3, '-1', id % 9) AS FlightDate", "id AS Flight_Number_Reporting_Airline",
        "concat('A', id % 40) AS Origin", "concat('A', id % 37) AS Dest", "id % 2400 AS CRSDepTime", "double(id % 50) AS TaxiOut", "double(id % 20) AS TaxiIn",
        "double(int(id % 50 = 0)) AS Diverted", "'A1' AS Div1Airport", "'WN' AS Reporting_Airline")
    for field in FLIGHT.fields:
        if field.name not in rows.columns:
            rows = rows.withColumn(field.name, F.lit(None).cast(field.dataType))
    rows.write.partitionBy("Year", "Month").parquet(f"{tmp_path}/vuelos")
    flights = read_flights(spark, f"{tmp_path}/vuelos")
    weather = spark.createDataFrame([("A1", "2023-01-11", 1.0, 0.0, 3.0, 4.0)], WEATHER)
    store = spark.sparkContext._jsc.sc().statusStore()
    none = spark._jvm.java.util.ArrayList()

    def stages():
        found = store.stageList(none, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), none)
        return {found.apply(i).stageId(): found.apply(i).inputRecords() for i in range(found.size())}

    before = stages()
    audit(flights, weather, P, f"{tmp_path}/audit")
    read = [records for stage, records in stages().items() if stage not in before]
    assert 1 <= sum(read) / n < 9, "rows read by the whole audit, in flights"
