"""Every query against its SQL: on the test tables and on hand-made rows."""

from __future__ import annotations

import duckdb
import pytest

import groundburn.registry as registry
from checks.compare import connect, differences
from checks.oracle import ORACLES, over_test_tables
from tests.edge_rows import FLIGHT_DDL, FLIGHTS, WEATHER_DDL, WEATHER_ROWS, flight, load

def test_every_query_has_sql():
    assert set(ORACLES) == set(registry.QUERIES)


#: Empty by design: what they look for does not occur, or nothing is selected.
EMPTY_ON_TEST_TABLES = {"crsdeptime_invalidos", "duplicados_ejemplos"}
#: Rankings whose floor no airport or route reaches at the smallest scale.
BELOW_FLOOR = {"aeropuertos_lentos", "panel_lentos", "rutas_atrasadas"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_on_test_tables(spark, sf, name):
    assert registry.QUERIES[name](spark, sf).isEmpty() == (name in EMPTY_ON_TEST_TABLES | BELOW_FLOOR)
    assert differences(registry.QUERIES[name](spark, sf), connect(sf), over_test_tables(ORACLES[name])) == []


@pytest.fixture
def by_hand(spark, monkeypatch):
    """Point the registered queries at given rows instead of the test tables."""
    def use(flights, weather):
        con = duckdb.connect()
        load(con, flights, weather)
        frame = spark.createDataFrame(flights, FLIGHT_DDL)
        days = spark.createDataFrame(weather, WEATHER_DDL)
        reports = spark.createDataFrame(
            [(*row, i + 1) for i, row in enumerate(weather)], f"{WEATHER_DDL}, informe long")
        monkeypatch.setattr(registry, "star_flights", lambda *_: frame)
        monkeypatch.setattr(registry, "star_weather", lambda *_: days)
        monkeypatch.setattr(registry, "star_weather_reports", lambda *_: reports)
        return con
    return use


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_on_edge_rows(spark, by_hand, name):
    con = by_hand(FLIGHTS, WEATHER_ROWS)
    assert differences(registry.QUERIES[name](spark, ""), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_on_no_rows(spark, by_hand, name):
    if name == "esquema" or name == "nulos_campos_criticos":
        pytest.skip("a column type cannot be asked of no rows in SQL")
    con = by_hand([], [])
    assert differences(registry.QUERIES[name](spark, ""), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", ["escenario_ahorro", "escenario_ahorro_universo_a", "aeropuertos_lentos",
                                  "panel_lentos", "rutas_atrasadas", "rodaje_excesivo"])
def test_above_the_floors(spark, by_hand, name):
    """Enough flights at five airports for the rankings to have members."""
    rows = [flight(Origin=f"A{a}", Dest=f"B{a}", TaxiOut=float(5 + (i * (a + 3)) % 50), ArrDel15=float(i % (a + 2) == 0))
            for a in range(5) for i in range(2100)]
    con = by_hand(rows, WEATHER_ROWS)
    assert differences(registry.QUERIES[name](spark, ""), con, ORACLES[name]) == []
