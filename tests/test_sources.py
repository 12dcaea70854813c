"""Readers and writers of tables."""

from __future__ import annotations

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from groundburn.operators import emissions, savings, weather_effect
from groundburn.operators.contracts import contract_check, to_contract
from groundburn.operators.measures import departures, segments
from groundburn.plans.audit import audit, audit_tables
from groundburn.plans.publish import emission_tables, publish
from groundburn.schema import CONTRACTS, FLIGHT, WEATHER
from groundburn.sinks import store
from groundburn.sinks.tables import read_published, read_table, replace_tables
from groundburn.sources.flights import one_month, read_flights
from groundburn.sources.star import STAR_PARAMS, star_flights
from groundburn.sources.weather import read_weather_csv, read_weather_json
from tests.edge_rows import FLIGHT_DDL, FLIGHTS, WEATHER_DDL, WEATHER_ROWS


@pytest.fixture(scope="module")
def flights(spark):
    return spark.createDataFrame(FLIGHTS, FLIGHT_DDL)


@pytest.fixture(scope="module")
def weather(spark):
    return spark.createDataFrame(WEATHER_ROWS, WEATHER_DDL)


def test_full_flight_schema():
    assert len(FLIGHT.names) == len(set(FLIGHT.names)) == 109
    assert FLIGHT["Div3Airport"].dataType.simpleString() == "string"
    assert FLIGHT.names[-2:] == ["Year", "Month"]


def test_month_read_opens_one_directory(spark, tmp_path):
    rows = spark.createDataFrame([(2023, m, float(m)) for m in (1, 2, 3)], "Year long, Month long, TaxiOut double")
    rows.write.partitionBy("Year", "Month").parquet(str(tmp_path / "f"))
    month = one_month(read_flights(spark, str(tmp_path / "f"), "vuelos"), 2023, 2)
    assert [r.TaxiOut for r in month.select("TaxiOut").collect()] == [2.0]
    plan = month.select("TaxiOut")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Year" in plan and "ReadSchema: struct<TaxiOut:double>" in plan
    assert spark.sql("SELECT count(*) FROM vuelos").first()[0] == 3


def test_weather_csv(spark, tmp_path):
    (tmp_path / "w.csv").write_text("Origin,Fecha,precipitacion_mm,nieve_cm,viento_max_kmh,temp_media_c\n"
                                    "ATL,2023-01-01,1.5,,10,\n")
    df = read_weather_csv(spark, str(tmp_path / "w.csv"))
    assert df.schema == WEATHER
    assert tuple(df.first()) == ("ATL", "2023-01-01", 1.5, None, 10.0, None)


def test_weather_answers(spark, tmp_path):
    def answer(airport, **daily):
        (tmp_path / f"{airport}.json").write_text(json.dumps({"latitude": 1.0, "daily": daily}, indent=1))

    answer("ATL", time=["2023-01-01", "nonsense", "2023-01-02", "2023-01-01"],
           precipitation_sum=[1.0, 9.0, None, 7.0], snowfall_sum=[0.0, 9.0, 2.0, 7.0],
           wind_speed_10m_max=[10, 9, 11, 7], temperature_2m_mean=[5.5, 9.0, 6.5, 7.0])
    answer("ORD", time=["2023-01-01"], precipitation_sum=[3.0])   # measures missing
    (tmp_path / "LAX.json").write_text(json.dumps({"error": True}))
    rows = {(r.Origin, r.Fecha): tuple(r)[2:] for r in read_weather_json(spark, f"{tmp_path}/*.json").collect()}
    assert rows == {
        ("ATL", "2023-01-01"): (1.0, 0.0, 10.0, 5.5),
        ("ATL", "2023-01-02"): (None, 2.0, 11.0, 6.5),
        ("ORD", "2023-01-01"): (3.0, None, None, None),
    }


def _values(tables):
    return {name: sorted(map(str, table.collect())) for name, table in tables.items()}


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_published_tables_come_back_with_contract_types(spark, flights, weather, tmp_path, file_format):
    p = replace(STAR_PARAMS, ranking_floor=10)
    known = flights.where(F.col("Origin").isNotNull() & F.col("Dest").isNotNull())
    tables = emission_tables(known, weather, p)
    publish(tables, str(tmp_path), file_format)
    back = read_published(spark, str(tmp_path), file_format)
    assert set(back) == set(CONTRACTS)
    for name, contract in CONTRACTS.items():
        if contract.fields:
            assert [(f.name, f.dataType) for f in back[name].schema] == [(f.name, f.dataType) for f in contract]
            assert _values({name: back[name]}) == _values({name: to_contract(name, tables[name])})
    assert {r.tabla: r.ok for r in contract_check(spark, back).collect()} == dict.fromkeys(CONTRACTS, True)


def test_shared_roll_up_changes_nothing(flights, weather):
    """The batch reads a roll-up, the single queries read flights: same tables."""
    p = replace(STAR_PARAMS, ranking_floor=10)
    batch, one_by_one = emission_tables(flights, weather, p), departures(flights, p)
    assert _values(batch) == _values({
        "resumen_global": emissions.yearly_summary(one_by_one, p),
        "co2_aeropuerto_mes": emissions.airport_month(segments(flights, p), p),
        "co2_aeropuerto_hora": emissions.airport_hour(one_by_one, p),
        "rodaje_clima": weather_effect.by_main_condition(one_by_one, weather, p),
        "rodaje_clima_independiente": weather_effect.by_each_condition(one_by_one, weather, p),
        "escenario_ahorro": savings.savings(one_by_one, p),
        "benchmark_salida": emissions.departure_groups(one_by_one),
    })


def test_failed_run_leaves_the_published_tables(spark, tmp_path):
    out = str(tmp_path)
    replace_tables({"a": spark.range(3), "b": spark.range(2)}, out)
    broken = spark.range(2).select(F.expr("assert_true(id < 0, 'no')").alias("id"))
    with pytest.raises(Exception, match="no"):
        replace_tables({"a": spark.range(9), "b": broken}, out)
    assert read_table(spark, out, "a").count() == 3
    replace_tables({"a": spark.range(4)}, out)
    assert (read_table(spark, out, "a").count(), read_table(spark, out, "b").count()) == (4, 2)
    assert not list(tmp_path.glob("_old_*"))


def test_contract_violations_are_named(spark):
    good = spark.createDataFrame([("nieve", 1, 2.0), ("nieve", 1, 2.0), (None, 1, 2.0)],
                                 CONTRACTS["rodaje_clima"])
    odd = good.withColumnRenamed("vuelos", "flights")
    rows = {r.tabla: r for r in contract_check(spark, {"rodaje_clima": good, "rodaje_clima_independiente": odd}).collect()}
    first = rows["rodaje_clima"]
    assert (first.filas, first.claves_repetidas, first.claves_nulas, first.ok) == (3, 1, 1, False)
    second = rows["rodaje_clima_independiente"]
    assert (second.sobran, second.faltan, second.ok) == ("flights", "vuelos", False)
    assert (rows["resumen_global"].presente, rows["resumen_global"].ok) == (False, False)


def test_audit_is_written_whole(spark, flights, weather, tmp_path):
    written = audit(flights, weather, STAR_PARAMS, str(tmp_path))
    assert len(written) == 20
    assert read_table(spark, str(tmp_path), "duplicados_resumen").first().max_repeticiones > 2
    assert not any(name.startswith("clima") for name in audit_tables(flights, None, STAR_PARAMS))


def test_store_writer_is_given_contract_columns(spark, monkeypatch):
    """No database here: the writer is inspected, not run."""
    saved = {}

    class Writer:
        def __init__(self, df):
            self.df, self.options_ = df, {}

        def format(self, kind):
            self.options_["format"] = kind
            return self

        def mode(self, mode):
            self.options_["mode"] = mode
            return self

        def option(self, key, value):
            self.options_[key] = value
            return self

        def options(self, **more):
            self.options_.update(more)
            return self

        def save(self):
            saved[self.options_["dbtable"]] = (self.df.schema, self.options_)

    table = spark.createDataFrame([("nieve", 1, 2.0, "more")], "condicion string, vuelos int, min_promedio_salida double, x string")
    monkeypatch.setattr(type(table), "write", property(Writer))
    store.load_store({"rodaje_clima": table}, "jdbc:some:url", {"user": "u"})
    schema, options = saved["rodaje_clima"]
    assert [(f.name, f.dataType) for f in schema] == [(f.name, f.dataType) for f in CONTRACTS["rodaje_clima"]]
    assert options == {"format": "jdbc", "mode": "overwrite", "url": "jdbc:some:url", "dbtable": "rodaje_clima", "user": "u"}


def test_star_flights_have_one_row_per_line_item(spark, sf):
    assert star_flights(spark, sf).count() == spark.read.parquet(f"{sf}/lineitem.parquet").count()
