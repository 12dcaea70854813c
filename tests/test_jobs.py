"""Jobs from the command line, publication in one step, months refreshed alone."""

from __future__ import annotations

import json
import sys

import pytest
from pyspark.sql import functions as F

import groundburn.__main__ as jobs
import groundburn.sinks.tables as tables_module
from groundburn.__main__ import run
from groundburn.operators.contracts import contract_check
from groundburn.operators.exploration import cleaning_from, cleaning_statistics
from groundburn.operators.verification import VerificationError
from groundburn.params import Params
from groundburn.plans import refresh as refresh_module
from groundburn.plans.publish import emission_tables, lake_tables, publish
from groundburn.plans.refresh import read_partials, refresh
from groundburn.schema import CONTRACTS
from groundburn.sinks import store
from groundburn.sinks.lake import flights_path, write_months
from groundburn.sinks.tables import read_published, read_table, replace_tables, roll_back, stored_published
from groundburn.sources.flights import read_flights
from groundburn.sources.weather import read_weather_csv
from tests.edge_rows import FLIGHT_DDL, WEATHER_DDL, WEATHER_ROWS, flight
from tests.test_ingest import _archive, _name, _report, _row

P = Params(ranking_floor=0, route_floor=0)


def values(tables):
    return {name: sorted(map(repr, table.collect())) for name, table in tables.items()}


def month(spark, number, minutes=(5.0, 9.0, 200.0, None), year=2023):
    rows = [flight(Year=year, Month=number, Origin=o, Dest="Z", TaxiOut=t, TaxiIn=7.0, FlightDate=f"{year}-{number:02d}-0{k + 1}", CRSDepTime=c)
            for k, t in enumerate(minutes) for o, c in (("A", 930), ("B", 2400), (None, 2390))]
    return spark.createDataFrame(rows, FLIGHT_DDL)


@pytest.fixture
def weather(spark):
    return spark.createDataFrame(WEATHER_ROWS, WEATHER_DDL)


@pytest.fixture
def lake(spark, tmp_path):
    path = str(tmp_path / "lake")
    write_months(month(spark, 1).union(month(spark, 2)), path)
    return path


# ---- publication -------------------------------------------------------------

@pytest.mark.parametrize("step", ["swap_text", "_load", "_pointer"])
def test_a_failure_at_any_step_leaves_all_old_tables(spark, tmp_path, monkeypatch, step):
    out = str(tmp_path / "out")
    replace_tables({"a": spark.range(3), "b": spark.range(2)}, out)
    kept, calls = getattr(tables_module, step), []

    def fails(*args):
        if not calls:
            calls.append(args)
            raise OSError("gone")
        return kept(*args)

    monkeypatch.setattr(tables_module, step, fails)
    with pytest.raises(OSError, match="gone"):
        replace_tables({"a": spark.range(9), "b": spark.range(9)}, out, check=lambda tables: None)
    monkeypatch.undo()
    assert (read_table(spark, out, "a").count(), read_table(spark, out, "b").count()) == (3, 2)
    assert len(list((tmp_path / "out" / "_versions").iterdir())) == 1


def test_roll_back_and_unused_versions(spark, tmp_path):
    out = str(tmp_path / "out")
    with pytest.raises(ValueError):
        roll_back(spark, out)
    for n in (1, 2, 3):
        replace_tables({"a": spark.range(n)}, out, "csv" if n == 2 else "parquet")
    assert read_table(spark, out, "a").count() == 3
    assert len(run(spark, ["rollback", "--out", out])) == 1
    assert read_table(spark, out, "a").count() == 2
    roll_back(spark, out)
    assert read_table(spark, out, "a").count() == 3
    assert len(list((tmp_path / "out" / "_versions").iterdir())) == 2
    replace_tables({"b": spark.range(5)}, out)
    assert [read_table(spark, out, t).count() for t in "ab"] == [3, 5]
    assert not list((tmp_path / "out").glob("_current.json.*"))


def test_folders_without_a_pointer_are_read(spark, tmp_path):
    spark.range(4).write.parquet(f"{tmp_path}/a")
    assert read_table(spark, str(tmp_path), "a").count() == 4


# ---- contract ----------------------------------------------------------------

def test_types_are_checked(spark):
    text = spark.createDataFrame([("nieve", "1", "2.5"), ("lluvia", "x", "3")], "condicion string, vuelos string, min_promedio_salida string")
    whole = spark.createDataFrame([("nieve", 1, 2.5)], "condicion string, vuelos int, min_promedio_salida double")
    bare = spark.createDataFrame([(1, 2.0)], "vuelos long, min_promedio_salida double")

    def verdict(table, as_text=False):
        return next(r for r in contract_check(spark, {"rodaje_clima": table}, as_text).collect() if r.tabla == "rodaje_clima")

    assert (verdict(text).tipos, verdict(text).ok) == ("min_promedio_salida:string,vuelos:string", False)
    assert (verdict(text, True).tipos, verdict(text, True).ilegibles, verdict(text, True).ok) == ("", 1, False)
    assert verdict(text.where("vuelos = '1'"), True).ok
    assert (verdict(whole).tipos, verdict(whole).ok) == ("vuelos:int", False)
    absent = verdict(bare)
    assert (absent.faltan, absent.claves_repetidas, absent.claves_nulas, absent.ok) == ("condicion", None, None, False)


def test_check_reads_what_is_stored_and_sets_the_exit_status(spark, lake, weather, tmp_path, monkeypatch, capsys):
    out = str(tmp_path / "out")
    publish(emission_tables(read_flights(spark, flights_path(lake)).where("Origin IS NOT NULL"), weather, P), out, "csv")
    stored = stored_published(spark, out)
    assert set(dict(stored["benchmark_salida"].dtypes).values()) == {"string"}
    assert dict(read_published(spark, out)["benchmark_salida"].dtypes) == {
        "aeropuerto": "string", "anio": "bigint", "mes": "bigint", "hora": "bigint", "min_rodaje_salida": "double", "vuelos": "bigint"}
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    monkeypatch.setattr(jobs, "release_all", lambda spark: None)
    monkeypatch.setattr(sys, "argv", ["groundburn", "check", "--out", out, "--format", "csv"])
    assert jobs.main() == 0
    replace_tables({"rodaje_clima": spark.createDataFrame([("nieve", "many", "2.5")], "condicion string, vuelos string, min_promedio_salida string")}, out, "csv")
    assert jobs.main() == 1
    assert "ilegibles=1" in capsys.readouterr().out
    assert read_table(spark, out, "rodaje_clima").first().vuelos is None


# ---- months refreshed alone ----------------------------------------------------

def test_a_new_month_reads_one_month(spark, lake, weather, monkeypatch):
    read = []
    whole = refresh_module.read_flights

    class Watched:
        def __init__(self, df):
            self.df = df

        def where(self, condition):
            rows = self.df.where(condition)
            read.extend(rows.select("Year").inputFiles() and {f.split("/Year=")[1].rsplit("/", 1)[0] for f in rows.where("true").select(
                F.input_file_name()).distinct().toPandas().iloc[:, 0]})
            return rows

    monkeypatch.setattr(refresh_module, "read_flights", lambda *a: Watched(whole(*a)))
    assert refresh(spark, lake, P) == [(2023, 1), (2023, 2)]
    assert refresh(spark, lake, P) == []
    read.clear()
    write_months(month(spark, 3, (11.0, 12.5)), lake)
    assert refresh(spark, lake, P) == [(2023, 3)] and read == ["2023/Month=3"]
    flights = read_flights(spark, flights_path(lake))
    assert values(lake_tables(spark, lake, weather, P)) == values(emission_tables(flights, weather, P))
    assert cleaning_from(read_partials(spark, lake)["calidad"]).collect() == cleaning_statistics(flights, P).collect()


def test_replaced_emptied_and_removed_months(spark, lake, weather, tmp_path):
    refresh(spark, lake, P)
    write_months(month(spark, 2, (None, 500.0)), lake)  # nothing valid is left of it
    assert refresh(spark, lake, P) == [(2023, 2)]
    for file in (tmp_path / "lake" / "vuelos" / "Year=2023" / "Month=1").iterdir():
        file.unlink()
    write_months(month(spark, 4), lake)
    assert refresh(spark, lake, P) == [(2023, 4)]
    flights = read_flights(spark, flights_path(lake))
    assert values(lake_tables(spark, lake, weather, P)) == values(emission_tables(flights, weather, P))
    lower = Params(ranking_floor=0, route_floor=0, taxi_cap=6.0)
    assert refresh(spark, lake, lower) == [(2023, 2), (2023, 4)]
    assert values(lake_tables(spark, lake, weather, lower)) == values(emission_tables(flights, weather, lower))


def test_a_refresh_that_dies_is_made_again(spark, lake, monkeypatch):
    refresh(spark, lake, P)
    write_months(month(spark, 2, (8.0,)), lake)
    monkeypatch.setattr(refresh_module, "for_each", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        refresh(spark, lake, P)
    monkeypatch.undo()
    assert refresh(spark, lake, P) == [(2023, 2)]


def test_an_empty_lake(spark, tmp_path):
    assert refresh(spark, str(tmp_path), P) == []
    assert {t.count() for t in read_partials(spark, str(tmp_path)).values()} == {0}


# ---- jobs ----------------------------------------------------------------------

@pytest.fixture
def landed(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for m in (1, 2):
        _archive(folder, 2023, m, [_row(2023, m, out=f"{10 + m}.00", number=str(i)) for i in range(5)])
    (folder / _name(2023, 3)).write_bytes(b"broken")
    (tmp_path / "answers").mkdir()
    return folder


def answer(folder, airport, days):
    (folder / f"{airport}.json").write_text(json.dumps({"daily": {
        "time": list(days), "precipitation_sum": list(days.values()), "snowfall_sum": [0.0] * len(days),
        "wind_speed_10m_max": [1.0] * len(days), "temperature_2m_mean": [None] * len(days)}}))


def test_weather_is_merged_by_day(spark, landed, tmp_path):
    answers, table = tmp_path / "answers", str(tmp_path / "weather")
    job = ["weather", "--answers", str(answers), "--table", table]
    answer(answers, "ATL", {"2023-01-01": 1.0, "2023-01-02": 2.0})
    assert tuple(run(spark, job).first()) == (2, 1, "2023-01-01", "2023-01-02", 0)
    answer(answers, "ATL", {"2023-01-02": 9.0, "2023-01-03": 3.0})
    answer(answers, "ORD", {"2023-01-01": 4.0})
    assert tuple(run(spark, job).first()) == (4, 2, "2023-01-01", "2023-01-03", 1)
    rain = {(r.Origin, r.Fecha): r.precipitacion_mm for r in jobs.read_weather(spark, table).collect()}
    assert rain == {("ATL", "2023-01-01"): 1.0, ("ATL", "2023-01-02"): 2.0, ("ATL", "2023-01-03"): 3.0, ("ORD", "2023-01-01"): 4.0}
    assert run(spark, [*job, "--first", "new"]).first().duplicados == 3
    rain = {(r.Origin, r.Fecha): r.precipitacion_mm for r in jobs.read_weather(spark, table).collect()}
    assert rain["ATL", "2023-01-02"] == 9.0 and len(rain) == 4


def test_flow_verify_rollback_and_load(spark, landed, tmp_path, monkeypatch):
    answer(tmp_path / "answers", "ATL", {"2023-01-01": 9.0})
    table, out, lake = str(tmp_path / "weather"), str(tmp_path / "out"), str(tmp_path / "lake")
    run(spark, ["weather", "--answers", str(tmp_path / "answers"), "--table", table])
    flow = ["flow", "--archives", str(landed), "--lake", lake, "--weather", table, "--out", out, "--verify"]
    report = _report(run(spark, [*flow, "--fuel-high", "9", "--co2-factor", "2", "--years", "2023", "--ranking-floor", "0"]))
    assert {k: v[0] for k, v in report.items()} == {"2023_1.zip": "convertido", "2023_2.zip": "convertido", "2023_3.zip": "zip_corrupto"}
    year = read_published(spark, out)["resumen_global"].first()
    minutes = sum(5 * (10 + m + 6) for m in (1, 2))
    assert (year.vuelos, year.co2_t_bajo, year.co2_t_alto) == (10, round(minutes * 6 * 2 / 1000, 3), round(minutes * 9 * 2 / 1000, 3))

    known = tmp_path / "known.json"
    same = ["--fuel-high", "9", "--co2-factor", "2"]
    verify = ["verify", "--lake", lake, "--out", out, "--figures", str(known), *same]
    known.write_text(json.dumps({"figures": {"filas": 10, "vuelos_validos": 10}, "ranking": [["ATL", 1]]}))
    assert run(spark, verify).count() == 15
    for wrong in ({"figures": {"filas": 12}}, {"figures": {"no_such": 1}}, {"ranking": [["ORD", 1]]}, {"ranking": [["ATL", 1], ["X", 0]]}):
        known.write_text(json.dumps(wrong))
        with pytest.raises(VerificationError):
            run(spark, verify)
        with pytest.raises(VerificationError):
            run(spark, ["publish", "--lake", lake, "--weather", table, "--out", out, "--verify", "--figures", str(known)])
        assert read_published(spark, out)["resumen_global"].first().co2_t_alto == year.co2_t_alto
    known.write_text("[]")
    with pytest.raises(ValueError):
        run(spark, verify)
    with pytest.raises(SystemExit):
        run(spark, ["publish", "--lake", lake, "--weather", table, "--out", out, "--figures", str(known)])

    run(spark, ["publish", "--lake", lake, "--weather", table, "--out", out])
    assert read_published(spark, out)["resumen_global"].first().co2_t_alto != year.co2_t_alto
    run(spark, ["rollback", "--out", out])
    assert read_published(spark, out)["resumen_global"].first().co2_t_alto == year.co2_t_alto

    loaded = {}
    monkeypatch.setattr(jobs, "load_store", lambda tables, url, properties: loaded.update(url=url, properties=properties, tables=set(tables)))
    assert run(spark, ["load", "--out", out, "--url", "jdbc:x:y", "--property", "user=u", "--property", "password=a=b"]) == sorted(CONTRACTS)
    assert loaded == {"url": "jdbc:x:y", "properties": {"user": "u", "password": "a=b"}, "tables": set(CONTRACTS)}
    assert store.load_store is not jobs.load_store
    with pytest.raises(SystemExit):
        run(spark, ["load", "--out", out, "--url", "jdbc:x:y", "--property", "user"])


def test_volume(spark, landed):
    total = run(spark, ["volume", "--archives", str(landed), "--minimum-gb", "0.0000001"]).first()
    assert total.archivos == 3 and total.bytes_zip == sum(f.stat().st_size for f in landed.iterdir())
    assert total.bytes_csv > 0 and total.cumple_minimo
    assert not run(spark, ["volume", "--archives", str(landed)]).first().cumple_minimo


def test_every_parameter_is_an_option(spark, lake, tmp_path):
    (tmp_path / "w.csv").write_text(",".join(["Origin", "Fecha", "precipitacion_mm", "nieve_cm", "viento_max_kmh", "temp_media_c"]) + "\nA,2023-01-01,3,0,9,1\n")
    where = ["--lake", lake, "--weather", str(tmp_path / "w.csv")]
    a = jobs._arguments(["publish", *where, "--out", "x", "--years", "2023", "2024", "--taxi-cap", "90", "--cut-share", "0.2"])
    assert jobs._params(a) == Params(years=(2023, 2024), taxi_cap=90.0, cut_share=0.2)
    run(spark, ["publish", *where, "--out", str(tmp_path / "o"), "--heavy-rain-mm", "2", "--strong-wind-kmh", "5"])
    assert {r.condicion for r in read_published(spark, str(tmp_path / "o"))["rodaje_clima_independiente"].where("vuelos > 0").collect()} >= {"lluvia_fuerte"}
    assert read_weather_csv(spark, str(tmp_path / "w.csv")).count() == 1
