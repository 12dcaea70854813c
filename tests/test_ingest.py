"""Archives into the lake: good, damaged, incomplete, repeated, streamed."""

from __future__ import annotations

import csv
import zipfile
from dataclasses import replace
from pathlib import Path

import pytest

from groundburn.__main__ import run
from groundburn.operators.verification import VerificationError
from groundburn.params import Params
from groundburn.plans.ingest import convert, ingest, run_flow
from groundburn.schema import REQUIRED
from groundburn.sinks.lake import flights_path
from groundburn.sinks.tables import read_published
from groundburn.sources import archives
from groundburn.sources.archives import archive_sizes, file_volume, input_volume, list_archives
from groundburn.sources.flights import one_month, read_flights
from groundburn.sources.weather import read_weather_csv
from groundburn.streaming.ingest import start_ingest

HEADER = ["Year", "Month", "FlightDate", "DayOfWeek", "Reporting_Airline", "Flight_Number_Reporting_Airline",
          "Origin", "Dest", "CRSDepTime", "TaxiOut", "TaxiIn", "ArrDel15", "DepDelay", "ArrDelay",
          "Div3Airport", "OriginCityName", ""]


def _name(year: int, month: int) -> str:
    return f"On_Time_Reporting_Carrier_On_Time_Performance_1987_present_{year}_{month}.zip"


def _row(year, month, origin="ATL", out="15.00", crs="0930", city='"Atlanta, GA"', number="7"):
    return f"{year},{month},{year}-{month:02d}-01,7,WN,{number},{origin},ORD,{crs},{out},6.00,0.00,-3.00,-9.00,,{city},"


def _archive(folder, year, month, rows, header=None, name=None):
    with zipfile.ZipFile(folder / (name or _name(year, month)), "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("readme.html", "nothing here")
        z.writestr("flights.csv", "\n".join([",".join(header or HEADER), *rows]) + "\n")


@pytest.fixture
def landed(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    _archive(folder, 2023, 1, [_row(2023, 1), _row(2023, 1, out="", number=""), _row(2023, 1, out="x")])
    _archive(folder, 2023, 2, [_row(2023, 2, origin="LAX")])
    (folder / _name(2023, 3)).write_bytes(b"this is no archive")
    _archive(folder, 2023, 4, ["2023,4,ATL"], ["Year", "Month", "Origin"])
    return folder


def test_a_bad_archive_stops_no_other(spark, landed, tmp_path):
    lake = str(tmp_path / "lake")
    _archive(landed, 2023, 6, [_row(2023, 6), _row(2023, 6) + "one,too,many"])
    _archive(landed, 2023, 7, [_row(2023, 7)])
    with zipfile.ZipFile(landed / _name(2023, 8), "w") as z:
        z.writestr("flights.csv", (",".join(HEADER) + "\n").encode() + _row(2023, 8, city="\xe9").encode("latin-1") + b"\n")
    with zipfile.ZipFile(landed / _name(2023, 7), "a") as z:
        z.writestr("more.csv", "x\n")
    report = _report(ingest(spark, str(landed), lake))
    assert [report[f"2023_{k}.zip"][0] for k in (6, 7, 8)] == ["csv_danado", "varios_csv", "codificacion_invalida"]
    assert _months(spark, lake) == {(2023, 1): 3, (2023, 2): 1}


@pytest.mark.parametrize("column", ["OriginCityName", "Div3Airport", "Reporting_Airline", "no_such_column", ""])
def test_one_bad_byte_in_any_column_is_one_status(spark, tmp_path, column):
    """Far into the file, so that rows before it were already read."""
    folder, lake = tmp_path / "raw", str(tmp_path / "lake")
    folder.mkdir()
    header = [*HEADER[:-1], "no_such_column", ""]
    for month in range(1, 5):
        rows = [[*next(csv.reader([_row(2023, month, number=str(i))]))[:-1], "x", ""] for i in range(20_000)]
        if month == 3:
            rows[15_000][header.index(column)] = "caf\xe9"
        text = "\n".join([",".join(header), *(",".join(f'"{v}"' if "," in v else v for v in r) for r in rows)]) + "\n"
        with zipfile.ZipFile(folder / _name(2023, month), "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("flights.csv", text.encode("latin-1"))
    report = _report(run(spark, ["ingest", "--archives", str(folder), "--lake", lake]))
    assert {k: v[:2] for k, v in report.items()} == {
        **{f"2023_{m}.zip": ("convertido", 20_000) for m in (1, 2, 4)}, "2023_3.zip": ("codificacion_invalida", None)}
    assert _months(spark, lake) == {(2023, m): 20_000 for m in (1, 2, 4)}
    again = _report(run(spark, ["ingest", "--archives", str(folder), "--lake", lake]))
    assert again["2023_3.zip"][0] == "codificacion_invalida" and again["2023_1.zip"][0] == "omitido"


def test_every_byte_is_decompressed_once_and_nothing_stays_staged(spark, landed, tmp_path, monkeypatch):
    """Counted in this process, on the generator that tasks run."""
    read = []
    whole = zipfile.ZipExtFile.read
    monkeypatch.setattr(zipfile.ZipExtFile, "read", lambda self, n=-1: (read.append(len(out := whole(self, n))), out)[1])
    parts = list(archives._read_one(str(landed / _name(2023, 1))))
    assert parts[-1]["estado"] == "valido" and sum(len(names) for names, _ in parts[:-1]) == 3
    with zipfile.ZipFile(landed / _name(2023, 1)) as z:
        assert sum(read) == sum(m.file_size for m in z.infolist())
    monkeypatch.undo()
    before = {p.name for p in _staged(spark)}
    ingest(spark, str(landed), str(tmp_path / "lake"))
    new = [p for p in _staged(spark) if p.name not in before]
    assert not any("TaxiOut" in spark.read.parquet(str(p)).columns for p in new)


def _staged(spark):
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:")) / spark.sparkContext.applicationId
    return list(folder.glob("*")) if folder.exists() else []


def test_paths_of_other_stores():
    with pytest.raises(FileNotFoundError):
        archives._opened("file:/no/such/file.zip")
    status = list(archives._read_one("file:///no/such_2023_1.zip"))
    assert [s["estado"] for s in status] == ["zip_corrupto"]


def test_odd_members(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    with zipfile.ZipFile(folder / _name(2023, 1), "w") as z:
        z.writestr("flights.csv", "")
    with zipfile.ZipFile(folder / _name(2023, 2), "w") as z:
        z.writestr("flights.csv", "\ufeff" + ",".join(HEADER) + "\r\n" + _row(2023, 2) + "\r\n")
    with zipfile.ZipFile(folder / _name(2023, 3), "w") as z:
        z.writestr("readme.html", "no table")
    with zipfile.ZipFile(folder / _name(2023, 4), "w") as z:
        z.writestr("flights.csv", ",".join(HEADER))
    with zipfile.ZipFile(folder / _name(2023, 5), "w") as z:
        z.writestr("flights.csv", ",".join([*HEADER[:-1], "TaxiOut"]) + "\n" + _row(2023, 5) + "99\n")
    report = _report(ingest(spark, str(folder), str(tmp_path / "lake")))
    assert report["2023_1.zip"][0] == report["2023_3.zip"][0] == "esquema_incompleto"
    assert report["2023_2.zip"][:2] == ("convertido", 1) and report["2023_4.zip"][0] == "convertido"
    assert one_month(read_flights(spark, flights_path(str(tmp_path / "lake"))), 2023, 5).first().TaxiOut == 15.0


def test_whole_numbers_are_not_cut(spark, landed, tmp_path):
    lake = str(tmp_path / "lake")
    _archive(landed, 2023, 6, [_row(2023, 6, crs="930.7"), _row(2023, 6, crs="930.00")])
    ingest(spark, str(landed), lake)
    assert sorted(str(r.CRSDepTime) for r in one_month(read_flights(spark, flights_path(lake)), 2023, 6).collect()) == ["930", "None"]


def test_streams_keep_their_own_ledgers(spark, tmp_path):
    lake = str(tmp_path / "lake")
    for k, rows in ((1, 3), (2, 1)):
        folder = tmp_path / f"raw{k}"
        folder.mkdir()
        _archive(folder, 2023, k, [_row(2023, k)] * rows)
        start_ingest(spark, str(folder), lake, str(tmp_path / f"checkpoint{k}")).awaitTermination()
    again = tmp_path / "again"
    again.mkdir()
    _archive(again, 2023, 1, [_row(2023, 1)])
    assert _report(ingest(spark, str(again), lake))["2023_1.zip"][0] == "omitido"
    assert _months(spark, lake) == {(2023, 1): 3, (2023, 2): 1}


def _report(df):
    return {r.archivo.rsplit("_present_", 1)[-1]: (r.estado, r.filas, r.columnas_faltantes) for r in df.collect()}


def _months(spark, lake):
    rows = read_flights(spark, flights_path(lake)).groupBy("Year", "Month").count().collect()
    return {(r.Year, r.Month): r["count"] for r in rows}


def test_outcomes(spark, landed, tmp_path):
    lake = str(tmp_path / "lake")
    report = _report(ingest(spark, str(landed), lake))
    assert report["2023_1.zip"][:2] == ("convertido", 3)
    assert report["2023_2.zip"][:2] == ("convertido", 1)
    assert report["2023_3.zip"][0] == "zip_corrupto"
    assert report["2023_4.zip"] == ("esquema_incompleto", None, sorted(set(REQUIRED) - {"Year", "Month", "Origin"}))
    assert _months(spark, lake) == {(2023, 1): 3, (2023, 2): 1}


def test_declared_types(spark, landed, tmp_path):
    lake = str(tmp_path / "lake")
    ingest(spark, str(landed), lake)
    rows = one_month(read_flights(spark, flights_path(lake)), 2023, 1).collect()
    assert sorted((r.TaxiOut is None, r.Flight_Number_Reporting_Airline is None) for r in rows) == [
        (False, False), (True, False), (True, True)]
    assert {(r.CRSDepTime, r.Div3Airport, r.OriginCityName, r.TaxiIn) for r in rows} == {(930, None, "Atlanta, GA", 6.0)}


def test_second_run_skips_and_adds_only_the_new_month(spark, landed, tmp_path):
    lake = str(tmp_path / "lake")
    ingest(spark, str(landed), lake)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "lake" / "vuelos").rglob("*.parquet")}
    _archive(landed, 2023, 5, [_row(2023, 5)])
    report = _report(ingest(spark, str(landed), lake))
    assert report["2023_1.zip"][0] == report["2023_2.zip"][0] == "omitido"
    assert report["2023_3.zip"][0] == "zip_corrupto"
    assert report["2023_5.zip"][:2] == ("convertido", 1)
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "lake" / "vuelos").rglob("*.parquet")}
    assert before.items() <= after.items()


def test_bad_archive_keeps_the_stored_month(spark, landed, tmp_path):
    lake = str(tmp_path / "lake")
    ingest(spark, str(landed), lake)
    other = tmp_path / "later"
    other.mkdir()
    (other / _name(2023, 1)).write_bytes(b"broken")
    assert _report(ingest(spark, str(other), lake))["2023_1.zip"][0] == "omitido"
    assert _months(spark, lake)[(2023, 1)] == 3


def test_damage_in_the_middle_is_found(spark, landed, tmp_path):
    path = landed / _name(2023, 2)
    _archive(landed, 2023, 2, [_row(2023, 2, number=str(i)) for i in range(3000)])
    data = bytearray(path.read_bytes())
    data[len(data) // 2] ^= 0xFF
    path.write_bytes(bytes(data))
    report = _report(ingest(spark, str(landed), str(tmp_path / "lake")))
    assert report["2023_2.zip"][0] == "zip_corrupto"


def test_two_archives_of_one_month_are_not_added_up(spark, landed, tmp_path):
    _archive(landed, 2023, 1, [_row(2023, 1)] * 9, name="copy_2023_1.zip")
    lake = str(tmp_path / "lake")
    states = sorted(r.estado for r in ingest(spark, str(landed), lake).collect() if r.anio == 2023 and r.mes == 1)
    assert states == ["convertido", "omitido"]
    assert _months(spark, lake)[(2023, 1)] == 3


def test_a_row_of_another_month_cannot_replace_that_month(spark, landed, tmp_path):
    _archive(landed, 2023, 2, [_row(2023, 2), _row(2023, 1)])
    lake = str(tmp_path / "lake")
    ingest(spark, str(landed), lake)
    assert _months(spark, lake) == {(2023, 1): 3, (2023, 2): 2}


def test_name_without_month(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    _archive(folder, 2023, 1, [_row(2023, 1)], name="flights.zip")
    assert [r.estado for r in ingest(spark, str(folder), str(tmp_path / "lake")).collect()] == ["nombre_invalido"]


def test_stream_converts_each_archive_once(spark, landed, tmp_path):
    lake, checkpoint = str(tmp_path / "lake"), str(tmp_path / "checkpoint")

    def run():
        query = start_ingest(spark, str(landed), lake, checkpoint)
        query.awaitTermination(120)
        assert query.exception() is None

    run()
    assert _months(spark, lake) == {(2023, 1): 3, (2023, 2): 1}
    _archive(landed, 2023, 5, [_row(2023, 5)])
    run()
    assert _months(spark, lake) == {(2023, 1): 3, (2023, 2): 1, (2023, 5): 1}


def test_a_repeated_run_has_the_same_outcome(spark, landed, tmp_path):
    lake, paths = str(tmp_path / "lake"), list_archives(spark, str(landed))
    first, again = (_report(convert(paths, lake, "flujo-0")) for _ in range(2))
    assert first == again and first["2023_1.zip"][:2] == ("convertido", 3)
    assert _months(spark, lake) == {(2023, 1): 3, (2023, 2): 1}
    assert {state for state, _, _ in _report(convert(paths, lake, "flujo-1")).values()} == {
        "omitido", "zip_corrupto", "esquema_incompleto"}


def test_volume(spark, landed):
    files = sorted(landed.glob("*.zip"))
    listed = file_volume(spark, str(landed)).first()
    assert (listed.archivos, listed.bytes) == (4, sum(f.stat().st_size for f in files))
    sizes = archive_sizes(list_archives(spark, str(landed)))
    total = input_volume(sizes).first()
    expected = sum(i.file_size for f in files if zipfile.is_zipfile(f)
                   for i in zipfile.ZipFile(f).infolist() if i.filename.endswith(".csv"))
    assert (total.bytes_zip, total.bytes_csv, total.cumple_minimo) == (listed.bytes, expected, False)
    assert input_volume(sizes, expected / 1e9).first().cumple_minimo


def test_flow_publishes_over_the_whole_lake(spark, landed, tmp_path):
    weather_file = tmp_path / "weather.csv"
    weather_file.write_text("Origin,Fecha,precipitacion_mm,nieve_cm,viento_max_kmh,temp_media_c\n"
                            "ATL,2023-01-01,0.0,2.0,10.0,1.0\n")
    out = str(tmp_path / "out")
    result = run_flow(spark, str(landed), str(tmp_path / "lake"), read_weather_csv(spark, str(weather_file)),
                      out, replace(Params(), ranking_floor=0), fuel_low=3.0)
    assert result["quality"].first().filas == 4
    tables = read_published(spark, out)
    assert len(tables) == len(result["published"]) == 7
    year = tables["resumen_global"].first()
    # Two flights with both times: (15 + 6) minutes each; rates 3 and 12 kg a minute.
    assert (year.anio, year.vuelos) == (2023, 2)
    assert (year.co2_t_bajo, year.co2_t_alto) == (0.398, 1.593)
    assert [tuple(r) for r in tables["rodaje_clima"].collect()] == [("nieve", 1, 15.0)]


def test_jobs_from_the_command_line(spark, landed, tmp_path):
    weather = tmp_path / "weather.csv"
    weather.write_text("Origin,Fecha,precipitacion_mm,nieve_cm,viento_max_kmh,temp_media_c\nATL,2023-01-01,9,0,1,1\n")
    lake, out = str(tmp_path / "lake"), str(tmp_path / "out")
    assert run(spark, ["ingest", "--archives", str(landed), "--lake", lake]).count() == 4
    where = ["--lake", lake, "--weather", str(weather)]
    assert len(run(spark, ["publish", *where, "--out", out, "--format", "csv"])) == 7
    assert len(run(spark, ["audit", *where, "--out", f"{out}/audit", "--format", "csv"])) == 20
    verdicts = run(spark, ["check", "--out", out, "--format", "csv"]).collect()
    assert [v.tabla for v in verdicts if not v.ok] == []
    assert run(spark, ["verify", "--lake", lake, "--out", out, "--format", "csv"]).count() == 13
    with pytest.raises(VerificationError, match="co2_t_bajo"):
        run(spark, ["verify", "--lake", lake, "--out", out, "--format", "csv", "--fuel-low", "600"])
    assert run(spark, ["stream", "--archives", str(landed), "--lake", lake, "--checkpoint", str(tmp_path / "c")]) is None
    with pytest.raises(SystemExit):
        run(spark, ["publish", "--lake", lake])
