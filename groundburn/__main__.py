"""The jobs, for spark-submit or ``python -m groundburn``."""

from __future__ import annotations

import argparse
import dataclasses
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundburn.functions.intermediate import release_all
from groundburn.operators.contracts import contract_check
from groundburn.params import Params
from groundburn.plans.audit import audit
from groundburn.plans.ingest import gate, ingest, run_flow
from groundburn.plans.publish import lake_tables, publish, read_figures, verify_published
from groundburn.plans.weather import NEW_FIRST, STORED_FIRST, merge_weather, read_weather
from groundburn.session import REQUIRED_CONF
from groundburn.sinks.lake import flights_path
from groundburn.sinks.store import load_store
from groundburn.sinks.tables import read_published, roll_back, stored_published
from groundburn.sources.archives import archive_sizes, input_volume, list_archives
from groundburn.sources.flights import read_flights
from groundburn.streaming.ingest import start_ingest

#: Help of each parameter that can be given as an option.
_PARAMETERS = {
    "fuel_low": "kg of fuel per taxi minute, low scenario",
    "fuel_high": "kg of fuel per taxi minute, high scenario",
    "co2_factor": "kg of CO2 per kg of fuel",
    "taxi_cap": "longest taxi time, minutes, that is added up",
    "years": "years the data should cover",
    "months": "months of a year the data should cover",
    "heavy_rain_mm": "rain of a day that counts as heavy",
    "strong_wind_kmh": "wind that counts as strong",
    "ranking_floor": "flights an airport must exceed to be ranked",
    "route_floor": "flights a route must exceed to be ranked",
    "cut_share": "share of taxi time that the first scenario cuts",
    "excess_quantile": "quantile above which a taxi time is excessive",
}


def _arguments(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="groundburn", description="Ground-taxi emissions jobs")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, text: str, *needed: str, parameters: bool = False, formats: bool = False) -> argparse.ArgumentParser:
        one = jobs.add_parser(name, help=text)
        for option in needed:
            one.add_argument(f"--{option}", required=True)
        if formats:
            one.add_argument("--format", choices=("parquet", "csv"), default="parquet")
        if parameters:
            for field in dataclasses.fields(Params):
                several = isinstance(field.default, tuple)
                one.add_argument(
                    f"--{field.name.replace('_', '-')}", type=int if several else type(field.default),
                    nargs="+" if several else None, help=_PARAMETERS[field.name])
        return one

    def verified(one: argparse.ArgumentParser) -> None:
        one.add_argument("--verify", action="store_true", help="publish only what agrees with the flights")
        one.add_argument("--figures", help="JSON file of known figures and ranking that must agree too")

    job("ingest", "archives of months not yet in the lake", "archives", "lake")
    job("stream", "the same, remembering archives in a checkpoint", "archives", "lake", "checkpoint")
    verified(job("flow", "ingest, then the published tables", "archives", "lake", "weather", "out", parameters=True, formats=True))
    verified(job("publish", "the published tables", "lake", "weather", "out", parameters=True, formats=True))
    job("audit", "the audit tables", "lake", "weather", "out", parameters=True, formats=True)
    job("verify", "published figures against the flights", "lake", "out", parameters=True, formats=True).add_argument(
        "--figures", help="JSON file of known figures and ranking to hold them against too")
    job("check", "published tables against their contract", "out", formats=True)
    job("rollback", "the tables of one publication ago", "out")
    job("weather", "newly saved answers into the weather table", "answers", "table").add_argument(
        "--first", choices=(STORED_FIRST, NEW_FIRST), default=STORED_FIRST, help="whose row of an airport and day stays")
    load = job("load", "published tables into a SQL store", "out", "url", formats=True)
    load.add_argument("--property", action="append", default=[], metavar="KEY=VALUE", help="of the connection")
    job("volume", "size of the archives", "archives").add_argument("--minimum-gb", type=float, default=1.5)
    a = parser.parse_args(argv)
    if getattr(a, "figures", None) and a.job in ("flow", "publish") and not a.verify:
        parser.error("--figures needs --verify")
    if any("=" not in p for p in getattr(a, "property", [])):
        parser.error("--property takes KEY=VALUE")
    return a


def _params(a: argparse.Namespace) -> Params:
    given = {f.name: getattr(a, f.name, None) for f in dataclasses.fields(Params)}
    return dataclasses.replace(
        Params(), **{name: tuple(v) if isinstance(v, list) else v for name, v in given.items() if v is not None})


def run(spark: SparkSession, argv: list[str]) -> DataFrame | list[str] | None:
    """Run one job; what it reports."""
    a = _arguments(argv)
    p = _params(a)
    known = read_figures(spark, a.figures) if getattr(a, "figures", None) else None
    match a.job:
        case "ingest":
            return ingest(spark, a.archives, a.lake)
        case "stream":
            start_ingest(spark, a.archives, a.lake, a.checkpoint).awaitTermination()
            return None
        case "volume":
            return input_volume(archive_sizes(list_archives(spark, a.archives)), a.minimum_gb)
        case "weather":
            return merge_weather(spark, a.answers, a.table, a.first)
        case "check":
            return contract_check(spark, stored_published(spark, a.out, a.format), a.format == "csv")
        case "rollback":
            return roll_back(spark, a.out)
        case "load":
            tables = read_published(spark, a.out, a.format)
            load_store(tables, a.url, dict(pair.split("=", 1) for pair in a.property))
            return sorted(tables)
        case "flow":
            return run_flow(spark, a.archives, a.lake, read_weather(spark, a.weather), a.out, p,
                            file_format=a.format, verify=a.verify, known=known)["report"]
    flights = read_flights(spark, flights_path(a.lake))
    if a.job == "verify":
        return verify_published(flights, read_published(spark, a.out, a.format), p, known)
    weather = read_weather(spark, a.weather)
    if a.job == "audit":
        return audit(flights, weather, p, a.out, a.format)
    check = gate(spark, a.lake, p, known) if a.verify else None
    return publish(lake_tables(spark, a.lake, weather, p), a.out, a.format, check)


def failed(report: DataFrame | list[str] | None) -> bool:
    """Whether a report has a verdict that is not good."""
    return isinstance(report, DataFrame) and "ok" in report.columns and not report.where(~F.col("ok")).isEmpty()


def main() -> int:
    builder = SparkSession.builder.appName("groundburn")
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    try:
        report = run(spark, sys.argv[1:])
        if isinstance(report, DataFrame):
            for row in report.toLocalIterator():  # one row per archive, table or figure
                print(", ".join(f"{k}={v}" for k, v in row.asDict().items()))
        elif report:
            print("\n".join(report))
        return int(failed(report))
    finally:
        release_all(spark)


if __name__ == "__main__":
    sys.exit(main())
