"""Flight legs and weather derived from an order/line-item star schema.

Lets every query run on general test tables: a line item becomes a flight leg,
the supplier's nation its origin and the customer's nation its destination.
Only whole numbers are used, so results are exact on any engine.

The side tables are joined to each other first and the line items last, so the
large table is moved as seldom as possible, and as narrow: what a line item
tells by itself is worked out before it moves. A side is broadcast when the files
behind it are small; otherwise it is an ordinary equi-join, which Spark
shuffles and whose skewed keys it splits.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundburn.functions.files import path_bytes
from groundburn.functions.joins import BROADCAST_BYTES
from groundburn.params import Params

#: Thresholds scaled to the test tables.
STAR_PARAMS = replace(
    Params(), years=tuple(range(1995, 2002)), ranking_floor=2_000, route_floor=100,
)

#: Columns used from each table; naming them spares Spark a look into the files.
_SCHEMAS = {
    "nation": "n_nationkey int, n_name string",
    "supplier": "s_suppkey long, s_nationkey int",
    "customer": "c_custkey long, c_nationkey int",
    "orders": "o_orderkey long, o_custkey long",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


_CANCELLED = "(l_orderkey + l_partkey) % 73 = 0"
_DIVERTED = "l_orderkey % 97 = 1"
_DELAY = "l_partkey % 120 - 55 + l_quantity"

#: What a line item alone tells of its leg. It is worked out before the orders are
#: joined, so that a query moves the few values it uses and not what they come from.
_LINE = (
    "l_orderkey",
    "CAST(l_shipdate AS DATE) AS day",
    "concat(l_returnflag, l_linestatus) AS Reporting_Airline",
    "l_partkey",
    "Origin",
    "if((l_orderkey * 31 + l_partkey) % 499 = 0, 2400L, "
    "((l_orderkey * 7 + l_linenumber * 5) % 24) * 100 + (l_partkey * 13) % 60) AS CRSDepTime",
    f"CASE WHEN {_CANCELLED} THEN NULL WHEN (l_partkey * 3 + l_suppkey) % 97 = 0 AND l_quantity > 40 "
    "THEN 181 + l_quantity ELSE 5 + l_quantity END AS TaxiOut",
    f"CASE WHEN {_CANCELLED} OR l_partkey % 211 = 0 THEN NULL WHEN l_orderkey % 887 = 0 "
    "THEN 181 + l_quantity ELSE CAST(2 + (l_suppkey * 7 + l_linenumber) % 20 AS DOUBLE) END AS TaxiIn",
    f"if({_CANCELLED}, 1D, 0D) AS Cancelled",
    f"if({_DIVERTED}, if(l_partkey % 10 <> 0, 1D, 0D), NULL) AS DivReachedDest",
    f"if({_CANCELLED}, NULL, {_DELAY}) AS ArrDelay",
    f"if({_CANCELLED}, NULL, if({_DELAY} >= 15, 1D, 0D)) AS ArrDel15",
)

#: A flight leg from those and the joined names.
_LEG = (
    "CAST(day AS STRING) AS FlightDate",
    "CAST(year(day) AS BIGINT) AS Year",
    "CAST(month(day) AS BIGINT) AS Month",
    "CAST(weekday(day) + 1 AS BIGINT) AS DayOfWeek",
    "Reporting_Airline",
    "l_partkey AS Flight_Number_Reporting_Airline",
    "Origin",
    "Dest",
    "CRSDepTime",
    "TaxiOut",
    "TaxiIn",
    "Cancelled",
    f"if({_DIVERTED}, 1D, 0D) AS Diverted",
    "DivReachedDest",
    f"if({_DIVERTED}, alternate_name, NULL) AS Div1Airport",
    f"if({_CANCELLED}, NULL, CAST(l_partkey % 120 - 30 AS DOUBLE)) AS DepDelay",
    "ArrDelay",
    "ArrDel15",
    "CAST(100 + (l_partkey * 37) % 2500 AS DOUBLE) AS Distance",
)


def _side(spark: SparkSession, sf_dir: str, df: DataFrame, *tables: str) -> DataFrame:
    """``df`` with a broadcast hint if every table it was built from is small."""
    sizes = [path_bytes(spark, f"{sf_dir}/{name}.parquet") for name in tables]
    return F.broadcast(df) if max(sizes) <= BROADCAST_BYTES else df


def star_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flight leg per line item."""
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    def named(key: str, name: str) -> DataFrame:
        return _side(spark, sf_dir, nation.select(F.col("n_nationkey").alias(key), F.col("n_name").alias(name)), "nation")

    suppliers = (
        _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
        .join(named("s_nationkey", "Origin"), "s_nationkey")
    )
    destinations = (
        nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("Dest"))
        .withColumn("alternate", (F.col("c_nationkey") + 1) % 25)
        .join(named("alternate", "alternate_name"), "alternate")
    )
    customers = (
        _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
        .join(_side(spark, sf_dir, destinations, "nation"), "c_nationkey")
    )
    orders = (
        _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        .join(_side(spark, sf_dir, customers, "customer", "nation"), "o_custkey")
    )
    legs = (
        _table(spark, sf_dir, "lineitem")
        .join(_side(spark, sf_dir, suppliers, "supplier", "nation"), "l_suppkey").selectExpr(*_LINE)
        .join(_side(spark, sf_dir, orders, "orders", "customer", "nation"), "l_orderkey")
    )

    return legs.selectExpr(*_LEG)


def _with_measures(days: DataFrame, *more: str) -> DataFrame:
    """Weather of a (n_nationkey, Origin, fecha) row, keeping the columns in ``more``."""
    key = F.col("n_nationkey")
    elapsed = F.datediff("fecha", F.lit("1995-01-01").cast("date"))

    def whole(x: Column) -> Column:
        return x.cast("double")

    return days.select(
        "Origin",
        F.col("fecha").cast("string").alias("Fecha"),
        F.when((key * 7 + elapsed * 3) % 4 == 0, whole((key * 5 + elapsed * 11) % 17))
        .otherwise(0.0).alias("precipitacion_mm"),
        F.when((key + elapsed) % 29 == 0, whole(elapsed % 5 + 1)).otherwise(0.0).alias("nieve_cm"),
        whole((key * 13 + elapsed * 7) % 45 + 5).alias("viento_max_kmh"),
        whole(elapsed % 35 - 5).alias("temp_media_c"),
        *more,
    )


def star_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather of every nation on every ship date but each nation's one in thirteen."""
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("Origin"))
    dates = (
        _table(spark, sf_dir, "lineitem")
        .select(F.col("l_shipdate").cast("date").alias("fecha")).distinct()
    )
    last = nation.agg(F.max("n_nationkey")).scalar()
    keyed = dates.withColumn("n_nationkey", F.explode(F.sequence(F.lit(0), last)))
    elapsed = F.datediff("fecha", F.lit("1995-01-01").cast("date"))
    keyed = keyed.where((F.col("n_nationkey") * 5 + elapsed) % 13 != 0)
    return _with_measures(keyed.join(_side(spark, sf_dir, nation, "nation"), "n_nationkey"))


def star_weather_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather reported once per line item, so most days come many times.

    ``informe`` orders the reports of a day; the temperature differs between them.
    """
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("Origin"))
    supplier = _table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))
    reports = (
        _table(spark, sf_dir, "lineitem")
        .select("l_suppkey", F.col("l_shipdate").cast("date").alias("fecha"),
                (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("informe"))
        .join(_side(spark, sf_dir, supplier, "supplier"), "l_suppkey")
        .join(_side(spark, sf_dir, nation, "nation"), "n_nationkey")
    )
    return _with_measures(reports, "informe").withColumn(
        "temp_media_c", (F.col("informe") % 40).cast("double"))
