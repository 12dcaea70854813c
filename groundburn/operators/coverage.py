"""Audit: calendar coverage, schema, nulls and duplicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundburn.functions.calendar import flight_date
from groundburn.functions.joins import join_sized
from groundburn.functions.numeric import share, tally
from groundburn.params import Params
from groundburn.schema import CRITICAL, DELAY_COLUMNS, FLIGHT_KEY

#: Columns counted at a time. Beyond 100 Spark reads Parquet row by row.
_CHUNK = 56
#: Relative error of a sketch of distinct keys, and the share of repeated rows up to which keys count as unique.
SKETCH_ERROR, MOST_REPEATS = 0.02, 0.1

# SQL names of the column types.
_SQL_NAMES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
              "date": "DATE", "boolean": "BOOLEAN"}


def date_counts(flights: DataFrame, key: Sequence[str] = FLIGHT_KEY) -> DataFrame:
    """Per month and date: rows, and about how many distinct keys. A key holds
    its date, so the numbers of keys add up over the dates."""
    return flights.groupBy(F.col("Year").alias("anio"), F.col("Month").alias("mes"), "FlightDate").agg(
        F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64(*key), SKETCH_ERROR).alias("claves"))


def month_coverage(flights: DataFrame) -> DataFrame:
    """Per month: rows, distinct dates, rows dated outside their partition."""
    return month_coverage_from(flights.groupBy(
        F.col("Year").alias("anio"), F.col("Month").alias("mes"), "FlightDate").agg(F.count(F.lit(1)).alias("n")))


def month_coverage_from(dates: DataFrame) -> DataFrame:
    """:func:`month_coverage` from rows per month and date, so that counting
    distinct dates needs no set per month."""
    day = flight_date()
    elsewhere = (F.col("anio") != F.year(day)) | (F.col("mes") != F.month(day))
    return dates.groupBy("anio", "mes").agg(
        F.sum("n").alias("filas"),
        F.count("FlightDate").alias("fechas_distintas"),
        tally(elsewhere, F.col("n")).alias("fechas_fuera_de_particion"),
    ).orderBy(F.asc_nulls_last("anio"), F.asc_nulls_last("mes"))


def expected_months(like: DataFrame, p: Params) -> DataFrame:
    """The calendar the data should cover, in the session of ``like``."""
    spark, per_year = like.sparkSession, len(p.months)
    place = F.col("id").cast("int")
    return spark.range(len(p.years) * per_year, numPartitions=1).select(
        F.get(F.array(*map(F.lit, p.years)), F.floor(place / per_year).cast("int")).cast("long").alias("anio"),
        F.get(F.array(*map(F.lit, p.months)), place % per_year).cast("long").alias("mes"),
    )


def calendar_differences(flights: DataFrame, p: Params) -> DataFrame:
    """Months expected but absent (``falta``) and present but unexpected (``sobra``)."""
    observed = flights.select(F.col("Year").alias("anio"), F.col("Month").alias("mes")).distinct()
    expected = expected_months(flights, p)
    keys = ["anio", "mes"]
    return (
        expected.join(observed, keys, "left_anti").withColumn("diferencia", F.lit("falta"))
        .unionByName(observed.join(expected, keys, "left_anti").withColumn("diferencia", F.lit("sobra")))
        .orderBy("diferencia", F.asc_nulls_last("anio"), F.asc_nulls_last("mes"))
    )


def coverage_summary(coverage: DataFrame, p: Params) -> DataFrame:
    """One row: totals, months seen and expected, and the differences as text.

    Takes :func:`month_coverage`. Its rows and the expected months are stacked
    and matched by grouping.
    """
    keys = ["anio", "mes"]
    seen = coverage.withColumn("esperado", F.lit(False))
    wanted = expected_months(coverage, p).withColumn("esperado", F.lit(True))
    months = seen.unionByName(wanted, allowMissingColumns=True).groupBy(*keys).agg(
        F.sum("filas").alias("filas"),
        F.sum("fechas_fuera_de_particion").alias("fuera"),
        F.bool_or("esperado").alias("esperado"),
    )
    observed = F.col("filas").isNotNull()
    name = F.format_string("%d-%02d", "anio", "mes")

    def listed(condition):
        return F.array_join(F.sort_array(F.collect_list(F.when(condition, name))), ",")

    return months.agg(
        F.coalesce(F.sum("filas"), F.lit(0)).alias("filas_total"),
        F.count_if(observed).alias("meses_observados"),
        F.count_if("esperado").alias("meses_esperados"),
        listed(~observed).alias("meses_faltantes"),
        listed(~F.col("esperado")).alias("meses_fuera_rango"),
        F.coalesce(F.sum("fuera"), F.lit(0)).alias("fechas_fuera_de_particion"),
    )


def run_summary(coverage: DataFrame, p: Params) -> DataFrame:
    """Row total and whether exactly the expected months are present."""
    return coverage_summary(coverage, p).select(
        "filas_total",
        ((F.col("meses_observados") == F.col("meses_esperados"))
         & (F.col("meses_faltantes") == "")).alias("meses_ok"),
    )


def _null_counts(flights: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and non-nulls of each column: columna, filas, no_nulos.

    A few columns are counted at a time, because code is generated only for
    aggregates of moderate width. Each column is still read once.
    """
    def some(chunk: Sequence[str]) -> DataFrame:
        counts = flights.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in chunk])
        return counts.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("columna"), F.col("_n").alias("filas"), F.col(c).alias("no_nulos"))
            for c in chunk
        ])))

    chunks = [columns[i:i + _CHUNK] for i in range(0, len(columns), _CHUNK)]
    return reduce(DataFrame.unionByName, map(some, chunks))


def schema_profile(flights: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Type, nulls and non-nulls of each column (all of them by default)."""
    types = {f.name: f.dataType.simpleString() for f in flights.schema.fields}
    chosen = list(types) if columns is None else [c for c in columns if c in types]
    type_of = F.create_map(*[F.lit(x) for c in chosen for x in (c, _SQL_NAMES.get(types[c], types[c].upper()))])
    return _null_counts(flights, chosen).select(
        "columna", type_of[F.col("columna")].alias("tipo"), F.lit(True).alias("presente"),
        (F.col("filas") - F.col("no_nulos")).alias("nulos"), "no_nulos",
    )


def critical_nulls(profile: DataFrame, columns: Sequence[str] = CRITICAL) -> DataFrame:
    """The critical columns of a profile; one the table lacks is absent, with NULL counts."""
    wanted = profile.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, columns))).alias("columna"))
    return wanted.join(profile, "columna", "left").withColumn("presente", F.coalesce("presente", F.lit(False)))


def null_profile(flights: DataFrame, columns: Sequence[str] = CRITICAL) -> DataFrame:
    """Nulls of the critical columns, reading no others."""
    return critical_nulls(schema_profile(flights, columns), columns)


def null_share(flights: DataFrame, columns: Sequence[str] = DELAY_COLUMNS) -> DataFrame:
    """Nulls of each column and their share of all rows."""
    nulls = F.col("filas") - F.col("no_nulos")
    return _null_counts(flights, columns).select(
        "columna", nulls.alias("nulos"), share(nulls, F.col("filas")).alias("pct_nulos"))


def mostly_unique(flights: DataFrame, key: Sequence[str] = FLIGHT_KEY) -> bool:
    """Whether nearly every row has a key of its own, by one scan that merges
    sketches of the keys' hashes. Runs a job."""
    found = flights.agg(
        F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64(*_alike(flights, key)), SKETCH_ERROR).alias("claves")).first()
    return few_repeats(found["n"], found["claves"])


def few_repeats(rows: int, keys: int) -> bool:
    return keys >= (1 - MOST_REPEATS) * rows


def _alike(flights: DataFrame, key: Sequence[str]) -> list[Column]:
    """Equal keys must hash alike: grouping takes -0.0 and 0.0 for the same number."""
    kinds = dict(flights.select(*key).dtypes)
    return [F.col(c) + F.lit(0.0) if kinds[c] in ("double", "float") else F.col(c) for c in key]


def key_counts(flights: DataFrame, key: Sequence[str] = FLIGHT_KEY) -> DataFrame:
    """Rows of each key; copies collapse before the one shuffle."""
    return flights.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))


def repeated_keys(flights: DataFrame, key: Sequence[str] = FLIGHT_KEY, unique: bool | None = None) -> DataFrame:
    """Keys held by more than one row, and how many hold them; NULLs are equal.

    Where nearly all keys are unique, whole keys are not shuffled: rows are
    first counted under a 64-bit hash, and only those sharing a hash are grouped
    by the key itself, which also settles accidental collisions. Where many
    repeat, that would shuffle most rows twice, and they are grouped at once.
    ``unique`` tells which; it is measured if not given (:func:`mostly_unique`).
    """
    if not (mostly_unique(flights, key) if unique is None else unique):
        return key_counts(flights, key).where(F.col("n") > 1)
    hashed = flights.select(*key, F.xxhash64(*_alike(flights, key)).alias("_h"))
    # Dealt out first: hardly any would collapse before the shuffle, only fill the tasks' memory.
    shared = hashed.select("_h").repartition("_h").groupBy("_h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("_h")
    return key_counts(join_sized(hashed, shared, ["_h"], "left_semi"), key).where(F.col("n") > 1)


def duplicates(flights: DataFrame, key: Sequence[str] = FLIGHT_KEY) -> DataFrame:
    """Groups under a key, and those holding more than one row.

    One scan and one shuffle where many rows share their key, else from
    :func:`repeated_keys`; measured by :func:`mostly_unique`.
    """
    if mostly_unique(flights, key):
        return duplicate_summary(flights.agg(F.count(F.lit(1)).alias("n")), repeated_keys(flights, key, True))
    n, several = F.col("n"), F.col("n") > 1
    return key_counts(flights, key).agg(
        F.count(F.lit(1)).alias("grupos"),
        F.sum(n).alias("filas_cubiertas"),
        tally(several).alias("grupos_duplicados"),
        tally(several, n).alias("filas_en_grupos_duplicados"),
        F.max(n).alias("max_repeticiones"),
    )


def duplicate_summary(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """:func:`duplicates` from the number of rows, added up over column ``n``,
    and :func:`repeated_keys`: every row outside those is a group of its own."""
    total = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    totals = repeated.agg(
        F.count(F.lit(1)).alias("grupos"), F.coalesce(F.sum("n"), F.lit(0)).alias("filas"), F.max("n").alias("mayor"),
    ).withColumn("total", total)
    some = F.col("total") > 0
    return totals.select(
        (F.col("total") - F.col("filas") + F.col("grupos")).alias("grupos"),
        F.when(some, F.col("total")).alias("filas_cubiertas"),
        F.when(some, F.col("grupos")).alias("grupos_duplicados"),
        F.when(some, F.col("filas")).alias("filas_en_grupos_duplicados"),
        F.when(some, F.coalesce(F.col("mayor"), F.lit(1))).alias("max_repeticiones"),
    )


def duplicate_examples(repeated: DataFrame, key: Sequence[str] = FLIGHT_KEY, top: int = 20) -> DataFrame:
    """The most repeated keys."""
    return repeated.orderBy(F.desc("n"), *[F.asc_nulls_last(c) for c in key]).limit(top)
