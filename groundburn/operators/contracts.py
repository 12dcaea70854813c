"""Checks on published tables: shape, types, keys, sizes."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundburn.schema import CONTRACTS, KEYS, STORED


def _columns(names) -> str:
    return ",".join(sorted(names))


def unreadable(column: str, kind: str) -> Column:
    """Text that is no value of a type."""
    return F.col(f"`{column}`").isNotNull() & F.expr(f"try_cast(`{column}` AS {kind}) IS NULL")


def _check_one(name: str, table: DataFrame, as_text: bool) -> DataFrame:
    expected = {f.name: f.dataType.simpleString() for f in CONTRACTS[name]}
    actual = {f.name: f.dataType.simpleString() for f in table.schema}
    extra, missing = (set(actual) - set(expected), set(expected) - set(actual)) if expected else (set(), set())
    other = {c: kind for c, kind in expected.items() if c in actual and actual[c] != kind}
    # Text files have no types: there each value must be readable as its own.
    declared = {f.name: f.dataType.simpleString() for f in STORED[name]}
    texts = {c: kind for c, kind in declared.items() if as_text and actual.get(c) == "string" and kind != "string"}
    wrong = _columns(f"{c}:{actual[c]}" for c in other if c not in texts)
    cannot = reduce(lambda a, b: a + b, [unreadable(c, k).cast("long") for c, k in texts.items()], F.lit(0).cast("long"))

    key = [k for k in KEYS[name] if k in actual]
    whole = len(key) == len(KEYS[name])
    counted = table.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.sum(cannot).alias("ilegibles"))
    a_null = reduce(lambda x, y: x | y, [F.col(k).isNull() for k in key], F.lit(False))

    def of_key(total: Column) -> Column:
        """Nothing can be said of a key that is not all there."""
        return F.coalesce(total, F.lit(0)) if whole else F.lit(None).cast("long")

    return counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("filas"),
        of_key(F.sum((F.col("n") > 1).cast("long"))).alias("claves_repetidas"),
        of_key(F.sum(a_null.cast("long") * F.col("n"))).alias("claves_nulas"),
        F.coalesce(F.sum("ilegibles"), F.lit(0)).alias("ilegibles"),
    ).select(
        F.lit(name).alias("tabla"),
        F.lit(True).alias("presente"),
        "filas",
        F.lit(_columns(extra)).alias("sobran"),
        F.lit(_columns(missing)).alias("faltan"),
        F.lit(wrong).alias("tipos"),
        "ilegibles",
        "claves_repetidas",
        "claves_nulas",
        (F.lit(whole and not extra and not missing and not wrong) & (F.col("ilegibles") == 0)
         & (F.coalesce("claves_repetidas", F.lit(1)) == 0) & (F.coalesce("claves_nulas", F.lit(1)) == 0)).alias("ok"),
    )


def _absent(spark: SparkSession, name: str) -> DataFrame:
    nothing = F.lit(None).cast("long")
    return spark.range(1).select(
        F.lit(name).alias("tabla"), F.lit(False).alias("presente"), nothing.alias("filas"),
        F.lit("").alias("sobran"), F.lit(_columns(CONTRACTS[name].names)).alias("faltan"), F.lit("").alias("tipos"),
        nothing.alias("ilegibles"), nothing.alias("claves_repetidas"), nothing.alias("claves_nulas"), F.lit(False).alias("ok"),
    )


def contract_check(spark: SparkSession, tables: Mapping[str, DataFrame], as_text: bool = False) -> DataFrame:
    """One verdict per contracted table; a table that is not there fails.

    ``tables`` are as stored. A column of another type than the contract's
    fails; with ``as_text``, for text files, a column of text passes if all its
    values can be read.
    """
    checks = [
        _check_one(name, tables[name], as_text) if name in tables else _absent(spark, name)
        for name in CONTRACTS
    ]
    return reduce(DataFrame.unionByName, checks)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of every published table."""
    counts = [
        table.agg(F.count(F.lit(1)).alias("filas")).select(F.lit(name).alias("tabla"), "filas")
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def to_contract(name: str, table: DataFrame) -> DataFrame:
    """Contract columns in contract order and type."""
    contract = CONTRACTS[name]
    if not contract.fields:
        return table
    return table.select(*[F.col(f.name).cast(f.dataType) for f in contract])
