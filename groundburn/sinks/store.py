"""Result tables to a SQL store over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, DataFrameWriter

from groundburn.operators.contracts import to_contract


def jdbc_writer(name: str, table: DataFrame, url: str, properties: Mapping[str, str]) -> DataFrameWriter:
    """Writer that replaces one table with the contract's columns.

    The store's dialect maps the contract types to its own column types.
    """
    return (
        to_contract(name, table).write.format("jdbc").mode("overwrite")
        .option("url", url).option("dbtable", name).options(**properties)
    )


def load_store(tables: Mapping[str, DataFrame], url: str, properties: Mapping[str, str]) -> None:
    """Replace every table. Each replacement is its own transaction."""
    for name, table in tables.items():
        jdbc_writer(name, table, url, properties).save()
