"""Intermediate tables: computed once, kept in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

from groundburn.functions.files import file_system

T = TypeVar("T")


def _shared_folder(spark: SparkSession) -> str | None:
    """Folder the cluster names for intermediate tables; a local master may use its own."""
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="groundburn-checkpoint-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def _application_folder(spark: SparkSession) -> str:
    folder = _shared_folder(spark)
    if folder is None:
        raise RuntimeError("intermediate tables need a shared folder: set spark.checkpoint.dir")
    return f"{folder}/{spark.sparkContext.applicationId}"


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the checkpoint folder and read it back.

    What was computed survives the loss of executors, is computed once, and
    its size is known to whatever joins it. A cluster without a shared folder is
    an error. Tables lie under the application's id until :func:`release_all`.
    """
    spark = df.sparkSession
    path = f"{_application_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def materialised(df: DataFrame) -> Iterator[DataFrame]:
    """:func:`materialise` for the length of a block; the table is removed at its end."""
    spark = df.sparkSession
    path = f"{_application_folder(spark)}/{uuid.uuid4().hex}"
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        fs, at = file_system(spark, path)
        fs.delete(at(path), True)


def release_all(spark: SparkSession) -> None:
    """Remove every intermediate table of this application; for jobs that have ended."""
    folder = _shared_folder(spark)
    if folder is not None:
        path = f"{folder}/{spark.sparkContext.applicationId}"
        fs, at = file_system(spark, path)
        fs.delete(at(path), True)


def for_each(
    tables: Mapping[str, DataFrame], action: Callable[[str, DataFrame], T], at_once: int = 4,
) -> dict[str, T]:
    """Run an action on every table, a few at a time, so that one table's last
    tasks overlap with the next one's first. The first failure is raised."""
    with ThreadPoolExecutor(at_once) as pool:
        running = {name: pool.submit(action, name, table) for name, table in tables.items()}
        return {name: job.result() for name, job in running.items()}


def materialise_all(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """:func:`materialise` for several tables at once."""
    return for_each(tables, lambda _, table: materialise(table))
