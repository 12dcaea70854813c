"""Result tables as files, published together by one pointer.

Every publication is a version of its own, ``_versions/<version>/<table>``,
never written again. The pointer, one small file, names the version of each
table; replacing it is a single step, so whatever fails before it leaves every
old table as it was, and what it pointed to before can be brought back. One
publisher at a time.
"""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from groundburn.functions.files import file_system, folders, path_exists, read_text, swap_text
from groundburn.functions.intermediate import for_each
from groundburn.schema import CONTRACTS, STORED

_POINTER, _VERSIONS = "_current.json", "_versions"


def _pointer(spark: SparkSession, folder: str) -> dict:
    """``tables``: version and format of each table; ``before``: the same, one publication ago."""
    text = read_text(spark, f"{folder}/{_POINTER}")
    return json.loads(text) if text else {"tables": {}, "before": {}}


def replace_tables(
    tables: Mapping[str, DataFrame], folder: str, file_format: str = "parquet",
    check: Callable[[dict[str, DataFrame]], None] | None = None,
) -> list[str]:
    """Compute every table, then publish them in one step; their folders.

    ``check`` is given the tables as they were written and raises to keep them
    from being published. Tables of the folder that are not given stay.
    """
    if not tables:
        return []
    spark = next(iter(tables.values())).sparkSession
    version = f"{datetime.datetime.now(datetime.UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    place = f"{folder}/{_VERSIONS}/{version}"

    def write(name: str, table: DataFrame) -> None:
        table.write.mode("errorifexists").format(file_format).option("header", True).save(f"{place}/{name}")

    try:
        for_each(tables, write)
        if check is not None:
            check({name: _load(spark, f"{place}/{name}", name, file_format) for name in tables})
        now = _pointer(spark, folder)
        new = {name: {"version": version, "format": file_format} for name in tables}
        swap_text(spark, f"{folder}/{_POINTER}", json.dumps({"tables": now["tables"] | new, "before": now["tables"]}, indent=1))
    except BaseException:
        if not any(t["version"] == version for t in _pointer(spark, folder)["tables"].values()):
            _delete(spark, place)
        raise
    _drop_unused(spark, folder, version)
    return [f"{place}/{name}" for name in tables]


def roll_back(spark: SparkSession, folder: str) -> list[str]:
    """Point to the tables of one publication ago, and keep the way back; their folders."""
    now = _pointer(spark, folder)
    if not now["before"]:
        raise ValueError(f"nothing was published in {folder} before the tables it has now")
    swap_text(spark, f"{folder}/{_POINTER}", json.dumps({"tables": now["before"], "before": now["tables"]}, indent=1))
    return [f"{folder}/{_VERSIONS}/{t['version']}/{name}" for name, t in now["before"].items()]


def _delete(spark: SparkSession, location: str) -> None:
    fs, path = file_system(spark, location)
    fs.delete(path(location), True)


def _drop_unused(spark: SparkSession, folder: str, newest: str) -> None:
    """Versions older than the newest that the pointer names nowhere."""
    now = _pointer(spark, folder)
    used = {t["version"] for kind in ("tables", "before") for t in now[kind].values()}
    for version in folders(spark, f"{folder}/{_VERSIONS}"):
        if version < newest and version not in used:
            _delete(spark, f"{folder}/{_VERSIONS}/{version}")


def _placed(spark: SparkSession, folder: str, name: str, file_format: str) -> tuple[str, str]:
    """Folder and format of a table; without a pointer, a plain folder of its name."""
    found = _pointer(spark, folder)["tables"].get(name)
    if found is None:
        return f"{folder}/{name}", file_format
    return f"{folder}/{_VERSIONS}/{found['version']}/{name}", found["format"]


def table_exists(spark: SparkSession, folder: str, name: str, file_format: str = "parquet") -> bool:
    return path_exists(spark, f"{_placed(spark, folder, name, file_format)[0]}/_SUCCESS")


def stored_table(spark: SparkSession, folder: str, name: str, file_format: str = "parquet") -> DataFrame:
    """A table as it lies there: CSV columns as text, Parquet columns with their own types."""
    location, file_format = _placed(spark, folder, name, file_format)
    return _raw(spark, location, file_format)


def _raw(spark: SparkSession, location: str, file_format: str) -> DataFrame:
    return spark.read.format(file_format).option("header", True).option("mode", "FAILFAST").load(location)


def _load(spark: SparkSession, location: str, name: str, file_format: str) -> DataFrame:
    table, declared = _raw(spark, location, file_format), STORED.get(name)
    if declared is None:
        return table
    kinds = {f.name: f.dataType.simpleString() for f in declared}
    columns = table.columns
    return table.selectExpr(*[f"try_cast(`{c}` AS {kinds[c]}) AS `{c}`" if c in kinds else f"`{c}`" for c in columns])


def read_table(spark: SparkSession, folder: str, name: str, file_format: str = "parquet") -> DataFrame:
    """A published table with its declared types. A value that is none of its
    type is NULL; the contract check counts those."""
    location, file_format = _placed(spark, folder, name, file_format)
    return _load(spark, location, name, file_format)


def _published(spark: SparkSession, folder: str, file_format: str, read: Callable) -> dict[str, DataFrame]:
    return {name: read(spark, folder, name, file_format)
            for name in CONTRACTS if table_exists(spark, folder, name, file_format)}


def read_published(spark: SparkSession, folder: str, file_format: str = "parquet") -> dict[str, DataFrame]:
    """The contracted tables that have been published, with their declared types."""
    return _published(spark, folder, file_format, read_table)


def stored_published(spark: SparkSession, folder: str, file_format: str = "parquet") -> dict[str, DataFrame]:
    """The contracted tables that have been published, as they lie there."""
    return _published(spark, folder, file_format, stored_table)
