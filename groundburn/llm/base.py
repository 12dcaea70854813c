"""What the operators share: tables, staged results, bytes of a text."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from functools import lru_cache, wraps
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of white space in the contracts' words: 0x20 and 0x09-0x0D, as bytes.split() has it.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster shares. Only a local master makes one of its own;
    a cluster without one is an error, as its machines would not see each other's files."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None and not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("staged tables need a shared folder: set spark.checkpoint.dir")
    if folder is None:
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    return f"{folder.rstrip('/')}/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: computed once,
    lineage cut, safe from lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_staged(spark: SparkSession) -> None:
    """Removes everything this application staged; for when its results are written.
    Results that have not been written can no longer be read afterwards."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def crc32_text(col: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; of a null, that of no bytes."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary"))


def id_remainder(col: Column, n: int) -> Column:
    """crc32(id as text) mod n; a null id counts as empty text."""
    return F.pmod(crc32_text(col), F.lit(n))


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text, b"" for null, without decoding."""
    for value in column.cast(pa.binary()).to_pylist():
        yield value or b""


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: well spread hashes from any integers."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


@lru_cache(maxsize=None)
def _package() -> str:
    """A zip of this package, for workers that do not have it on their path."""
    top = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="package-")) / f"{top.name}.zip"
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(top.rglob("*.py")):
            out.write(file, file.relative_to(top.parent))
    return str(path)


_served: set[str] = set()


_current = ""
_kept: list[tuple[dict, Callable[[], None]]] = []


def worker_cache(make: Callable) -> Callable:
    """Keeps the value that a worker made last, from task to task of the operator
    that uses it; it goes when the worker turns to another operator."""
    cached, used = lru_cache(maxsize=1)(make), {"by": ""}

    @wraps(make)
    def get(*args):
        used["by"] = _current
        return cached(*args)

    _kept.append((used, cached.cache_clear))
    return get


def _turn_to(operator: str) -> None:
    """Called by a worker at each task's start: what other operators kept goes."""
    global _current
    if operator == _current:
        return
    _current = operator
    for used, clear in _kept:
        if used["by"] != operator:
            clear()
    gc.collect()
    give_back()


def give_back() -> None:
    """Returns memory that is free to the system: workers live on, and would keep it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(run: Callable) -> Callable:
    """``run``, a function over two cogrouped tables, with what the worker need not keep given back."""
    operator = run.__module__

    def tidied(left: pa.Table, right: pa.Table) -> pa.Table:
        _turn_to(operator)
        try:
            return run(left, right)
        finally:
            give_back()

    return tidied


def in_arrow(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package served to the workers, as --py-files would,
    and with what a worker need not keep given back at both ends of a task."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _served:
        context.addPyFile(_package())
        _served.add(context.applicationId)
    operator = run.__module__

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _turn_to(operator)
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(tidied, schema)


def ddl(df: DataFrame, keep: list[str]) -> str:
    """Schema of the columns kept, as text that more columns may follow."""
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.select(*keep).schema)


def carried(df: DataFrame, keep: list[str] | None, made: str) -> list[str]:
    """Columns of ``df`` to carry: those of ``keep`` (all by default), but for
    names that the operator makes itself, which give way to its own."""
    own = made.lower().split()
    return [c for c in (df.columns if keep is None else keep) if c.lower() not in own]
