"""Monthly archives: one ZIP with one CSV each, named ``..._<year>_<month>.zip``.

A ZIP cannot be split, so each archive is read by one task, as a stream from
its path: neither the archive nor its CSV is ever held whole. One pass over an
archive gives both its rows and, at the end, what became of it, so the rows of
an archive count only once its status row says that all of it could be read.
"""

from __future__ import annotations

import csv
import re
import zipfile
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundburn.schema import FLIGHT, PARTITIONS, REQUIRED

# Outcomes of looking at an archive.
VALID, CORRUPT, INCOMPLETE, MISNAMED = "valido", "zip_corrupto", "esquema_incompleto", "nombre_invalido"
RAGGED, ENCODING, SEVERAL = "csv_danado", "codificacion_invalida", "varios_csv"

_PERIOD = r"_(\d{4})_(\d{1,2})\.zip$"
_STATUS = "estado string, columnas_faltantes array<string>, bytes_zip long, bytes_csv long"
#: What opening or reading a damaged archive raises. RuntimeError: an encrypted member.
_DAMAGE = (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, OSError, RuntimeError)
_BLOCK = 8 << 20
_LONGEST_HEADER = 1 << 20

#: Columns taken from a CSV; the partition columns come from the archive's name.
_COLUMNS = [c for c in FLIGHT.names if c not in PARTITIONS]


def list_archives(spark: SparkSession, folder: str, pattern: str = "*.zip") -> DataFrame:
    """Path and size of each archive, from the listing; contents are not read."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
        .select(F.col("path").alias("archivo"), F.col("length").alias("bytes_zip"))
    )


def period_columns(path: Column) -> tuple[Column, Column]:
    """Year and month in an archive's name; NULL when it carries none."""
    def part(group: int) -> Column:
        text = F.regexp_extract(path, _PERIOD, group)
        return F.when(text != "", text.cast("long"))

    return part(1), part(2)


def _opened(path: str):
    """The file behind a path, for reads in any place. Single-slash URIs are
    what Hadoop calls local files; s3a is another name of s3."""
    from pyarrow import fs

    uri = re.sub(r"^(\w+):/(?!/)", r"\1:///", path)
    store, name = fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))
    return store.open_input_file(name)


def _archive(file) -> zipfile.ZipFile:
    try:
        return zipfile.ZipFile(file)
    except ValueError as error:  # a file too short to hold what it is asked for
        raise zipfile.BadZipFile(str(error)) from error


class _Member:
    """A CSV member as a stream that shows its first line beforehand and keeps
    what reading it raised, whatever the CSV reader makes of that."""

    closed = False

    def __init__(self, stream):
        self.stream, self.failure = stream, None
        self.ahead = b""
        while b"\n" not in self.ahead and len(self.ahead) < _LONGEST_HEADER:
            more = self._more(64 << 10)
            if not more:
                break
            self.ahead += more

    def _more(self, n: int) -> bytes:
        try:
            return self.stream.read(n)
        except Exception as error:
            self.failure = error
            raise

    def header(self) -> list[str]:
        line = self.ahead.split(b"\n", 1)[0].decode("utf-8-sig")
        return next(csv.reader([line.rstrip("\r")]), [])

    def has_rows(self) -> bool:
        if self.ahead.endswith(b"\n") and self.ahead.count(b"\n") == 1:
            self.ahead += self._more(64 << 10)
        return bool(self.ahead.partition(b"\n")[2])

    def read(self, n: int = -1) -> bytes:
        if self.ahead:
            n = len(self.ahead) if n < 0 else n
            out, self.ahead = self.ahead[:n], self.ahead[n:]
            return out
        return self._more(n)

    def readable(self) -> bool:
        return True

    def close(self) -> None:
        pass

    def drain(self) -> None:
        """The rest, for its checksum."""
        self.ahead = b""
        while self._more(_BLOCK):
            pass


def _batches(member: _Member, header: list[str]) -> Iterator:
    """The CSV as text, every column of it. A row with too few or many fields,
    or a byte that is not UTF-8 in any column, raises a ValueError."""
    import pyarrow as pa
    from pyarrow import csv as pacsv

    yield from pacsv.open_csv(
        pa.PythonFile(member, mode="r"),
        read_options=pacsv.ReadOptions(block_size=_BLOCK, use_threads=False),
        parse_options=pacsv.ParseOptions(newlines_in_values=True),
        convert_options=pacsv.ConvertOptions(
            column_types={c: pa.string() for c in header}, strings_can_be_null=True, null_values=[""]),
    )


def _sizes(archive: zipfile.ZipFile) -> tuple[list[zipfile.ZipInfo], int]:
    members = [m for m in archive.infolist() if m.filename.lower().endswith(".csv")]
    return members, sum(m.file_size for m in members)


def _read_one(path: str) -> Iterator:
    """Batches of (archivo, columns) of an archive, then the status as a dict."""
    import pyarrow as pa

    found = {"archivo": path, "estado": VALID, "columnas_faltantes": [], "bytes_zip": 0, "bytes_csv": 0}
    damaged, member = None, None
    try:
        with _opened(path) as file:
            found["bytes_zip"] = file.size()
            with _archive(file) as archive:
                members, found["bytes_csv"] = _sizes(archive)
                damaged = SEVERAL if len(members) > 1 else None
                for other in archive.infolist():
                    if damaged or other not in members:
                        with archive.open(other) as stream:
                            _Member(stream).drain()
                header = []
                if members and not damaged:
                    with archive.open(members[0]) as stream:
                        member = _Member(stream)
                        header = member.header()
                        found["columnas_faltantes"] = sorted(set(REQUIRED) - set(header))
                        if not found["columnas_faltantes"] and member.has_rows():
                            place = {c: i for i, c in reversed(list(enumerate(header)))}
                            for batch in _batches(member, header):
                                names = pa.array([path] * batch.num_rows, pa.string())
                                yield names, [
                                    batch.column(place[c]) if c in place else pa.nulls(batch.num_rows, pa.string()) for c in _COLUMNS]
                        member.drain()
                else:
                    found["columnas_faltantes"] = sorted(REQUIRED)
    except UnicodeDecodeError:
        damaged = ENCODING
    except _DAMAGE:
        damaged = CORRUPT
    except ValueError as error:  # how the CSV reader reports rows and bytes it cannot read
        damaged = ENCODING if "UTF8" in str(error) else RAGGED
    except csv.Error:
        damaged = RAGGED
    if member is not None and member.failure is not None:
        damaged = CORRUPT
    if damaged:
        found.update(estado=damaged, columnas_faltantes=[])
    elif found["columnas_faltantes"]:
        found["estado"] = INCOMPLETE
    elif not re.search(_PERIOD, path):
        found["estado"] = MISNAMED
    yield found


def parse_archives(paths: DataFrame) -> DataFrame:
    """Rows and status rows of the archives in column ``archivo``, from one pass
    over each: the declared flight columns, ``archivo``, and a status that is
    NULL on rows and last of each archive.

    Values that cannot be read as their type become NULL, as do columns the
    file lacks. Year and Month are those of the archive, so a month can only
    ever replace itself.
    """
    raw = T.StructType([T.StructField("archivo", T.StringType()), *T.StructType.fromDDL(_STATUS).fields,
                        *[T.StructField(c, T.StringType()) for c in _COLUMNS]])

    def run(records: Iterator) -> Iterator:
        import pyarrow as pa

        status = [pa.string(), pa.list_(pa.string()), pa.int64(), pa.int64()]
        names = raw.names
        for record in records:
            for path in record.column(0).to_pylist():
                for part in _read_one(path):
                    if isinstance(part, dict):
                        columns = [pa.array([part[n]], t) for n, t in zip(names[:5], [pa.string(), *status], strict=True)]
                        columns += [pa.nulls(1, pa.string())] * len(_COLUMNS)
                    else:
                        columns = [part[0], *(pa.nulls(len(part[0]), t) for t in status), *part[1]]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    def typed(field: T.StructField) -> Column:
        kind = field.dataType.simpleString()
        if kind == "bigint":  # whole numbers may be written as 930, 0930 or 930.00; 930.7 is none
            number = f"try_cast({field.name} AS DECIMAL(38, 10))"
            return F.expr(f"IF({number} = floor({number}), try_cast({number} AS BIGINT), NULL)").alias(field.name)
        return F.expr(f"try_cast({field.name} AS {kind})").alias(field.name)

    year, month = period_columns(F.col("archivo"))
    return paths.select("archivo").mapInArrow(run, raw).select(
        *raw.names[:5], *[typed(f) for f in FLIGHT.fields if f.name in _COLUMNS], year.alias("Year"), month.alias("Month"))


def archive_statuses(parsed: DataFrame) -> DataFrame:
    """One row per archive of :func:`parse_archives`: outcome, missing columns, sizes, month."""
    return parsed.where(F.col("estado").isNotNull()).select(
        "archivo", F.col("Year").alias("anio"), F.col("Month").alias("mes"), "estado", "columnas_faltantes", "bytes_zip", "bytes_csv")


def flight_rows(parsed: DataFrame) -> DataFrame:
    """Flight rows of :func:`parse_archives`, with ``archivo``."""
    return parsed.where(F.col("estado").isNull()).select("archivo", *FLIGHT.names)


def file_volume(spark: SparkSession, folder: str, pattern: str = "*.zip") -> DataFrame:
    """Number of files and their bytes, from the listing."""
    return list_archives(spark, folder, pattern).agg(
        F.count(F.lit(1)).alias("archivos"), F.coalesce(F.sum("bytes_zip"), F.lit(0)).alias("bytes"))


def archive_sizes(paths: DataFrame) -> DataFrame:
    """Archive and CSV bytes from each archive's directory, nothing decompressed.
    One that cannot be opened has no CSV bytes."""
    def run(records: Iterator) -> Iterator:
        import pyarrow as pa

        for record in records:
            sizes = []
            for path in record.column(0).to_pylist():
                packed = plain = 0
                try:
                    with _opened(path) as file:
                        packed = file.size()
                        with _archive(file) as archive:
                            plain = _sizes(archive)[1]
                except _DAMAGE:
                    pass
                sizes.append((path, packed, plain))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("archivo", "bytes_zip", "bytes_csv"), s, strict=True)) for s in sizes],
                schema=pa.schema([("archivo", pa.string()), ("bytes_zip", pa.int64()), ("bytes_csv", pa.int64())]))

    return paths.select("archivo").mapInArrow(run, "archivo string, bytes_zip long, bytes_csv long")


def input_volume(sizes: DataFrame, minimum_gb: float = 1.5) -> DataFrame:
    """Archives, compressed and CSV bytes, and whether the CSV reaches a minimum size."""
    return sizes.agg(
        F.count(F.lit(1)).alias("archivos"),
        F.coalesce(F.sum("bytes_zip"), F.lit(0)).alias("bytes_zip"),
        F.coalesce(F.sum("bytes_csv"), F.lit(0)).alias("bytes_csv"),
    ).withColumn("cumple_minimo", F.col("bytes_csv") / F.lit(1e9) >= minimum_gb)
