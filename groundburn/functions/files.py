"""Questions to the file system behind a path (local, HDFS, object store)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, location: str):
    """The Hadoop file system of a location, and its path class."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(location).getFileSystem(spark._jsc.hadoopConfiguration()), path


def path_exists(spark: SparkSession, location: str) -> bool:
    fs, path = file_system(spark, location)
    return fs.exists(path(location))


def path_bytes(spark: SparkSession, location: str) -> int:
    """Bytes of a file or of everything in a folder."""
    fs, path = file_system(spark, location)
    return fs.getContentSummary(path(location)).getLength()


def read_text(spark: SparkSession, location: str) -> str | None:
    """A small text file; None if there is none."""
    fs, path = file_system(spark, location)
    if not fs.exists(path(location)):
        return None
    stream = fs.open(path(location))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def swap_text(spark: SparkSession, location: str, text: str) -> None:
    """Replace a small text file in one step: readers see the old or the new one."""
    fs, path = file_system(spark, location)
    jvm, scheme = spark._jvm, path(location).toUri().getScheme() or fs.getUri().getScheme()
    renames = scheme in ("file", "hdfs", "viewfs")  # an object store replaces an object in one step itself
    written = f"{location}.{uuid.uuid4().hex}" if renames else location
    stream = fs.create(path(written), True)
    stream.write(text.encode())
    stream.close()
    if renames:
        overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        qualified = [fs.makeQualified(path(x)) for x in (written, location)]
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(*qualified, overwrite)


def folders(spark: SparkSession, location: str) -> list[str]:
    """Names of the folders in a folder."""
    fs, path = file_system(spark, location)
    if not fs.exists(path(location)):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path(location)) if s.isDirectory())
