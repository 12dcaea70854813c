"""Archives as a file stream: each new archive is converted once.

The stream's checkpoint remembers which archives were seen, and the stream's
id. A micro-batch that is repeated after a failure rewrites the same months and
the same ledger entry, so the outcome does not change; a stream with another
checkpoint has another id and entries of its own.
"""

from __future__ import annotations

from queue import Queue

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from groundburn.plans.ingest import convert

_BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def archive_stream(spark: SparkSession, folder: str, max_files: int = 64) -> DataFrame:
    """Paths of archives appearing in a folder; their bytes are left where they are."""
    return (
        spark.readStream.format("binaryFile").schema(_BINARY_FILE)
        .option("pathGlobFilter", "*.zip").option("maxFilesPerTrigger", max_files).load(folder)
        .select(F.col("path").alias("archivo"))
    )


def start_ingest(
    spark: SparkSession, folder: str, lake: str, checkpoint: str, max_files: int = 64,
) -> StreamingQuery:
    """Convert everything that is new, then stop."""
    started: Queue[str] = Queue()

    def batch(archives: DataFrame, number: int) -> None:
        stream = started.get()  # known once the query has started
        started.put(stream)
        convert(archives, lake, f"flujo-{stream}-{number}")

    query = (
        archive_stream(spark, folder, max_files).writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    started.put(query.id)
    return query
