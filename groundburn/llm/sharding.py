"""Contiguous shards of near equal bytes, by global prefix sums.

Rows are put in order by range partitions. Each partition's total gives every
partition its start; a running sum inside gives every row its own. A row goes
to the shard whose equal share of all bytes holds the row's middle, so shards
are contiguous in the order and differ by about one row's size. Nothing but
one total per partition meets in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundburn.llm.base import crc32_text, new_path, staged

FRAME = 8  # bytes that a stored document takes besides its text


def document_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(FRAME)


def sharded(rows: DataFrame, order: list[str], size: str, n_shards: int) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``.

    Args:
        rows: any columns; ``size`` a non-negative long. Rows should be small:
            ids and sizes, not the texts.
        order: columns that give the global order, nulls first. Equal rows
            keep any order among themselves; they may fall in two shards.
        n_shards: shards, numbered from 0.

    No rows give no rows. Where a row is larger than a share, some shards may
    be empty. Columns named shard or slot give way. If all sizes are 0 every row is in shard 0. A key that a third of
    the rows have is split like any other run: a row number breaks its tie.
    """
    # Whole rows in one column: names like those made here can be theirs.
    kept = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    numbered = staged(rows.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{size}`").cast("long").alias("_size"),
        *[F.col(f"`{c}`").alias(f"_by{i}") for i, c in enumerate(order)], F.monotonically_increasing_id().alias("_row")), "sizes")
    by = [*[F.col(f"_by{i}").asc_nulls_first() for i in range(len(order))], F.col("_row").asc()]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = staged(numbered.repartitionByRange(parts, *by).withColumn("_part", F.spark_partition_id()), "ranges")

    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    totals = ranged.groupBy("_part").agg(F.sum("_size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    starts = totals.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes0"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows0"),
        F.sum("_bytes").over(Window.orderBy("_part").rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing)).alias("_all"),
    )
    inside = Window.partitionBy("_part").orderBy(*by)
    placed = (
        ranged.withColumn("_upto", F.sum("_size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_nth", F.row_number().over(inside))
        .join(F.broadcast(starts), "_part")  # as many rows as partitions
        .withColumn("_index", F.col("_rows0") + F.col("_nth") - 1)
        .withColumn("shard", F.expr(
            f"cast(coalesce(least({n_shards - 1}, (2 * (_bytes0 + _upto) - _size) * {n_shards} div (2 * _all)), 0) as int)"))
    )
    placed = staged(placed, "placed")
    first = placed.groupBy("shard").agg(F.min("_index").alias("_first"))  # n_shards rows
    return (
        placed.join(F.broadcast(first), "shard")
        .withColumn("slot", F.col("_index") - F.col("_first"))
        .select("row.*", "shard", "slot")
    )


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32; null text has no bytes."""
    return docs.select("doc_id", document_size(F.col("text")).alias("size"), crc32_text(F.col("text")).alias("text_crc32"))


def write_shards(docs: DataFrame, path: str | None, n_shards: int) -> str:
    """Documents in one folder per shard, in slot order; returns the path.

    Ids should be unique: the join back to the texts is by doc_id (rows that
    share an id and a text also share their place). Columns named shard or slot
    give way to the operator's own.
    """
    path = path or new_path(docs.sparkSession, "shards")
    places = (
        sharded(document_sizes(docs), ["doc_id", "text_crc32"], "size", n_shards)
        .groupBy("doc_id", "text_crc32").agg(F.min(F.struct("shard", "slot")).alias("_at"))
    )
    kept = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col("doc_id").alias("id"), crc32_text(F.col("text")).alias("crc"))
    joined = (
        rows.join(places, F.col("id").eqNullSafe(places["doc_id"]) & (F.col("crc") == F.col("text_crc32")))
        .select("row.*", "_at.shard", "_at.slot")
    )
    (joined.repartitionByRange(F.col("shard"), F.col("slot")).sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
    return path
