"""Token ids in length-delimited binary records with an offset index.

A file is a run of records: length (u64), masked checksum of the length (u32),
payload, masked checksum of the payload (u32), all little-endian. The mask
rotates a CRC-32 and adds a constant, so that a checksum stored inside checked
data does not look like one. A payload is: id of the document (i64), 1 if the
id is null (u8), bytes per token id (u8), then the ids. Beside each file lies
an index of its records' offsets (u64) for reads in any order.

Documents are dealt to files by ranges of their ids, in order inside a file, so
files by name hold all documents in ascending order. Each task writes its file
under another name first and renames it, so that a repeated task does no harm.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundburn.llm.base import in_arrow, new_path, staged
from groundburn.llm.word_ids import by_bytes, word_ids

_HEAD, _SUM, _META = "<Q", "<I", "<qBB"  # layouts of length, checksum and payload head


@dataclass(frozen=True)
class RecordRules:
    tokenizer: str            # file of the tokenizers library, at the same path on every machine
    end_id: int               # closes each document
    id_bytes: int = 2         # of a stored id; 2 while the vocabulary allows it
    cached: int = 250_000     # words in each of two generations of a worker's cache
    batch_bytes: int = 8 << 20  # of texts encoded at a time
    read_bytes: int = 8 << 20  # read of a file at a time


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    head = struct.pack(_HEAD, len(payload))
    return b"".join((head, struct.pack(_SUM, masked(head)), payload, struct.pack(_SUM, masked(payload))))


def unframed(read) -> Iterator[bytes]:
    """Payloads of a file, by ``read(n)``; a wrong or cut record raises."""
    while head := read(12):
        if len(head) < 12 or masked(head[:8]) != struct.unpack_from(_SUM, head, 8)[0]:
            raise ValueError("damaged record length")
        n = struct.unpack_from(_HEAD, head)[0]
        body = read(n + 4)
        if len(body) < n + 4 or masked(body[:n]) != struct.unpack_from(_SUM, body, n)[0]:
            raise ValueError("damaged record")
        yield body[:n]


def written(docs: DataFrame, path: str, rules: RecordRules, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Writes the files; returns one row per file: file, n_docs, n_ids.

    Null text has only the end id. Null ids come first. Repeated rows are
    written each. ``path`` is any URI that pyarrow opens.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("t"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("t").asc()]
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own = word_ids(rules.tokenizer, rules.id_bytes, rules.cached)
        end = np.array([rules.end_id], dtype=own.type).tobytes()
        store, root = fs.FileSystem.from_uri(path)
        name = f"part-{TaskContext.get().partitionId():06d}"
        temporary = f"{root}/.{name}-{uuid.uuid4().hex}"
        offsets, at, n_ids, out = [], 0, 0, None
        for batch in batches:
            if out is None and batch.num_rows:
                store.create_dir(root, recursive=True)
                out = store.open_output_stream(temporary)
            keys = iter(batch.column(0).to_pylist())
            for texts in by_bytes(batch.column(1), rules.batch_bytes):
                ids, ends = own.encode(texts)
                data, begin = ids.tobytes(), 0
                for to, key in zip((ends * rules.id_bytes).tolist(), keys):
                    record = framed(b"".join((struct.pack(_META, key or 0, key is None, rules.id_bytes), data[begin:to], end)))
                    out.write(record)
                    offsets.append(at)
                    at += len(record)
                    begin = to
                n_ids += len(ids) + len(texts)
        if out is None:
            return
        out.close()
        with store.open_output_stream(temporary + ".index") as index:
            index.write(np.array(offsets, dtype="<u8").tobytes())
        store.move(temporary + ".index", f"{root}/{name}.index")
        store.move(temporary, f"{root}/{name}.records")
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{name}.records"]), pa.array([len(offsets)], pa.int64()), pa.array([n_ids], pa.int64())],
            names=["file", "n_docs", "n_ids"])

    return staged(in_arrow(ranged, run, "file string, n_docs long, n_ids long"), "files")


def read_back(files: DataFrame, path: str, rules: RecordRules) -> DataFrame:
    """From the files of :func:`written`: doc_id, start, n_tokens, ids_crc32.

    A file's first start is the sum of the ids of the files before it, from one
    number per file.
    """
    starts, total = {}, 0
    for row in files.orderBy("file").toLocalIterator():  # one row per file
        starts[row["file"]] = total
        total += row["n_ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(path)
        for batch in batches:
            for file, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                out: list[tuple] = []
                with store.open_input_stream(f"{root}/{file}", buffer_size=rules.read_bytes) as source:
                    for payload in unframed(source.read):
                        key, null, width = struct.unpack_from(_META, payload)
                        ids = np.frombuffer(payload, dtype=f"<u{width}", offset=struct.calcsize(_META))
                        out.append((None if null else key, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        at += len(ids)
                        if len(out) == 10_000:
                            yield _rows(out)
                            out = []
                if out:
                    yield _rows(out)

    spark = files.sparkSession
    if not starts:
        return spark.createDataFrame([], _ROWS)
    listed = spark.createDataFrame(list(starts.items()), "file string, start long").repartition(len(starts), "file")
    return in_arrow(listed, run, _ROWS)


_ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _rows(out: list[tuple]) -> pa.RecordBatch:
    columns = zip(*out, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def record_at(path: str, file: str, k: int) -> bytes:
    """The k-th payload of a file by its index: a read in any order."""
    store, root = fs.FileSystem.from_uri(path)
    index = f"{root}/{file.removesuffix('.records')}.index"
    with store.open_input_file(index) as source:
        offset = struct.unpack("<Q", source.read_at(8, 8 * k))[0]
    with store.open_input_file(f"{root}/{file}") as source:
        source.seek(offset)
        return next(unframed(source.read))


def fresh_path(spark: SparkSession) -> str:
    """A new folder of records in the shared folder, as a URI."""
    path = new_path(spark, "records")
    return path if "://" in path or path.startswith("file:") else f"file://{path}"
