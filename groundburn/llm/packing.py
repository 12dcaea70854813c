"""Documents packed into sequences by their length histogram, shortest pack first.

Texts become ids with an end id each; a document over the window is cut into
whole windows and a rest, all others stay in one piece. Only the histogram of
piece lengths, as many numbers as the window has places, comes to the driver.
There lengths are placed longest first, each into the packs with most room
left, and packs that look alike are one pattern with a count, so the work does
not grow with the documents. Where no pack has room, as few packs as hold the
rest of that length are opened.

A pattern's places of a length are numbered through; so are the pieces of that
length, within each task and from task to task by prefix sums of counts. The
number joins a piece to its place: sequence and offset. The table of places
travels to the tasks; it has at most three patterns a length, and no pattern
has more than sqrt(2 * window) different lengths.

Cases: null and empty texts are their end id alone; repeated rows are packed
each; null ids stay null; no documents give no pieces. Columns named like the
operator's own give way.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from groundburn.functions.joins import join_sized
from groundburn.llm.base import carried, ddl, in_arrow, staged
from groundburn.llm.word_ids import by_bytes, word_ids


@dataclass(frozen=True)
class PackRules:
    tokenizer: str           # file of the tokenizers library, at the same path on every machine
    end_id: int              # closes each document
    window: int = 4096       # tokens of a sequence
    pad_id: int = 0
    id_bytes: int = 2        # of an id; 2 while the vocabulary allows it


# ---- patterns from a histogram ----------------------------------------------

@dataclass(frozen=True)
class Pattern:
    """``count`` packs that hold, from the front, so many copies of each length."""

    count: int
    runs: tuple[tuple[int, int], ...]  # (length, copies)


def patterns(histogram: Mapping[int, int], window: int) -> list[Pattern]:
    """Packs for so many pieces of each length from 1 to ``window``."""
    open_packs: list[tuple[int, int, int, tuple]] = []  # (-room, age, count, runs): most room first
    age = 0

    def put(room: int, count: int, runs: tuple) -> None:
        nonlocal age
        age += 1
        heapq.heappush(open_packs, (-room, age, count, runs))

    for length in sorted(histogram, reverse=True):
        n = histogram[length]
        while n:
            if not open_packs or -open_packs[0][0] < length:
                each = window // length
                full, rest = divmod(n, each)
                if full:
                    put(window - each * length, full, ((length, each),))
                if rest:
                    put(window - rest * length, 1, ((length, rest),))
                break
            room, _, count, runs = heapq.heappop(open_packs)
            room = -room
            if n < count:
                put(room - length, n, (*runs, (length, 1)))
                put(room, count - n, runs)
                break
            # These packs stay the emptiest for as many copies, and all of them take one.
            others = max(length, -open_packs[0][0] if open_packs else 0)
            copies = min((room - others) // length + 1, n // count)
            put(room - copies * length, count, (*runs, (length, copies)))
            n -= copies * count
    return [Pattern(count, runs) for _, _, count, runs in sorted(open_packs, key=lambda p: p[1])]


@dataclass(frozen=True)
class Places:
    """Where the pieces of a length go, by their number: from each ``first``
    (length << 48 | number) on to the packs from ``sequence`` on, ``copies`` to
    each, the first at ``offset``."""

    first: np.ndarray
    sequence: np.ndarray
    copies: np.ndarray
    offset: np.ndarray

    @classmethod
    def of(cls, found: list[Pattern]) -> Places:
        rows, taken, sequence = [], {}, 0
        for p in found:
            at = 0
            for length, copies in p.runs:
                number = taken.get(length, 0)
                rows.append((length << 48 | number, sequence, copies, at))
                taken[length] = number + copies * p.count
                at += length * copies
            sequence += p.count
        return cls(*np.array(sorted(rows), np.int64).reshape(-1, 4).T)

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces."""
        key = length << 48 | number
        k = np.searchsorted(self.first, key, side="right") - 1
        pack, copy = np.divmod(key - self.first[k], self.copies[k])
        return self.sequence[k] + pack, self.offset[k] + copy * length


# ---- pieces -----------------------------------------------------------------

_PIECE = "start length ids_crc32 doc_tokens"
_OWN = f"_text _part _nth _before ids {_PIECE} sequence_id offset"


def pieces(docs: DataFrame, rules: PackRules, text: str = "text", keep: list[str] | None = None, with_ids: bool = False) -> DataFrame:
    """``keep`` with start, length, ids_crc32, doc_tokens of each piece, and its
    number _nth among those of its length in its task _part; ids on demand."""
    keep = carried(docs, keep, _OWN)
    window = rules.window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own = word_ids(rules.tokenizer, rules.id_bytes)
        part = TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        end = np.array([rules.end_id], "<u4")
        for batch in batches:
            row = 0
            for texts in by_bytes(batch.column("_text"), 8 << 20):
                ids, ends = own.encode(texts)
                rows, start, length, crc, total, blobs = [], [], [], [], [], []
                at = 0
                for to in ends.tolist():
                    tokens = np.append(ids[at:to].astype("<u4"), end)
                    for k in range(0, len(tokens), window):
                        piece = tokens[k:k + window]
                        rows.append(row)
                        start.append(k)
                        length.append(len(piece))
                        crc.append(zlib.crc32(piece))
                        total.append(len(tokens))
                        if with_ids:
                            blobs.append(piece.astype("<i4"))
                    row, at = row + 1, to
                nth, seen = _numbered(np.array(length, np.int64), seen)
                columns = [*(batch.column(c).take(pa.array(rows, pa.int64())) for c in keep),
                           *(pa.array(v, pa.int64()) for v in (start, length, crc, total)),
                           pa.array([part] * len(rows), pa.int32()), pa.array(nth, pa.int64())]
                if with_ids:
                    columns.append(pa.array(blobs, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [*keep, *_PIECE.split(), "_part", "_nth", *(["ids"] if with_ids else [])]
    schema = f"{ddl(docs, keep)}start long, length long, ids_crc32 long, doc_tokens long, _part int, _nth long{', ids array<int>' if with_ids else ''}"
    return staged(in_arrow(docs.select(*keep, F.col(text).alias("_text")), run, schema), "pieces")


def _numbered(lengths: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each piece among those of its length, after those seen, and all seen now."""
    order = np.argsort(lengths, kind="stable")
    ordered = lengths[order]
    nth = np.empty(len(lengths), np.int64)
    nth[order] = np.arange(len(lengths)) - np.searchsorted(ordered, ordered) + seen[ordered]
    return nth, seen + np.bincount(lengths, minlength=len(seen))


def placed(cut: DataFrame, window: int) -> DataFrame:
    """``cut`` (of :func:`pieces`) with sequence_id and offset."""
    counts = staged(cut.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``window`` rows
    places = Places.of(patterns(histogram, window))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    bases = counts.select("length", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    kept = [c for c in cut.columns if c not in ("_part", "_nth")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = places.find(*(batch.column(c).to_numpy() for c in ("length", "_nth")))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)], names=[*kept, "sequence_id", "offset"])

    numbered = join_sized(cut, bases, ["length", "_part"]).select(*kept, (F.col("_nth") + F.col("_before")).alias("_nth"))
    return in_arrow(numbered, run, f"{ddl(cut, kept)}sequence_id long, offset long")


def packed(docs: DataFrame, rules: PackRules, text: str = "text", keep: list[str] | None = None, with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its sequence and offset there."""
    return placed(pieces(docs, rules, text, keep, with_ids), rules.window)


def sequences(found: DataFrame, rules: PackRules) -> DataFrame:
    """sequence_id, n_tokens and padded ids of :func:`packed` with ids. A
    sequence is padded to the window, except where a power of two is full."""
    whole = found.groupBy("sequence_id").agg(  # a window of tokens at most
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids"))
    n = F.size("ids")
    padding = F.when(F.bit_count(n) == 1, 0).otherwise(rules.window - n)
    return whole.select("sequence_id", n.cast("long").alias("n_tokens"), F.concat("ids", F.array_repeat(F.lit(rules.pad_id), padding)).alias("ids"))
