"""Benchmark decontamination by Wu-Manber search for many strings at once.

Texts and items become words joined by single spaces. An item's windows of ten
words (or its fewer words) are the patterns, with a space at both ends, so that
only whole words match. Patterns are searched in classes of similar length: the
shift table of a class says, for the block of bytes that ends at a position, how
far the search may move without passing a match; at shift 0 the block, being
the suffix of some patterns' common length, selects the few patterns to
compare with the text directly.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundburn.llm.base import carried, ddl, in_arrow, staged, text_bytes

#: Lower-cases A-Z and makes every ASCII byte but digits and letters a space.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


def windows(words: list[bytes], width: int) -> list[bytes]:
    """Patterns of an item: every window of ``width`` words, or the fewer words it has."""
    if not words:
        return []
    return [b" " + b" ".join(words[i:i + width]) + b" " for i in range(max(1, len(words) - width + 1))]


class _Class:
    """Patterns of similar length: shift table and suffix buckets."""

    def __init__(self, patterns: list[bytes], block: int):
        self.least = min(map(len, patterns))
        self.block = min(block, self.least)
        self.far = self.least - self.block + 1
        shift: dict[bytes, int] = {}
        buckets: dict[bytes, list[bytes]] = defaultdict(list)
        for p in patterns:
            for end in range(self.block, self.least + 1):
                key = p[end - self.block:end]
                shift[key] = min(shift.get(key, self.far), self.least - end)
            buckets[p[self.least - self.block:self.least]].append(p)
        self.shift, self.buckets = shift, dict(buckets)

    def find(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        end, n, block, far = self.least, len(text), self.block, self.far
        shift, least = self.shift.get, self.least
        while end <= n:
            key = text[end - block:end]
            step = shift(key, far)
            if step:
                end += step
                continue
            for p in self.buckets[key]:
                if text.startswith(p, end - least):
                    yield end - least, p
            end += 1


class WuManber:
    """Finds every occurrence of every pattern.

    Patterns are split into classes at doubling lengths, so that one short
    pattern does not shorten the shifts of all. ``block`` is longer than the
    classic two or three bytes: with thousands of patterns, shorter blocks
    occur in one of them nearly everywhere.
    """

    def __init__(self, patterns: list[bytes], block: int = 12):
        classes: dict[int, list[bytes]] = defaultdict(list)
        for p in set(patterns):
            classes[min(len(p), 63).bit_length()].append(p)
        self.classes = [_Class(ps, block) for ps in classes.values()]

    def find(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        for c in self.classes:
            yield from c.find(text)


class _Slice:
    """Some items as a worker searches for them. The items travel with the task;
    windows and tables are made where they are used."""

    def __init__(self, items: list[tuple[str | None, bytes]], width: int, block: int):
        self.items, self.width, self.block = items, width, block
        self.search: WuManber | None = None

    def __getstate__(self) -> tuple:
        return self.items, self.width, self.block

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def open(self) -> None:
        owners: dict[bytes, set[str]] = defaultdict(set)
        for item, text in self.items:
            for p in windows(normal_words(text), self.width):
                owners[p].update([] if item is None else [item])
        self.owners = {p: sorted(ids) for p, ids in owners.items()}
        self.search = WuManber(list(owners), self.block) if owners else None

    def found(self, text: bytes) -> tuple[int, list[int], list[str]]:
        """Words of a text, half-open spans of those hit (start, end, start, end...), items found."""
        words = normal_words(text)
        spans: list[int] = []
        items: set[str] = set()
        if self.search and words:
            line = b" " + b" ".join(words) + b" "
            starts: list[int] | None = None
            for at, p in self.search.find(line):
                if starts is None:
                    starts = [i for i, b in enumerate(line) if b == 0x20]
                first = bisect_right(starts, at) - 1
                spans += (first, first + p.count(b" ") - 1)
                items.update(self.owners[p])
        return len(words), spans, sorted(items)


def _whole(part: _Slice, keep: list[str]):
    """The result of rows, where one slice is the whole benchmark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part.open()
        for batch in batches:
            found = [part.found(text) for text in text_bytes(batch.column("_text"))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array([f[0] for f in found], pa.int64()),
                 pa.array([_union(f[1]) for f in found], pa.int64()), pa.array([f[2] for f in found], pa.list_(pa.string()))],
                names=[*keep, *_OWN])

    return run


def _partly(part: _Slice, first: bool):
    """(row, words, spans, items) of one slice: of every row from the first one, then of rows with hits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part.open()
        for batch in batches:
            rows = [(row, n if first else 0, spans, items) for row, (n, spans, items) in
                    zip(batch.column(0).to_pylist(), map(part.found, text_bytes(batch.column(1))), strict=True) if first or spans]
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string())), strict=True)],
                names=["row", "words", "spans", "items"])

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(map(_union, batch.column(2).to_pylist()), pa.int64()), batch.column(3)],
            names=["_row", *_OWN])


_OWN = ("n_words", "n_hit", "items")


def _union(spans: list[int]) -> int:
    """Length of the union of half-open spans given as start, end, start, end..."""
    total, reach = 0, 0
    for start, end in sorted(zip(spans[::2], spans[1::2], strict=True)):
        total += max(0, end - max(start, reach))
        reach = max(reach, end)
    return total


def contamination(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", keep: list[str] | None = None,
                  width: int = 10, block: int = 12, slice_bytes: int = 512 << 10) -> DataFrame:
    """Documents with n_words, n_hit and items (ids found, sorted as strings).

    Args:
        docs, benchmark: any columns; benchmark has item_id and text.
        keep: columns of ``docs`` to carry (all by default).
        slice_bytes: about the most bytes of items that are searched for at a
            time, and the most that the driver and a task hold of them. A larger
            benchmark is cut into slices, a pass over the texts for each; what a
            pass finds is staged, and joined with the documents at the end.

    Null text has no words. Items without words have no windows; windows of
    items without an id count for n_hit but name no item. Equal windows of
    several items count for each.
    """
    keep = carried(docs, keep, "_text _row n_words n_hit items")
    items = benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").alias("t")).where("t is not null")
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-total // slice_bytes))

    def part(rows: DataFrame) -> _Slice:
        return _Slice([(r["i"], r["t"].encode()) for r in rows.toLocalIterator()], width, block)  # bounded by the slice

    made = "n_words long, n_hit long, items array<string>"
    if n == 1:
        return in_arrow(docs.select(*keep, F.col(text).alias("_text")), _whole(part(items), keep), f"{ddl(docs, keep)}{made}")
    sliced = staged(items.withColumn("slice", F.pmod(F.xxhash64("i", "t"), F.lit(n))), "items")
    numbered = staged(docs.select(*keep, F.col(text).alias("_text"), F.monotonically_increasing_id().alias("_row")), "documents")
    passes = [
        staged(in_arrow(numbered.select("_row", "_text"), _partly(part(sliced.where(F.col("slice") == k)), k == 0),
                        "row long, words long, spans array<int>, items array<string>"), "hits") for k in range(n)]
    each = reduce(DataFrame.union, passes).groupBy("row").agg(
        F.sum("words").alias("words"), F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    found = in_arrow(each, _summed, f"_row long, {made}")
    return numbered.drop("_text").join(found, "_row").select(*keep, *_OWN)


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
