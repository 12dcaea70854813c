"""How far the sources of a language differ in their words, by chunk factorization.

A text is cut at ASCII white space into chunks, counted per document. Blocks
of documents keep those counts and ask for the terms of their distinct chunks.
Requests are dealt by ranges of chunk hashes, packed: a task has every request
for its chunks, tokenizes each once however many blocks ask, and answers the
blocks. Most chunks are a term as they stand; only others are answered. The
blocks then know the terms of every document and send on, again packed and
dealt by ranges of term hashes, how many documents of a language and source
have a term and how often. A range's task adds them up and keeps the terms
that enough of a language's documents have.

Sources are compared over all kept terms of their language, those they lack
included: the terms of a language are dealt to tiles of bounded size, and a
tile adds up every pair of sources and its own best terms. Tiles' sums are
then added. The number of ranges grows with the requests and counts, so that a
task holds a bounded share of the distinct chunks or terms.

Cases: null text, language and source are empty strings; repeated rows count
as documents each; equal values are ranked by item in UTF-8 order; no
documents give no rows. Only the three columns named are read. A language
without kept terms has pairs of value 0 and no terms, a source alone in its
language no pairs.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from groundburn.functions.joins import join_sized
from groundburn.llm.base import in_arrow, staged, tidy

#: A term is a run of letters or of anything beyond ASCII; only A-Z are folded.
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class AuditRules:
    least_documents: int = 10      # of a language, that make a term count
    top: int = 10                  # ranks of terms
    unit: int = 1_000_000_000      # of a share
    block_bytes: int = 10 << 20    # of text in a block; a longer document is a block of its own
    range_rows: int = 2_000_000    # requests, or counts, that a range gets about
    tile_cells: int = 200_000    # terms x sources that a tile holds


def terms_of(chunk: bytes) -> list[bytes]:
    return _TERM.findall(chunk.translate(_FOLD))


# ---- blocks of documents ----------------------------------------------------

def _packed(**columns: pa.Array | np.ndarray) -> bytes:
    batch = pa.record_batch(columns)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all().combine_chunks()


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name)
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks) if column.num_chunks else column.combine_chunks()


def _ranges(values: list[bytes], ranges: int) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, values), np.int64, len(values)) % ranges


def _bytes(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()


def _blocks(docs: DataFrame, rules: AuditRules) -> DataFrame:
    """(block, n_chunks, n_pairs, langs, sources, chunks, counts): a block's
    groups, and packed: its distinct chunks in order; the group of each
    document; document * n_chunks + chunk, as differences, and count of all
    that occur."""
    size = rules.block_bytes

    def counted(block: int, lang: pa.Array, source: pa.Array, text: pa.Array) -> pa.RecordBatch:
        words = pc.ascii_split_whitespace(text)
        found = words.flatten().dictionary_encode()
        order = pc.sort_indices(found.dictionary)
        n_chunks = max(len(order), 1)
        rank = np.empty(len(order), np.int64)
        rank[order.to_numpy()] = np.arange(len(order))
        doc = np.repeat(np.arange(len(text)), np.diff(words.offsets.to_numpy()))
        pairs, n = np.unique(doc * n_chunks + rank[found.indices.to_numpy()], return_counts=True)
        langs, sources = lang.dictionary_encode(), source.dictionary_encode()
        both, group = np.unique(
            langs.indices.to_numpy().astype(np.int64) << 32 | sources.indices.to_numpy(), return_inverse=True)
        groups = [langs.dictionary.take(pa.array(both >> 32)), sources.dictionary.take(pa.array(both & 0xFFFFFFFF))]
        blobs = [_packed(chunk=found.dictionary.take(order)), _packed(group=group.astype(np.int32)),
                 _packed(step=np.diff(pairs, prepend=0), n=n.astype(np.int32))]
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([n_chunks], pa.int64()), pa.array([len(pairs)], pa.int64()),
             *(pa.ListArray.from_arrays(pa.array([0, len(g)], pa.int32()), g) for g in groups), *(pa.array([b], pa.binary()) for b in blobs)],
            names=["block", "n_chunks", "n_pairs", "langs", "sources", "chunks", "groups", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            upto = np.cumsum(pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                before = upto[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(upto, before + size, side="right")))
                yield counted(block, *(c.slice(at, to - at) for c in batch.columns))
                block, at = block + 1, to

    given = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    return staged(in_arrow(given, run, "block long, n_chunks long, n_pairs long, langs array<string>, sources array<string>, "
                                       "chunks binary, groups binary, counts binary"), "blocks")


# ---- every distinct chunk tokenized once ------------------------------------

def _asked(blocks: DataFrame, ranges: int) -> DataFrame:
    """(range, block, chunks): a block's distinct chunks of each range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                chunks = _column(_unpacked(blob), "chunk")
                own = _ranges(_bytes(chunks), ranges)
                some = np.unique(own)
                blobs = [_packed(chunk=chunks.take(pa.array(np.flatnonzero(own == r)))) for r in some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int32()), pa.array([block] * len(some), pa.int64()), pa.array(blobs, pa.binary())],
                    names=["range", "block", "chunks"])

    return in_arrow(blocks.select("block", "chunks"), run, "range int, block long, chunks binary").repartition(ranges, "range")


def _answers(asked: DataFrame) -> DataFrame:
    """(block, range, terms): place among a request's chunks and terms, of the
    chunks that are not one term as they stand."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, list[bytes] | None] = {}  # the ranges' distinct chunks
        for batch in batches:
            out = []
            for r, block, blob in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                at, terms = [], []
                for k, chunk in enumerate(_bytes(_column(_unpacked(blob), "chunk"))):
                    if chunk not in known:
                        found = terms_of(chunk)
                        known[chunk] = None if found == [chunk] else found
                    if (found := known[chunk]) is not None:
                        at.append(k)
                        terms.append(found)
                out.append((block, r, _packed(at=pa.array(at, pa.int32()), terms=pa.array(terms, pa.list_(pa.binary())))))
            block, r, blob = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(block, pa.int64()), pa.array(r, pa.int32()), pa.array(blob, pa.binary())], names=["block", "range", "terms"])

    return in_arrow(asked, run, "block long, range int, terms binary")


def _known(ranges: int, term_ranges: int):
    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        """(range, counts) of one block: packed lang, source, term, docs, n."""
        chunks = _column(_unpacked(blocks.column("chunks")[0].as_py()), "chunk").cast(pa.binary())
        group = _column(_unpacked(blocks.column("groups")[0].as_py()), "group").to_numpy().astype(np.int64)
        counts = _unpacked(blocks.column("counts")[0].as_py())
        doc, chunk = np.divmod(np.cumsum(_column(counts, "step").to_numpy()), blocks.column("n_chunks")[0].as_py())
        n = _column(counts, "n").to_numpy().astype(np.int64)

        # Terms of each chunk: itself, or what was answered.
        own = _ranges(_bytes(chunks), ranges)
        sizes = np.ones(len(chunks), np.int64)
        starts = np.arange(len(chunks))
        parts, base = [chunks], len(chunks)
        by_range = np.argsort(own, kind="stable")
        first = np.searchsorted(own[by_range], np.arange(ranges + 1))
        for r, blob in zip(answers.column("range").to_pylist(), answers.column("terms").to_pylist(), strict=True):
            answer = _unpacked(blob)
            lists = _column(answer, "terms")
            at = by_range[first[r]:first[r + 1]][_column(answer, "at").to_numpy()]
            each = np.diff(lists.offsets.to_numpy())
            sizes[at] = each
            starts[at] = base + np.cumsum(each) - each
            parts.append(lists.flatten())
            base += len(parts[-1])
        found = pa.concat_arrays(parts).dictionary_encode()
        terms, term = found.dictionary, found.indices.to_numpy().astype(np.int64)

        # Each chunk of a document gives way to its terms.
        times = sizes[chunk]
        place = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(starts[chunk], times)
        width = max(len(terms), 1)
        pairs, n = _summed(np.repeat(doc, times) * width + term[place], np.repeat(n, times))
        cells, n, docs = _summed(group[pairs // width] * width + pairs % width, n, np.ones_like(n))

        langs, sources = (blocks.column(c).combine_chunks().flatten() for c in ("langs", "sources"))
        word = cells % width
        own = _ranges(_bytes(terms), term_ranges)[word] if len(cells) else word
        order = np.lexsort((pc.rank(terms, tiebreaker="first").to_numpy()[word], own)) if len(cells) else word
        edges = np.append(np.flatnonzero(np.diff(own[order], prepend=-1)), len(order))
        blobs = []
        for a, b in zip(edges, edges[1:]):
            at = order[a:b]
            g = pa.array(cells[at] // width)
            blobs.append(_packed(lang=langs.take(g).dictionary_encode(), source=sources.take(g).dictionary_encode(),
                                 term=terms.take(pa.array(word[at])), docs=docs[at].astype(np.int32), n=n[at].astype(np.int32)))
        return pa.table({"range": pa.array(own[order][edges[:-1]], pa.int32()), "counts": pa.array(blobs, pa.binary())})

    return run


def _summed(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ascending distinct keys and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], *(np.add.reduceat(c[order], first) if len(first) else c[:0] for c in counts)


def _kept(counts: DataFrame, ranges: int, rules: AuditRules) -> DataFrame:
    """(lang, term, lang_n, held): terms that enough documents of the language
    have, their occurrences there and in each source that has them."""
    keys = ["lang", "source", "term"]

    def added(parts: list[pa.Table]) -> pa.Table:
        table = pa.concat_tables(parts)
        return table.group_by(keys).aggregate([("docs", "sum"), ("n", "sum")]).rename_columns([*keys, "docs", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows, held = [], 0, 0
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                part = _unpacked(blob)
                parts.append(pa.table({
                    "lang": _column(part, "lang").cast(pa.string()), "source": _column(part, "source").cast(pa.string()),
                    "term": part.column("term"), "docs": part.column("docs").cast(pa.int64()), "n": part.column("n").cast(pa.int64())}))
                rows += len(part)
                if rows > 2 * held + 1_000_000:
                    parts = [added(parts)]
                    rows = held = len(parts[0])
        if not parts:
            return
        table = added(parts).sort_by([("lang", "ascending"), ("term", "ascending"), ("source", "ascending")])
        lang, term = (_column(table, c).dictionary_encode().indices.to_numpy().astype(np.int64) for c in ("lang", "term"))
        first = np.flatnonzero(np.diff(lang << 32 | term, prepend=-1))  # a language's term is a run of rows
        docs, n = (np.add.reduceat(table.column(c).to_numpy(), first) for c in ("docs", "n"))
        good = docs >= rules.least_documents
        sizes = np.diff(np.append(first, len(table)))
        table, first = table.filter(pa.array(np.repeat(good, sizes))), first[good]
        sizes = sizes[good]
        starts = np.cumsum(sizes) - sizes
        held = pa.StructArray.from_arrays([_column(table, "source"), _column(table, "n")], names=["source", "n"])
        for a in range(0, len(sizes), 10_000):
            b = min(a + 10_000, len(sizes))
            rows = pa.array(starts[a:b])
            to = starts[b - 1] + sizes[b - 1]
            yield pa.RecordBatch.from_arrays(
                [_column(table, "lang").take(rows), _column(table, "term").take(rows).cast(pa.string()), pa.array(n[good][a:b]),
                 pa.ListArray.from_arrays(pa.array(np.append(starts[a:b], to) - starts[a], pa.int32()), held.slice(starts[a], to - starts[a]))],
                names=["lang", "term", "lang_n", "held"])

    return staged(in_arrow(counts.repartition(ranges, "range").select("counts"), run,
                           "lang string, term string, lang_n long, held array<struct<source: string, n: long>>"), "kept")


def kept_terms(blocks: DataFrame, rules: AuditRules) -> DataFrame:
    least = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sums = blocks.agg(F.sum("n_chunks"), F.sum("n_pairs")).first()
    ranges, term_ranges = (max(least, -(-(n or 0) // rules.range_rows)) for n in sums)
    answers = _answers(_asked(blocks, ranges))
    counts = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        tidy(_known(ranges, term_ranges)), "range int, counts binary")
    return _kept(counts, term_ranges, rules)


# ---- sources against each other ---------------------------------------------

def shares(counts: np.ndarray, total: np.ndarray | int, unit: int = 1_000_000_000) -> np.ndarray:
    """1 + floor(unit * counts / total) by long division, three digits at a
    time, so that nothing overflows below 9 * 10**15. counts <= total; unit a power of 1000."""
    out, rest = np.divmod(np.asarray(counts, np.int64), total)
    while unit > 1:
        digits, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + digits
        unit //= 1000
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)**2 / (p + q)) of shares."""
    return (p - q) ** 2 // (p + q)


def _tile(rules: AuditRules):
    def run(terms: pa.Table, groups: pa.Table) -> pa.Table:
        """Pairs' sums over one tile's terms, and its best terms of every source."""
        groups = groups.sort_by("source")
        lang, source = groups.column("lang")[0], groups.column("source").combine_chunks()
        own, kept, everywhere = (groups.column(c).to_numpy() for c in ("n", "kept", "lang_n"))
        s, t = len(source), terms.num_rows
        sums = np.zeros((s, s), np.int64)
        best = (np.empty(0, np.int64),) * 3
        if t:
            held = terms.column("held").combine_chunks()
            row = np.repeat(np.arange(t), np.diff(held.offsets.to_numpy()))
            held = held.flatten()
            column = pc.index_in(held.field("source"), value_set=source).to_numpy()
            p = np.repeat(shares(np.full(s, 2), own + 2 * kept, rules.unit)[None], t, axis=0)
            p[row, column] = shares(held.field("n").to_numpy() + 2, (own + 2 * kept)[column], rules.unit)
            for k in range(s - 1):
                sums[k, k + 1:] = divergence(p[:, k:k + 1], p[:, k + 1:]).sum(axis=0)
            sums += sums.T
            q = shares(terms.column("lang_n").to_numpy() + 2, everywhere[0] + 2 * kept[0], rules.unit)
            more = p[row, column] > q[row]
            row, column = row[more], column[more]
            value = divergence(p[row, column], q[row])
            words = terms.column("term").cast(pa.binary()).to_pylist()
            place = np.empty(t, np.int64)
            place[sorted(range(t), key=words.__getitem__)] = np.arange(t)
            order = np.lexsort((place[row], -value, column))
            column = column[order]
            nth = np.arange(len(column)) - np.searchsorted(column, column)
            top = nth < rules.top
            best = (column[top], row[order][top], value[order][top])
        one, other = np.nonzero(~np.eye(s, dtype=bool))
        items = pa.concat_arrays([source.take(pa.array(other)), terms.column("term").combine_chunks().take(pa.array(best[1])).cast(source.type)])
        n = len(one) + len(best[0])
        return pa.table({
            "lang": pa.array([lang.as_py()] * n, pa.string()), "source": source.take(pa.array(np.concatenate([one, best[0]]))),
            "part": pa.array(["pair"] * len(one) + ["term"] * len(best[0]), pa.string()), "item": items,
            "value": pa.array(np.concatenate([sums[one, other], best[2]]), pa.int64())})

    return run


def divergences(docs: DataFrame, rules: AuditRules = AuditRules()) -> DataFrame:
    """lang, source, part, item, value, rank of documents' text, lang and source.

    Part ``pair``: every other source of the language by its divergence summed
    over all kept terms. Part ``term``: kept terms that the source has more
    often than its language, by divergence, to the rank ``top``.
    """
    blocks = _blocks(docs, rules)
    kept = kept_terms(blocks, rules)
    sizes = kept.select("lang", F.explode("held").alias("h")).groupBy("lang", F.col("h.source").alias("source")).agg(F.sum("h.n").alias("n"))
    present = blocks.select(F.explode(F.arrays_zip("langs", "sources")).alias("g")).select("g.langs", "g.sources").distinct().toDF("lang", "source")
    groups = staged(present.join(sizes, ["lang", "source"], "left").fillna(0, ["n"]), "groups")
    per_lang = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources")).join(
        kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_n")), "lang", "left"
    ).fillna(0, ["kept", "lang_n"]).withColumn(
        "tiles", F.greatest(F.lit(1), F.ceil(F.col("kept") * F.col("n_sources") / rules.tile_cells)).cast("int"))
    per_lang = staged(per_lang, "langs")

    tiled = join_sized(kept, per_lang.select("lang", "tiles"), ["lang"]).withColumn(
        "tile", F.pmod(F.xxhash64("term"), F.col("tiles")).cast("int")).drop("tiles")
    everywhere = join_sized(groups, per_lang.drop("n_sources"), ["lang"]).withColumn(
        "tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).drop("tiles")
    parts = staged(tiled.groupBy("lang", "tile").cogroup(everywhere.groupBy("lang", "tile")).applyInArrow(
        tidy(_tile(rules)), "lang string, source string, part string, item string, value long"), "parts")

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = parts.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    found = pairs.withColumn("rank", F.row_number().over(best)).union(
        parts.where("part = 'term'").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= rules.top))
    return found.select("lang", "source", "part", "item", "value", "rank")
