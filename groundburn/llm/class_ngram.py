"""Brown class bigrams: words in classes found by exchange, scored by class
transitions and word emissions.

Words are counted over all training documents. Every word seen ``least`` times
or more, a fixed number, is a word of the exchange; rarer ones, seen or unseen,
belong to one of ``pools`` pools by their last letters, and a pool is exchanged
like a word, so that words seen once speak for the unseen. In each round the
words of one half move to the class that raises the likelihood of all bigrams
most.

Words and their numbers are never in one place. Each block of documents sends
its distinct words, packed, to the task that has their range; that task adds
them up, numbers its words and answers each block with its own words' totals
and numbers. From then on texts are numbers. Only the classes, one byte a word
and in order of the numbers, pass through the driver.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundburn.llm.base import carried, ddl, in_arrow, staged, tidy
from groundburn.llm.word_ids import by_bytes


@dataclass(frozen=True)
class ClassRules:
    classes: int = 48       # class 0 is the end's own
    rounds: int = 6         # half of the words move in each
    least: int = 2          # occurrences that make a word of the exchange
    pools: int = 256        # of all rarer words
    ranked: int = 10_000    # words of one token in so many, and more, begin in classes by rank
    prior: float = 20.0     # tokens' worth of the class unigram in a transition
    block_bytes: int = 16 << 20   # of text in a block
    read_bytes: int = 2 << 20     # of text that a task cuts at a time
    count_chunk: int = 300_000    # distinct words that a task counts before it sends them on
    pair_chunk: int = 1_000_000   # bigrams that a task counts at a time


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def pool_of(word: bytes, pools: int) -> int:
    return zlib.crc32(word[-3:]) % pools


def _packed(words: list[bytes], *numbers) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(
        len(words).to_bytes(4, "little") + np.array(numbers, "<i8").tobytes() + b"\n".join(words))


def _unpacked(blob: bytes, columns: int = 1) -> tuple[list[bytes], *tuple[list[int], ...]]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n = int.from_bytes(data[:4], "little")
    numbers = np.frombuffer(data, "<i8", columns * n, 4).reshape(columns, n).tolist()
    return (data[4 + 8 * columns * n:].split(b"\n") if n else []), *numbers


def _cut(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Every word of some texts, as :func:`words_of` has them, and where each text's begin and end."""
    cut = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    offsets = cut.offsets.to_numpy()
    found = cut.flatten().dictionary_encode()
    blank = pc.index(found.dictionary, pa.scalar("", pa.string())).as_py()
    if blank < 0:
        return found, offsets - offsets[0]
    kept = found.indices.to_numpy() != blank  # what precedes white space at a text's beginning, or follows it at its end
    ends = np.append(0, np.cumsum(kept))[offsets - offsets[0]]
    return found.filter(pa.array(kept)), ends


def _in_blocks(docs: DataFrame, rules: ClassRules) -> DataFrame:
    """``docs`` with _block: consecutive rows of about so many bytes of text in the same partition."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            upto = size + np.cumsum(pc.fill_null(pc.binary_length(batch.column("_text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            block = base + np.append(size, upto)[:-1] // rules.block_bytes
            size = int(upto[-1]) if len(upto) else size
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(block)], names=[*names, "_block"])

    return in_arrow(docs, run, f"{ddl(docs, names)}_block long")


def _requests(blocks: DataFrame, ranges: int, rules: ClassRules) -> DataFrame:
    """(range, block, words, tokens): each block's words with their counts in
    training documents, 0 where only others have them."""
    limit = rules.count_chunk

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def added(parts: list[pa.Table]) -> pa.Table:
            return pa.concat_tables(parts).group_by("w").aggregate([("n", "sum")]).rename_columns(["w", "n"])

        def sent(block: int, table: pa.Table) -> pa.RecordBatch:
            table = table.sort_by("w")
            words = table.column("w").combine_chunks().cast(pa.binary()).to_numpy(zero_copy_only=False)
            counts = table.column("n").to_numpy()
            own = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % ranges
            some = np.unique(own)
            parts = [np.flatnonzero(own == k) for k in some]
            return pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array([block] * len(some), pa.int64()),
                 pa.array([_packed(words[p].tolist(), counts[p]) for p in parts], pa.binary()), pa.array([int(counts[p].sum()) for p in parts], pa.int64())],
                names=["range", "block", "words", "tokens"])

        at, held = None, []
        for batch in batches:
            blocks_of = batch.column(0).to_numpy()
            edges = np.append(np.flatnonzero(np.diff(blocks_of, prepend=-1)), len(blocks_of))
            for a, b in zip(edges, edges[1:]):
                if held and blocks_of[a] != at:  # none are held where a block's last words have just been sent
                    yield sent(at, added(held))
                    held = []
                at = int(blocks_of[a])
                out = batch.column(1).slice(a, b - a).to_numpy(zero_copy_only=False)
                done = 0
                for texts in by_bytes(batch.column(2).slice(a, b - a), rules.read_bytes):
                    found, ends = _cut(texts)
                    counted = np.repeat(~out[done:done + len(texts)], np.diff(ends))
                    done += len(texts)
                    n = np.bincount(found.indices.to_numpy()[counted], minlength=len(found.dictionary))
                    held.append(pa.table({"w": found.dictionary, "n": pa.array(n, pa.int64())}))
                    if sum(map(len, held)) > limit:
                        held = [added(held)]
                        if len(held[0]) > limit:
                            yield sent(at, held[0])
                            held = []
        if held:
            yield sent(at, added(held))

    return in_arrow(blocks.select("_block", "held_out", "_text"), run, "range int, block long, words binary, tokens long")


def _answers(requests: DataFrame, ranges: int, hot: int, rules: ClassRules) -> DataFrame:
    """(block, range, n, words): totals and numbers within the range for each
    block's words, -1 for words of a pool. Block -1 has how many words the range
    numbers, and those of at least ``hot`` tokens; block -2 the pools' types."""
    pools, least = rules.pools, rules.least

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, bytes]]] = {}
        for batch in batches:
            for k, block, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                held.setdefault(k, []).append((block, blob))
        for k, sent in held.items():
            total: Counter[bytes] = Counter()
            for _, blob in sent:
                for w, n in zip(*_unpacked(blob), strict=True):
                    total[w] += n
            number = {w: i for i, w in enumerate(sorted(w for w, n in total.items() if n >= least))}
            often = [w for w in number if total[w] >= hot]
            types = np.zeros(pools, np.int64)
            for w, n in total.items():
                if 0 < n < least:
                    types[pool_of(w, pools)] += 1
            out = [(-1, k, len(number), _packed(often, [total[w] for w in often], [number[w] for w in often])),
                   (-2, k, 0, _packed([b""] * pools, types.tolist()))]
            for block, blob in sent:
                words = _unpacked(blob)[0]
                out.append((block, k, len(words), _packed(words, [total[w] for w in words], [number.get(w, -1) for w in words])))
                if len(out) >= 64:
                    yield _blobs(out)
                    out = []
            if out:
                yield _blobs(out)

    return in_arrow(requests.select("range", "block", "words").repartition(ranges, "range"), run, "block long, range int, n long, words binary")


def _blobs(out: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    block, k, n, words = zip(*out, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(block, pa.int64()), pa.array(k, pa.int32()), pa.array(n, pa.int64()), pa.array(words, pa.binary())],
        names=["block", "range", "n", "words"])


def _numbered(first: dict[int, int], keep: list[str], whole: float, rules: ClassRules):
    """Texts as packed numbers, with what is known of their tokens without
    classes. ``first``: number of the first word of each range. Pools come
    before the words, from 1 on."""
    pools, read_bytes = rules.pools, rules.read_bytes

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        values, counts, numbers = [], [], []
        for k, blob in zip(answers.column("range").to_pylist(), answers.column("words").to_pylist(), strict=True):
            words, n, local = _unpacked(blob, 2)
            values.append(pa.array(words, pa.binary()).cast(pa.string()))
            counts.append(np.array(n, np.int64))
            local = np.array(local, np.int64)
            number = local + first[k]
            for i in np.flatnonzero(local < 0).tolist():
                number[i] = 1 + pool_of(words[i], pools)
            numbers.append(number.astype("<i4"))
        known = pa.concat_arrays(values) if values else pa.array([], pa.string())
        c, number = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (counts, numbers))
        logs = np.log10(c + 0.5)
        pack = zstandard.ZstdCompressor(level=1).compress
        sizes, seen, own, ids = [], [], [], []
        for chunk in docs.column("_text").chunks:
            for texts in by_bytes(chunk, read_bytes):
                found, ends = _cut(texts)
                place = pc.index_in(found.dictionary, value_set=known).to_numpy(zero_copy_only=False)[found.indices.to_numpy()]
                some = np.append(0, np.cumsum(c[place] > 0))
                sizes.append(np.diff(ends))
                own += [float(logs[place[a:b]].sum()) for a, b in zip(ends, ends[1:])]
                seen.append(np.diff(some[ends]))
                ids += [pack(number[place[a:b]].astype("<i4").tobytes()) for a, b in zip(ends, ends[1:])]
        n, seen = (np.concatenate(x).astype(np.int64) if x else np.empty(0, np.int64) for x in (sizes, seen))
        own = np.array(own, np.float64)
        return pa.table({**{k: docs.column(k) for k in keep}, "_n": n, "_known": seen, "_base": own - n * whole, "_own": own,
                         "_ids": pa.array(ids, pa.binary())})

    return run


def _ids(column: pa.Array) -> Iterator[np.ndarray]:
    unpack = zstandard.ZstdDecompressor().decompress
    for blob in column.to_pylist():
        yield np.frombuffer(unpack(blob), "<i4")


def _bigrams(numbered: DataFrame, rules: ClassRules) -> DataFrame:
    """(cells): packed bigrams of word numbers, first word << 32 | second, with
    their counts in one stretch of texts; 0 is the end, before and after each text."""
    limit = rules.pair_chunk

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(parts: list[np.ndarray]) -> pa.RecordBatch:
            ids = np.concatenate(parts).astype(np.int64)
            pairs, n = np.unique(ids[:-1] << 32 | ids[1:], return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array([_cells(pairs, n)], pa.binary())], names=["cells"])

        end = np.zeros(1, np.int32)
        parts, size = [end], 0
        for batch in batches:
            for ids in _ids(batch.column(0)):
                parts += [ids, end]
                size += len(ids) + 1
                if size >= limit:
                    yield counted(parts)
                    parts, size = [end], 0
        if size:
            yield counted(parts)

    return staged(in_arrow(numbered.where("not held_out").select("_ids"), run, "cells binary"), "bigrams")


def _class_counts(bigrams: DataFrame, of: np.ndarray, classes: int) -> np.ndarray:
    """Bigrams of classes, classes x classes."""
    shared = bigrams.sparkSession.sparkContext.broadcast(of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(classes * classes, np.int64)
        for batch in batches:
            for a, b, n in map(_pairs, batch.column(0).to_pylist()):
                cell = shared.value[a].astype(np.int64) * classes + shared.value[b]
                total += np.bincount(cell, n, classes * classes).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["cell", "n"])

    out = np.zeros(classes * classes, np.int64)
    for row in in_arrow(bigrams, run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():  # classes squared
        out[row["cell"]] = row["n"]
    shared.destroy()
    return out.reshape(classes, classes)


def _cells(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending keys and their counts: differences and counts, byte by byte, compressed."""
    both = np.concatenate([np.diff(keys, prepend=0), counts]).astype("<i8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(both).tobytes())


def _uncells(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1).T
    keys, counts = np.split(np.ascontiguousarray(both).view("<i8").ravel(), 2)
    return np.cumsum(keys), counts


def _pairs(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys, n = _uncells(blob)
    return keys >> 32, keys & 0xFFFFFFFF, n


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def best_classes(left: np.ndarray, right: np.ndarray, own: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each word, the class in which it adds most to the bigrams' likelihood.

    left, right: words x counts of the classes before and after the word.
    counts: bigrams of classes with each word in its class ``own``. Class 0 is
    not offered. A word's bigrams with itself are taken as with its old class.
    """
    counts = counts.astype(np.float64)
    each = np.arange(len(own))

    def gains(context: np.ndarray, other: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Of the cells of one side; only classes that are met there matter."""
        w, k = np.nonzero(context)
        n = context[w, k][:, None]
        rest = cells.T[k]  # without the word
        rest[k == own[w]] -= other[w[k == own[w]]]
        rest[np.arange(len(w)), own[w]] -= n[:, 0]
        np.maximum(rest, 0, out=rest)
        out = np.zeros(context.shape)
        some, first = np.unique(w, return_index=True)
        if len(some):
            out[some] = np.add.reduceat(_xlogx(rest + n) - _xlogx(rest), first)
        return out

    gain = gains(right, left, counts) + gains(left, right, counts.T)
    own_cell = np.repeat(counts.diagonal()[None], len(own), 0)  # gets both sides of the word
    own_cell[each, own] -= right[each, own] + left[each, own]
    own_cell = np.maximum(own_cell, 0)
    gain += _xlogx(own_cell + right + left) - _xlogx(own_cell + right) - _xlogx(own_cell + left) + _xlogx(own_cell)
    for mine, sums in ((right, counts.sum(1)), (left, counts.sum(0))):  # the other side's bigrams stay in these sums, whatever the class
        all_mine = mine.sum(1)
        rest = np.repeat(sums[None], len(own), 0)
        rest[each, own] -= all_mine
        gain -= _xlogx(rest + all_mine[:, None]) - _xlogx(rest)
    gain[:, 0] = -np.inf
    return gain.argmax(1)


def best_class(left: np.ndarray, right: np.ndarray, own: int, counts: np.ndarray) -> int:
    return int(best_classes(left[None], right[None], np.array([own]), counts)[0])


def _moved(bigrams: DataFrame, of: np.ndarray, counts: np.ndarray, turn: int, parts: int, classes: int) -> np.ndarray:
    """Classes after one round: every word of this turn's half picks its best."""
    shared = bigrams.sparkSession.sparkContext.broadcast((of, counts))
    wide = 2 * classes

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value[0]
        for batch in batches:
            for a, b, n in map(_pairs, batch.column(0).to_pylist()):
                second, first = ((x > 0) & (x % 2 == turn % 2) for x in (b, a))
                word = np.concatenate([b[second], a[first]])
                slot = np.concatenate([own[a[second]].astype(np.int64), classes + own[b[first]].astype(np.int64)])
                # By part, then word, then slot.
                key, n = _summed((word // 2 % parts) << 48 | word // 2 // parts * wide + slot, np.concatenate([n[second], n[first]]))
                edges = np.searchsorted(key, np.arange(parts + 1) << 48)
                some = np.flatnonzero(np.diff(edges))
                key &= (1 << 48) - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int32()), pa.array([_cells(key[edges[k]:edges[k + 1]], n[edges[k]:edges[k + 1]]) for k in some], pa.binary())],
                    names=["part", "cells"])

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for part, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.setdefault(part, []).append(_uncells(blob))
        of, counts = shared.value
        for part, found in held.items():
            key, n = _summed(*(np.concatenate(x) for x in zip(*found, strict=True)))
            words, first = np.unique(key // wide, return_index=True)
            first = np.append(first, len(key))
            words = (words * parts + part) * 2 + turn % 2
            best = []
            for at in range(0, len(words), 2000):
                to = min(at + 2000, len(words))
                table = np.zeros((to - at, wide))
                cells = slice(first[at], first[to])
                table[np.repeat(np.arange(to - at), np.diff(first[at:to + 1])), key[cells] % wide] = n[cells]
                best.append(best_classes(table[:, :classes], table[:, classes:], of[words[at:to]].astype(np.int64), counts))
            yield pa.RecordBatch.from_arrays(
                [pa.array([words.astype("<i4").tobytes()], pa.binary()), pa.array([np.concatenate(best).astype("<i2").tobytes()], pa.binary())], names=["w", "c"])

    sent = in_arrow(bigrams, contexts, "part int, cells binary").repartition(parts, "part")
    out = of.copy()
    for row in in_arrow(sent, move, "w binary, c binary").toLocalIterator():  # six bytes a word
        out[np.frombuffer(row["w"], "<i4")] = np.frombuffer(row["c"], "<i2")
    shared.destroy()
    return out


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct keys and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], (np.add.reduceat(counts[order], first) if len(first) else counts)


@dataclass
class ClassModel:
    """Classes by word number; log10 of transitions and of what a class's token
    count is divided by; tokens in training; the end's share of the base score
    and whether it was seen."""

    of: np.ndarray
    transition: np.ndarray
    divisor: np.ndarray
    tokens: int
    base_end: float
    end_known: int


def _scored(model, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            score = []
            for ids, own in zip(_ids(batch.column("_ids")), batch.column("_own").to_pylist(), strict=True):
                of = m.of[ids]
                path = np.concatenate([[0], of, [0]])
                score.append(own + float(m.transition[path[:-1], path[1:]].sum() - m.divisor[of].sum()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keep), pc.add(batch.column("_n"), 1), pc.add(batch.column("_known"), m.end_known),
                 pa.array([m.tokens] * len(score), pa.int64()), pc.add(batch.column("_base"), m.base_end), pa.array(score, pa.float64())],
                names=[*keep, "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def scored(docs: DataFrame, held_out: Column, text: str = "text", keep: list[str] | None = None,
           rules: ClassRules = ClassRules()) -> DataFrame:
    """Learns from the rows where ``held_out`` is false and scores all rows.

    Returns ``keep`` (all columns by default, but for the names below), held_out, n_tokens, n_known, train_tokens, base_score (add-half
    unigram) and score (log10 probability under the class model; perplexity is
    10 ** (-score / n_tokens)). Null texts count as empty: one end token.
    Without training rows every count is 0 and both scores are finite.
    """
    keep = carried(docs, keep, "_text _block _n _known _base _own _ids held_out n_tokens n_known train_tokens base_score score")
    spark = docs.sparkSession
    ranges = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    blocks = staged(_in_blocks(docs.select(*keep, held_out.alias("held_out"), F.col(text).cast("string").alias("_text")), rules), "blocks")
    requests = staged(_requests(blocks, ranges, rules), "requests")
    ends = blocks.where("not held_out").count()
    words = requests.agg(F.sum("tokens")).first()[0] or 0
    answers = staged(_answers(requests, ranges, max(1, -(-words // rules.ranked)), rules), "answers")

    size = 1 + rules.pools
    first: dict[int, int] = {}
    often: list[tuple[bytes, int, int]] = []
    for row in answers.where("block = -1").orderBy("range").toLocalIterator():  # at most ``ranked`` words in all
        first[row["range"]] = size
        often += ((w, n, size + i) for w, n, i in zip(*_unpacked(row["words"], 2), strict=True) if i >= 0)
        size += row["n"]
    pool_types = np.zeros(rules.pools, np.int64)
    for row in answers.where("block = -2").toLocalIterator():  # one small row per range
        pool_types += np.array(_unpacked(row["words"])[1])
    tokens = words + ends
    types = size - 1 - rules.pools + int(pool_types.sum()) + (ends > 0)
    whole = float(np.log10(tokens + 0.5 * (types + 1)))

    carry = [*keep, "held_out"]
    schema = ddl(blocks, carry)
    numbered = staged(
        blocks.groupBy("_block").cogroup(answers.where("block >= 0").groupBy("block")).applyInArrow(
            tidy(_numbered(first, carry, whole, rules)), f"{schema}_n long, _known long, _base double, _own double, _ids binary"), "numbered")

    c = rules.classes
    of = (np.arange(size) % (c - 1) + 1).astype(np.min_scalar_type(c))
    for rank, (_, _, k) in enumerate(sorted(often, key=lambda x: (-x[1], x[0]))):  # so that the most frequent words begin apart
        of[k] = rank % (c - 1) + 1
    of[0] = 0
    bigrams = _bigrams(numbered, rules)
    for turn in range(rules.rounds):
        of = _moved(bigrams, of, _class_counts(bigrams, of, c), turn, ranges, c)
    counts = _class_counts(bigrams, of, c).astype(np.float64)
    class_tokens = counts.sum(0)
    class_types = np.bincount(of[1:], weights=np.concatenate([pool_types, np.ones(size - 1 - rules.pools)]), minlength=c)
    share = (class_tokens + 0.5) / (class_tokens.sum() + 0.5 * c)
    transition = np.log10((counts + rules.prior * share) / (counts.sum(1, keepdims=True) + rules.prior))
    divisor = np.log10(class_tokens + 0.5 * (class_types + 1))
    model = spark.sparkContext.broadcast(
        ClassModel(of, transition, divisor, tokens, float(np.log10(ends + 0.5)) - whole, int(ends > 0)))
    return in_arrow(numbered, _scored(model, carry), f"{schema}n_tokens long, n_known long, train_tokens long, base_score double, score double")
