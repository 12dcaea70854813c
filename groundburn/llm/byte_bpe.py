"""Byte-level BPE by DuckDB queries inside each task.

A text is cut into pieces by the tokenizer's pattern. The pieces that a worker
has not met yet go, many at once, through a recursive query: rows of (piece,
position, token, next token) are joined with the merge table; in each round
every piece contracts its leftmost pair of least rank, until no pair is in the
table. Decoding cuts ids into runs, joins the unseen runs' (position, id) rows
with the vocabulary and aggregates the bytes in order.

Nothing is shuffled; what a worker keeps is bounded by :class:`BpeRules`.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundburn.llm.base import carried, ddl, in_arrow, worker_cache


@dataclass(frozen=True)
class BpeRules:
    ranks: str                     # file of base64 tokens and ranks, at the same path on every machine
    pattern: str                   # cuts a text into pieces that merge on their own
    long_piece: int = 128          # bytes; a longer piece would take as many rounds, it merges by a heap
    cached: int = 300_000          # pieces, and runs of ids, in each of a cache's two generations: about 45 MB each
    query_rows: int = 200_000      # rows that one query starts with, about
    memory_mb: int = 200           # of one worker's DuckDB


_ENCODE = """
WITH RECURSIVE t(piece, pos, id, nid, done) AS (
    SELECT piece, pos, id, nid, false FROM start
    UNION ALL
    (WITH r AS (
        SELECT t.piece, t.pos, t.id, t.nid, (m.rank << 32) + t.pos AS key
        FROM t LEFT JOIN merges m ON m.pair = (t.id << 32 | t.nid)
        WHERE NOT t.done
    ), b AS (
        SELECT piece, min(key) AS best FROM r GROUP BY piece
    ), c AS (
        -- One sort for all pieces: a piece's last token has no key, so nothing reaches from one into the next.
        SELECT r.*, best, lag(key) OVER w AS key_before, lead(key) OVER w AS key_after, lead(nid) OVER w AS nid_after
        FROM r JOIN b USING (piece) WINDOW w AS (ORDER BY piece, pos)
    )
    SELECT piece, pos,
           CASE WHEN key = best THEN best >> 32 ELSE id END,
           CASE WHEN key = best THEN nid_after WHEN key_after = best AND nid IS NOT NULL THEN best >> 32 ELSE nid END,
           best IS NULL
    FROM c WHERE best IS NULL OR key_before IS DISTINCT FROM best)
)
SELECT piece, list(id ORDER BY pos) AS ids FROM t WHERE done GROUP BY piece ORDER BY piece
"""

_DECODE = """
SELECT s.run, string_agg(v.bytes, '' ORDER BY s.pos) AS bytes
FROM start s JOIN vocabulary v USING (id) GROUP BY s.run ORDER BY s.run
"""


class _Cache:
    """Results in two generations: what was asked for lately outlives a full cache."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def missing(self, keys: set) -> list:
        """Keys that neither generation has; all others are in ``new`` afterwards."""
        if len(self.new) > self.size:
            self.old, self.new = self.new, {}
        unseen = keys - self.new.keys()
        kept = unseen & self.old.keys()
        self.new.update((k, self.old[k]) for k in kept)
        return list(unseen - kept)


class Codec:
    """One worker's tables, connection and caches."""

    def __init__(self, rules: BpeRules):
        self.rules = rules
        with open(rules.ranks, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))}
        self.pattern = regex.compile(rules.pattern)
        self.single = [self.ranks[bytes([b])] for b in range(256)]
        self.known, self.runs = _Cache(rules.cached), _Cache(rules.cached)
        size = max(self.ranks.values()) + 1
        self.decimal = [b"%d" % i for i in range(size)]
        #: Ids at which a run begins: those of tokens that begin with ASCII white space or a mark, as pieces do.
        self.begins = np.zeros(size, dtype=bool)
        self.begins[[i for t, i in self.ranks.items() if t[0] < 128 and not t[:1].isalnum()]] = True
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": f"{rules.memory_mb}MB"})
        splits = [(self.ranks[t[:i]] << 32 | self.ranks[t[i:]], r) for t, r in self.ranks.items()
                  for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        merges = pa.table({"pair": pa.array([s[0] for s in splits], pa.int64()), "rank": pa.array([s[1] for s in splits], pa.int64())})
        # A byte as the character of its number, so that SQL can put tokens together as text.
        vocabulary = pa.table({"id": pa.array(self.ranks.values(), pa.int64()), "bytes": [t.decode("latin-1") for t in self.ranks]})
        self._sql("CREATE TABLE merges AS SELECT * FROM given", merges)
        self._sql("CREATE TABLE vocabulary AS SELECT * FROM given", vocabulary)

    def _sql(self, query: str, rows: pa.Table) -> None:
        self.con.register("given", rows)
        self.con.execute(query)
        self.con.unregister("given")

    def _asked(self, query: str, start: pa.Table) -> pa.Table:
        self.con.register("start", start)
        found = self.con.sql(query).to_arrow_table()
        self.con.unregister("start")
        return found

    def learn(self, pieces: Iterable[str]) -> None:
        """Puts the ids of unseen pieces into ``known``."""
        waiting: list[str] = []
        rows = 0
        for piece in pieces:
            token = piece.encode("utf-8", "surrogatepass")
            rank = self.ranks.get(token)
            if rank is not None:
                self.known.new[piece] = rank.to_bytes(4, "little")
            elif len(token) > self.rules.long_piece:
                self.known.new[piece] = np.array(self._merged(token), dtype="<u4").tobytes()
            else:
                waiting.append(piece)
                rows += len(token)
                if rows >= self.rules.query_rows:
                    self._query(waiting)
                    waiting, rows = [], 0
        if waiting:
            self._query(waiting)

    def _query(self, pieces: list[str]) -> None:
        tokens = [p.encode("utf-8", "surrogatepass") for p in pieces]
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        ids = np.array(self.single, dtype=np.int64)[np.frombuffer(b"".join(tokens), np.uint8)]
        ends = np.cumsum(sizes)
        after = np.append(ids[1:], 0)
        last = np.zeros(len(ids), dtype=bool)
        last[ends - 1] = True
        start = pa.table({
            "piece": np.repeat(np.arange(len(tokens)), sizes),
            "pos": np.arange(len(ids)) - np.repeat(ends - sizes, sizes),
            "id": ids, "nid": pa.array(after, mask=last)})
        found = self._asked(_ENCODE, start).column("ids").combine_chunks()
        values = found.values.to_numpy().astype("<u4")
        offsets = found.offsets.to_numpy()
        for k, piece in enumerate(pieces):
            self.known.new[piece] = values[offsets[k]:offsets[k + 1]].tobytes()

    def _merged(self, token: bytes) -> list[int]:
        """The same contraction for one long piece: a heap of pairs over a linked list."""
        ids: list[int | None] = [self.single[b] for b in token]
        parts: list[bytes] = [bytes([b]) for b in token]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        pairs: list[tuple[int, int, int, int]] = []

        def push(i: int) -> None:
            j = after[i]
            if j < len(ids) and (rank := self.ranks.get(parts[i] + parts[j])) is not None:
                heapq.heappush(pairs, (rank, i, ids[i], ids[j]))

        for i in range(len(ids) - 1):
            push(i)
        while pairs:
            rank, i, a, b = heapq.heappop(pairs)
            j = after[i]
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue  # one of the two has been merged since
            ids[i], ids[j] = rank, None
            parts[i] += parts[j]
            after[i] = after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            if before[i] >= 0:
                push(before[i])
            push(i)
        return [i for i in ids if i is not None]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        cut = [self.pattern.findall(t) for t in texts]
        self.learn(self.known.missing(set().union(*cut)))
        known = self.known.new.__getitem__
        return [np.frombuffer(b"".join(map(known, pieces)), dtype="<u4") for pieces in cut]

    def decode(self, sequences: list[np.ndarray]) -> list[bytes]:
        """Bytes of each sequence of ids."""
        sizes = np.fromiter(map(len, sequences), np.int64, len(sequences))
        if not sizes.sum():
            return [b""] * len(sequences)
        ids = np.concatenate(sequences).astype("<u4", copy=False)
        starts = np.cumsum(sizes) - sizes
        begins = np.append(self.begins[ids], True)
        begins[starts] = True
        edges = np.flatnonzero(begins)
        # Runs as binary values over the ids' own bytes, numbered by Arrow.
        cut = pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer((edges * 4).astype(np.int32)), pa.py_buffer(ids)]).dictionary_encode()
        runs = cut.dictionary.to_numpy(zero_copy_only=False).tolist()
        asked, rows = [], 0
        for run in self.runs.missing(set(runs)):
            asked.append(run)
            rows += len(run) // 4
            if rows >= self.rules.query_rows:
                self._decode(asked)
                asked, rows = [], 0
        if asked:
            self._decode(asked)
        own = list(map(self.runs.new.__getitem__, runs))
        parts = list(map(own.__getitem__, cut.indices.to_numpy().tolist()))
        first = np.searchsorted(edges, np.append(starts, len(ids))).tolist()
        return [b"".join(parts[i:j]) for i, j in zip(first, first[1:])]

    def _decode(self, runs: list[bytes]) -> None:
        sizes = np.fromiter(map(len, runs), np.int64, len(runs)) // 4
        ids = np.frombuffer(b"".join(runs), dtype="<u4").astype(np.int64)
        found = self._asked(_DECODE, pa.table({
            "run": np.repeat(np.arange(len(runs)), sizes), "pos": np.arange(len(ids)), "id": ids}))
        texts = found.column("bytes").to_numpy().tolist()
        self.runs.new.update(zip(runs, (t.encode("latin-1") for t in texts), strict=True))


@worker_cache
def codec(rules: BpeRules) -> Codec:
    """A worker's codec, kept from task to task."""
    return Codec(rules)


def in_parts(texts: list[str], chars: int = 4_000_000) -> Iterator[list[str]]:
    """Consecutive runs of texts, each of about so many characters at most (or one text)."""
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > chars:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def encoded(docs: DataFrame, rules: BpeRules, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all by default) with ``ids`` array<int>; null text has no ids."""
    keep = carried(docs, keep, "_text ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(rules)
        for batch in batches:
            texts = [t or "" for t in batch.column("_text").to_pylist()]
            ids = [x.astype(np.int32) for part in in_parts(texts) for x in own.encode(part)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(ids, pa.list_(pa.int32()))], names=[*keep, "ids"])

    return in_arrow(docs.select(*keep, F.col(text).alias("_text")), run, f"{ddl(docs, keep)}ids array<int>")


def decoded(rows: DataFrame, rules: BpeRules, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all by default) with ``decoded`` binary; null ids give no bytes."""
    keep = carried(rows, keep, "_ids decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(rules)
        for batch in batches:
            sequences = [np.array(x or [], dtype=np.uint32) for x in batch.column("_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(own.decode(sequences), pa.binary())], names=[*keep, "decoded"])

    return in_arrow(rows.select(*keep, F.col(ids).alias("_ids")), run, f"{ddl(rows, keep)}decoded binary")


def round_trip(docs: DataFrame, rules: BpeRules, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` with n_tokens, ids_sha256 and decoded_sha256: encoded,
    then decoded from the ids, in one pass. Null text counts as empty."""
    keep = carried(docs, keep, "_text n_tokens ids_sha256 decoded_sha256")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(rules)
        decimal = own.decimal.__getitem__
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for part in in_parts([t or "" for t in batch.column("_text").to_pylist()]):
                ids = own.encode(part)
                counts += map(len, ids)
                ids_sha += (hashlib.sha256(b" ".join(map(decimal, x.tolist()))).hexdigest() for x in ids)
                text_sha += (hashlib.sha256(b).hexdigest() for b in own.decode(ids))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=[*keep, "n_tokens", "ids_sha256", "decoded_sha256"])

    return in_arrow(docs.select(*keep, F.col(text).alias("_text")), run, f"{ddl(docs, keep)}n_tokens long, ids_sha256 string, decoded_sha256 string")

