"""Near-duplicate texts by consistent weighted sampling.

A text is a weighted set: its shingles of five words, each weighing its count
times its inverse document frequency. Improved consistent weighted sampling
draws (shingle, level) samples that two texts share with the probability of
their weighted Jaccard similarity. Samples are banded; texts that share a band
are compared by that similarity itself; links of 0.8 or more make classes.

Document frequencies are counted over all documents. The weight falls to 1 with the logarithm of the frequency, from one in ``rare`` documents up;
only shingles that frequent have to be known when weighing, and no more than
``rare`` times the mean number of shingles of a document can be.

Equal texts are one node. In a bucket every text is first compared with a
leader of its own for that band. Where a bucket then still spans several
classes, its texts are compared across the classes too, in tiles of bounded
size whose pairs are never emitted, only the links that join classes. So no
link between texts that share a band is lost, and a group of copies costs one
comparison for each text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundburn.llm.base import in_arrow, mixed, staged, text_bytes


@dataclass(frozen=True)
class NearDupRules:
    words: int = 5              # of a shingle
    similarity: float = 0.8
    bands: int = 10             # with 3 samples each, 0.8 is missed once in 1,200 pairs
    samples: int = 3
    idf_spread: float = 0.1     # the rarest shingles weigh so much more than the most frequent; a larger
    #                             one would part the copies of a large group, whose common text is frequent
    rare: int = 1000            # one document in so many, and fewer, all weigh the same
    chunk: int = 100_000        # shingles sampled at a time
    tile: int = 400             # texts of a bucket compared in one place
    count_chunk: int = 3_000_000  # shingles of a task counted before they are sent on


def shingles(text: bytes, n: int) -> np.ndarray:
    """48-bit ids of the text's shingles, in order, repeats included; of fewer
    words all make one shingle; none for no words."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    size = max(1, len(h) - n + 1)
    total = np.zeros(size, np.uint64)
    for k in range(min(n, len(h))):
        total = (total ^ h[k:k + size]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    return mixed(total) >> np.uint64(16)


def _packed(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted ids and counts, small when compressed: differences, byte by byte."""
    steps = np.diff(ids, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(steps).tobytes() + counts.astype("<u4").tobytes())


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n = len(data) // 12
    steps = np.frombuffer(data, np.uint8, 8 * n).reshape(8, n).T
    return np.cumsum(np.ascontiguousarray(steps).view(np.uint64).ravel(), dtype=np.uint64), np.frombuffer(data, "<u4", n, 8 * n)


def frequent_shingles(docs: DataFrame, rules: NearDupRules) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids and document counts of shingles in at least one of ``rare`` documents
    (and in two), and the number of documents. ``docs``: one column, the text.

    Every task sends its counts by ranges of ids, packed; each range is summed
    for itself, and only what is frequent goes on.
    """
    spark = docs.sparkSession
    n_docs = docs.count()
    parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    least = max(2, -(-n_docs // rules.rare))
    words, limit = rules.words, rules.count_chunk

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent(waiting: list[np.ndarray]) -> pa.RecordBatch:
            ids, n = np.unique(np.concatenate(waiting), return_counts=True)
            edges = np.searchsorted(ids, (np.arange(parts + 1) * (2.0**48 / parts)).astype(np.uint64))
            edges[-1] = len(ids)
            some = np.flatnonzero(np.diff(edges))
            return pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array([_packed(ids[edges[k]:edges[k + 1]], n[edges[k]:edges[k + 1]]) for k in some], pa.binary())],
                names=["range", "counts"])

        waiting: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for text in text_bytes(batch.column(0)):
                ids = np.unique(shingles(text, words))
                if len(ids):
                    waiting.append(ids)
                    size += len(ids)
                if size >= limit:
                    yield sent(waiting)
                    waiting, size = [], 0
        if waiting:
            yield sent(waiting)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for k, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.setdefault(k, []).append(blob)
        for blobs in held.values():
            pairs = [_unpacked(b) for b in blobs]
            ids = np.concatenate([p[0] for p in pairs])
            n = np.concatenate([p[1] for p in pairs]).astype(np.int64)
            order = np.argsort(ids, kind="stable")
            ids, n = ids[order], n[order]
            first = np.flatnonzero(np.diff(ids, prepend=ids[0] + np.uint64(1)))
            n = np.add.reduceat(n, first)
            often = n >= least
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[first][often].astype(np.int64)), pa.array(n[often])], names=["id", "n"])

    sent_on = in_arrow(docs, counted, "range int, counts binary").repartition(parts, "range")
    found = in_arrow(sent_on, summed, "id long, n long").toArrow()  # bounded, see above
    ids, n = found.column("id").to_numpy().astype(np.uint64), found.column("n").to_numpy()
    order = np.argsort(ids)
    return ids[order], n[order], n_docs


class Weights:
    """Weights of shingles from the frequent ones' counts."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, n_docs: int, rare: int, spread: float):
        self.ids = np.append(ids, np.uint64(2**63))
        share = np.log(np.maximum(counts * rare / max(n_docs, 1), 1)) / np.log(rare)
        self.idf = np.append(1 + spread * (1 - np.minimum(share, 1)), 1 + spread)

    def vector(self, shingle_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, weights and counts."""
        ids, tf = np.unique(shingle_ids, return_counts=True)
        at = np.searchsorted(self.ids, ids)
        return ids, tf * np.where(self.ids[at] == ids, self.idf[at], self.idf[-1]), tf


def weighted_jaccard(a: tuple, b: tuple) -> float:
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][i], b[1][j]).sum()
    whole = a[1].sum() + b[1].sum() - shared
    return float(shared / whole) if whole else 0.0


class Sampler:
    """Samples of weighted sets. The three random numbers of a shingle and a
    sample come from its hash, through tables of quantiles of the gamma
    distribution with shape 2."""

    def __init__(self, rules: NearDupRules):
        self.rules = rules
        u = (np.arange(65536) + 0.5) / 65536
        x = np.full(65536, 1.5)
        for _ in range(60):  # 1 - (1 + x) exp(-x) = u, by Newton's method in log x
            e = np.exp(-x)
            x *= np.exp(np.clip((u - 1 + (1 + x) * e) / (x * x * e), -1, 1))
        self.gamma, self.log_gamma, self.uniform = x, np.log(x), u
        self.seeds = mixed(np.arange(1, rules.bands * rules.samples + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def bands(self, vectors: list[tuple]) -> np.ndarray:
        """Hashes of the bands, a row for each vector; none may be empty."""
        sizes = np.array([len(v[0]) for v in vectors])
        starts = np.cumsum(sizes) - sizes
        ids, log_w = np.concatenate([v[0] for v in vectors]), np.log(np.concatenate([v[1] for v in vectors]))
        of = np.repeat(np.arange(len(vectors)), sizes)
        low = np.uint64(0xFFFF)
        out = np.zeros((len(vectors), self.rules.bands), np.uint64)
        for k, seed in enumerate(self.seeds):
            h = mixed(ids ^ seed)
            r, beta = self.gamma[h & low], self.uniform[(h >> np.uint64(32)) & low]
            level = np.floor(log_w / r + beta)
            a = self.log_gamma[(h >> np.uint64(16)) & low] - r * (level - beta) - r
            at = np.flatnonzero(a == np.minimum.reduceat(a, starts)[of])
            at = at[np.flatnonzero(np.diff(of[at], prepend=-1))]
            sample = mixed(ids[at] * np.uint64(0x9E3779B97F4A7C15) ^ level[at].astype(np.int64).astype(np.uint64))
            band = k // self.rules.samples
            out[:, band] = mixed(out[:, band] * np.uint64(31) + sample + np.uint64(band))
        return out


def _signed(docs: DataFrame, weights, rules: NearDupRules) -> DataFrame:
    """(key, text) to (key, weight, bands); texts without words give no row."""
    words, chunk = rules.words, rules.chunk

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, own = Sampler(rules), weights.value
        for batch in batches:
            keys: list[str] = []
            vectors: list = []
            size = 0

            def done() -> pa.RecordBatch:
                bands = sampler.bands(vectors).astype(np.int64)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * rules.bands, pa.int32()), pa.array(bands.ravel()))
                return pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array([float(v[1].sum()) for v in vectors]), flat], names=["key", "weight", "bands"])

            for key, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
                ids = shingles(text, words)
                if not len(ids):
                    continue
                keys.append(key)
                vectors.append(own.vector(ids))
                size += len(ids)
                if size >= chunk:
                    yield done()
                    keys, vectors, size = [], [], 0
            if keys:
                yield done()

    return in_arrow(docs, run, "key string, weight double, bands array<long>")


def _linked(pairs: DataFrame, texts: DataFrame, weights, rules: NearDupRules) -> DataFrame:
    """Pairs (a, b) whose texts are as similar as the rules ask."""
    words, least = rules.words, rules.similarity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = weights.value
        last: tuple = (None, None)
        for batch in batches:
            kept_a, kept_b = [], []
            columns = batch.column(0).to_pylist(), batch.column(1).to_pylist(), text_bytes(batch.column(2)), text_bytes(batch.column(3))
            for a, b, ta, tb in zip(*columns, strict=True):
                if last[0] != a:
                    last = a, own.vector(shingles(ta, words))
                if weighted_jaccard(last[1], own.vector(shingles(tb, words))) >= least:
                    kept_a.append(a)
                    kept_b.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(kept_a, pa.string()), pa.array(kept_b, pa.string())], names=["a", "b"])

    met = (
        pairs.join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b")
        .join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a")
    )
    return staged(in_arrow(met.select("a", "b", "text_a", "text_b"), run, "a string, b string"), "links")


def close_pairs(vectors: list, roots: list, least: float) -> list[tuple[int, int]]:
    """Pairs of vectors, enough to join all that are alike across roots.

    All pairs' common weight comes from products of matrices over the
    (shingle, repeat) items that two vectors or more have.
    """
    parent = {r: r for r in roots}

    def find(r):
        while parent[r] != r:
            parent[r] = r = parent[parent[r]]
        return r

    out: list[tuple[int, int]] = []
    n = len(vectors)
    if n <= 4:
        near = [(i, j) for i in range(n) for j in range(i + 1, n)]
    else:
        spread = [_items(v) for v in vectors]
        items, at, count = np.unique(np.concatenate([x[0] for x in spread]), return_inverse=True, return_counts=True)
        rank = np.cumsum(count > 1) - 1
        row = np.repeat(np.arange(n), [len(x[0]) for x in spread])
        unit = np.concatenate([x[1] for x in spread])
        both = count[at] > 1
        col, row, unit = rank[at[both]], row[both], np.sqrt(unit[both])
        common, step = np.zeros((n, n)), max(1, 4_000_000 // n)
        order = np.argsort(col, kind="stable")
        col, row, unit = col[order], row[order], unit[order]
        for low in range(0, int(rank[-1]) + 1, step):
            a, b = np.searchsorted(col, [low, low + step])
            part = np.zeros((n, min(step, int(rank[-1]) + 1 - low)))
            part[row[a:b], col[a:b] - low] = unit[a:b]
            common += part @ part.T
        weight = np.array([v[1].sum() for v in vectors])
        alike = common >= (least - 1e-6) * (weight[:, None] + weight - common)
        near = zip(*np.nonzero(np.triu(alike, 1)), strict=True)
    for i, j in near:
        x, y = find(roots[i]), find(roots[j])
        if x != y and weighted_jaccard(vectors[i], vectors[j]) >= least:
            parent[x] = y
            out.append((int(i), int(j)))
    return out


def _items(vector: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(shingle, repeat) items with their unit weights."""
    ids, weights, tf = vector
    which = np.repeat(np.arange(len(ids)), tf)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(tf) - tf, tf)
    return mixed(ids[which] ^ (nth.astype(np.uint64) << np.uint64(48))), (weights / tf)[which]


def _across(rows: DataFrame, weights, rules: NearDupRules) -> DataFrame:
    """(key, root, place, text): links between the roots of each place."""
    words, least = rules.words, rules.similarity
    parts = max(8, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = weights.value
        keys, roots, vectors, place = [], [], [], None
        links: list[tuple[str, str]] = []

        def finish() -> None:
            if len(set(roots)) > 1:
                links.extend((keys[i], keys[j]) for i, j in close_pairs(vectors, roots, least))

        for batch in batches:
            columns = *(batch.column(k).to_pylist() for k in range(3)), text_bytes(batch.column(3))
            for at, key, root, text in zip(*columns, strict=True):
                if at != place:
                    finish()
                    keys, roots, vectors, place = [], [], [], at
                keys.append(key)
                roots.append(root)
                vectors.append(own.vector(shingles(text, words)))
            yield _pairs(links)
            links.clear()
        finish()
        yield _pairs(links)

    dealt = rows.select("place", "key", "root", "text").repartition(parts, "place").sortWithinPartitions("place")
    return in_arrow(dealt, run, "a string, b string").distinct()


def _pairs(links: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.string()), pa.array([x[1] for x in links], pa.string())], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(key, root): the least key of each key's connected component; only keys
    with links. Alternates large and small stars until every edge leads from a
    key to a root."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    while True:
        # Of each key: the least key around it, and whether it already stands where it should.
        ends = edges.select("a", "b", F.col("b").alias("up")).union(edges.select("b", "a", F.lit(None).cast("string")))
        around = ends.groupBy("a").agg(
            F.least("a", F.min("b")).alias("m"), F.min("up").alias("low"), F.max("up").alias("high"), F.bool_or(F.col("up").isNull()).alias("met"))
        if around.where("low <> high or (low is not null and met)").isEmpty():
            break
        large = edges.join(around.select(F.col("a").alias("b"), "m"), "b").select("a", F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        edges = staged(large.join(least, "a").select(F.col("b").alias("x"), "m").where("x <> m")
                       .union(least.select("a", "m")).toDF("a", "b").distinct(), "stars")
    return around.select(F.col("a").alias("key"), "m").toDF("key", "root")


def _key(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def classes(docs: DataFrame, rules: NearDupRules = NearDupRules(), text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, key (of the text), class_id and
    class_key (doc_id and key of the class's first row), class_size.

    The first row of a class is that of the least doc_id. Null texts and texts
    without words are like nothing: class_id is their own doc_id and key null.
    Rows whose texts are equal are in one class.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    worded = rows.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).withColumn("key", _key(F.col("text")))
    weights = spark.sparkContext.broadcast(
        Weights(*frequent_shingles(rows.where("text is not null").select("text"), rules), rules.rare, rules.idf_spread))

    signed = _signed(worded.select("key", "text"), weights, rules)
    nodes = staged(signed.groupBy("key").agg(F.first("weight").alias("weight"), F.first("bands").alias("bands")), "nodes")
    members = nodes.select("key", F.posexplode("bands").alias("band", "bucket"))
    leaders = members.groupBy("band", "bucket").agg(
        F.min_by("key", F.xxhash64("key", "band")).alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = staged(members.join(leaders, ["band", "bucket"]).select("band", "bucket", "key", "leader"), "buckets")
    tried = staged(
        shared.where("key <> leader").select(F.least("key", "leader").alias("a"), F.greatest("key", "leader").alias("b")).distinct(), "pairs")
    wanted = shared.select("key").distinct()
    texts = staged(
        worded.join(wanted, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text")), "texts")
    links = _linked(tried, texts, weights, rules)
    roots = staged(components(links), "roots")

    # Buckets that still span several classes: compare across the classes, in
    # tiles of a bucket, each pair of tiles in one place.
    known = staged(shared.join(roots, "key", "left").select("band", "bucket", "key", F.coalesce("root", "key").alias("root")), "known")
    open_ones = known.groupBy("band", "bucket").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.ceil(F.count(F.lit(1)) / rules.tile).cast("int").alias("tiles")).where("low <> high")
    tile = F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int")
    left = known.join(open_ones.select("band", "bucket", "tiles"), ["band", "bucket"]).withColumn("tile", tile)
    left = left.select("key", "root", "band", "bucket", F.explode(F.transform(
        F.sequence(F.lit(0), F.col("tiles") - 1), lambda k: F.struct(F.least(k, "tile").alias("i"), F.greatest(k, "tile").alias("j")))).alias("at"))
    left = left.withColumn("place", F.xxhash64("band", "bucket", "at.i", "at.j")).select("key", "root", "place")
    more = staged(_across(left.join(texts, "key"), weights, rules), "more")
    if not more.isEmpty():
        # From the classes found so far, not from their links: fewer rounds.
        roots = staged(components(roots.select(F.col("key").alias("a"), F.col("root").alias("b")).union(more)), "roots")

    own = rows.where("text is null or not text rlike '[^\\\\x20\\\\x09-\\\\x0D]'")
    keyed = worded.select("doc_id", "key").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    keyed = staged(keyed, "rows")
    firsts = keyed.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "key")).alias("first"), F.count(F.lit(1)).alias("class_size"))
    return keyed.join(firsts, "root").select(
        "doc_id", "key", F.col("first.doc_id").alias("class_id"), F.col("first.key").alias("class_key"), "class_size",
    ).unionByName(own.select("doc_id", F.lit(None).cast("string").alias("key"), F.col("doc_id").alias("class_id"),
                             F.lit(None).cast("string").alias("class_key"), F.lit(1).cast("long").alias("class_size")))


def without_copies(docs: DataFrame, rules: NearDupRules = NearDupRules(), text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The first document of each class, with all columns; documents without
    words stay. Rows that share id and text count as one."""
    kept = classes(docs, rules, text, doc_id).where(
        F.col("key").isNotNull() & F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("key") == F.col("class_key")))
    counted = staged(kept.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n")), "kept")
    # Whole rows in one column, so that no name of theirs can clash.
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(doc_id).alias("id"),
                    F.when(F.col(text).rlike(r"[^\x20\x09-\x0D]"), _key(F.col(text))).alias("key")).alias("d")
    k = counted.select("doc_id", "key").alias("k")
    first = d.join(k, F.col("d.id").eqNullSafe(F.col("k.doc_id")) & (F.col("d.key") == F.col("k.key")), "left_semi")
    if not counted.where("n > 1").isEmpty():
        first = first.dropDuplicates(["id", "key"])
    return first.unionByName(d.where("key is null")).select("row.*")
