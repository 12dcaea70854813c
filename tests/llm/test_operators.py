"""Operators against brute force on small tables, and their edge cases."""

from __future__ import annotations

import hashlib
import html
import math
import re
import struct
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from checks.compare import differences
from groundburn.llm import byte_bpe, chat, class_ngram, host_quality, html_blocks, language_id, near_dup, sharding, token_records, wu_manber
from groundburn.llm.base import id_remainder
from groundburn.llm.oracle import ORACLES
from groundburn.llm.queries import BYTE_BPE, QUERIES, WORD_BPE

DDL = "doc_id long, text string, lang string, source string, n_chars long"
A = " ".join(f"alpha{i} beta{i} gamma{i}" for i in range(40))
ROWS = [
    (1, A, "en", "a", 1), (2, A, "en", "a", 1), (3, A.replace("beta7", "other"), "en", "b", 1), (3, A.replace("beta7", "other"), "en", "b", 1),
    (4, None, None, None, None), (5, "", "en", "b", 0), (6, "  \n\t ", "fr", "a", 4), (None, "un deux trois quatre", "fr", None, 9),
    (7, "ÀÉ #$% naïve\x0b日本 \U0001F600 don't 12,345\n\nx\nx\n", "fr", "c", 1), (8, "w " * 20_000, "en", "c", 1),
    (9, "z" * 3000, "de", "c", 1), (10, "der die das und nicht " * 9, "de", "b", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DDL)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DDL)


def crc(x):
    return zlib.crc32(x.encode())


def fixture_folder(tmp_path, spark, rows, benchmark):
    spark.createDataFrame(rows, DDL).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    return str(tmp_path), con


BENCH = [(5, " ".join(A.split()[3:20])), (40, "Deux, TROIS"), (6, None), (None, "w w"), (8, "x"), (7, "w " * 11)]


@pytest.mark.parametrize("name", sorted(ORACLES))
@pytest.mark.parametrize("rows", [ROWS, []], ids=["rows", "empty"])
def test_against_sql(spark, tmp_path, name, rows):
    folder, con = fixture_folder(tmp_path, spark, rows, BENCH)
    assert differences(QUERIES[name](spark, folder), con, ORACLES[name]) == []


def test_labeller_on_pages_it_has_not_seen():
    net = html_blocks.trained()
    right = total = 0
    for page, y in html_blocks.generated(150, 1234):
        p = net.chances([html_blocks._features(page, net.rules)])[0]
        right, total = right + int(((p > 0.5) == y).sum()), total + len(y)
    assert right >= 0.99 * total


def test_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r["page_id"]: r for r in html_blocks.extracted(pages, html_blocks.trained()).collect()}
    for row in pages.collect():
        want = "\n\n".join(x.text for x in html_blocks.leaves(row["html"]) if "article" in x.path)
        assert (got[row["page_id"]]["text"], got[row["page_id"]]["n_chars"]) == (want, len(want))


def test_html_edges(spark):
    rows = [(1, None), (2, ""), (3, "<p>a &amp; b&nbsp;&#x41;\n c</p"), (4, "<article><p>one <b>two</b><br>three<p>four<script>x='</p>'</script><!-- no --></article>"),
            (5, "<article>" + "<p>long text here</p>" * 5000 + "</article>")]
    got = {r["id"]: r["text"] for r in html_blocks.extracted(spark.createDataFrame(rows, "id long, html string"), html_blocks.trained()).collect()}
    assert got[1] == got[2] == "" and got[4] == "one two three\n\nfour" and got[5].count("long text here") == 5000
    assert [x.text for x in html_blocks.leaves("<div>a &amp; b&nbsp;&#x41;\n c</div>")] == ["a & b A c"]
    assert html_blocks.extracted(spark.createDataFrame([], "id long, html string"), html_blocks.trained()).isEmpty()


def test_long_pages_are_read_as_a_whole():
    net = html_blocks.trained()
    side = '<div class="box"><ul><li><a href=x>menu</a></li></ul></div>'
    body = "".join(f"<p><a href=x>w{i}x0 w{i}x1 w{i}x2</a></p>" for i in range(2600))
    page = html_blocks.leaves(f'<div class="wrapper">{side}<div class="main">{body}</div>{side}</div>')
    chances = net.chances([html_blocks._features(page, net.rules)])[0]
    want = [x.text for x, p in zip(page, chances, strict=True) if p > 0.5]
    assert net.main_text([page]) == [want] and 0 < len(want) < len(page)


def test_labeller_gradients():
    rules = html_blocks.LabellerRules(path_buckets=32, word_buckets=16, hidden=3)
    net = html_blocks.Labeller(rules)
    data = [(html_blocks._features(p, rules), y) for p, y in html_blocks.generated(3, 5)]
    xs, ys = [d[0] for d in data], [d[1] for d in data]

    def loss():
        p = np.concatenate(net.chances(xs))
        y = np.concatenate(ys)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    grads = net.gradients(xs, ys)
    for name in net.w:
        at = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        old = net.w[name][at]
        net.w[name][at] = old + 1e-5
        up = loss()
        net.w[name][at] = old - 1e-5
        down = loss()
        net.w[name][at] = old
        assert (up - down) / 2e-5 == pytest.approx(grads[name][at], rel=1e-3, abs=1e-7)


@pytest.mark.parametrize("fraction", [0, 3])
def test_class_ngram(spark, docs, none, fraction):
    held = id_remainder(F.col("doc_id"), 5) == (1 if fraction else 9)
    got = class_ngram.scored(docs.withColumn("n_tokens2", F.lit(1)), held, keep=["doc_id", "n_tokens2"]).collect()
    train = [r for r in ROWS if not fraction or crc(str(r[0]) if r[0] is not None else "") % 5 != 1]
    c = Counter()
    for r in train:
        c.update((r[1] or "").encode().lower().split())
        c[None] += 1
    n, v = sum(c.values()), len(c)
    want = sorted((r[0] or -1, len(w), sum(c[x] > 0 for x in w), round(sum(math.log10((c[x] + .5) / (n + .5 * (v + 1))) for x in w), 6))
                  for r in ROWS for w in [(r[1] or "").encode().lower().split() + [None]])
    assert sorted((r["doc_id"] or -1, r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["train_tokens"] == n and r["score"] <= 0 for r in got)
    assert class_ngram.scored(none, held).isEmpty()
    nobody = class_ngram.scored(docs, F.lit(True), keep=["doc_id"]).collect()
    assert all(r["n_known"] == 0 and math.isfinite(r["score"]) for r in nobody)


def test_rare_words_of_a_large_corpus_have_classes_of_their_own(spark):
    first, second = ([f"{c}zzz" for c in x] for x in ("abcdefgh", "ijklmnop"))  # the same pool, were they pooled
    rows = [(i, "fill word " * 20_000) for i in range(15)]
    rows += [(100 + i, f"fill word {a} word fill {b} fill word") for i, (a, b) in enumerate(zip(first * 4, second * 4, strict=True))]
    held = [(1000 + i, f"fill word {w} word fill word") for i, w in enumerate(first + second)]
    docs = spark.createDataFrame(rows + held, "doc_id long, text string").coalesce(4)
    found = class_ngram.scored(docs, F.col("doc_id") >= 1000, keep=["doc_id"], rules=class_ngram.ClassRules(classes=3))
    got = {r["doc_id"] - 1000: r["score"] for r in found.where("doc_id >= 1000").collect()}
    assert min(got[i] for i in range(8)) > max(got[i] for i in range(8, 16))


def test_a_block_may_end_as_its_words_are_sent(spark):
    """Where a block's last texts fill what a task may hold, nothing is left to send when the next block begins."""
    rows = [(i, " ".join(f"w{i % 3}x{k}" for k in range(40))) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    held = F.col("doc_id") >= 9
    small = class_ngram.ClassRules(classes=3, block_bytes=1, read_bytes=1, count_chunk=30)  # every text is a block of its own
    base = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score"]
    got, want = (sorted(map(tuple, class_ngram.scored(docs, held, keep=["doc_id"], rules=rules).select(base).collect()))
                 for rules in (small, class_ngram.ClassRules(classes=3)))
    assert [r[:4] for r in got] == [r[:4] for r in want] == [(i, 41, 41, 9 * 41) for i in range(12)]
    assert [r[4] for r in got] == pytest.approx([r[4] for r in want])


def test_best_class_is_the_best_of_all():
    r = np.random.default_rng(3)
    k, words = 5, 12
    pairs = r.integers(0, 6, (words, words)).astype(float)
    np.fill_diagonal(pairs, 0)
    of = np.append(0, r.integers(1, k, words - 1))

    def counts(of):
        g = np.zeros((k, k))
        np.add.at(g, (of[:, None].repeat(words, 1), of[None].repeat(words, 0)), pairs)
        return g

    def likelihood(of):
        g = counts(of)
        x = lambda a: float((a * np.log(np.maximum(a, 1e-300))).sum())
        return x(g) - x(g.sum(0)) - x(g.sum(1))

    w = 4
    left, right = np.bincount(of, pairs[:, w], k), np.bincount(of, pairs[w], k)
    got = class_ngram.best_class(left, right, of[w], counts(of))
    tried = [likelihood(np.where(np.arange(words) == w, c, of)) for c in range(1, k)]
    assert got == np.argmax(tried) + 1


def brute_classes(texts, others=0):
    s = {i: near_dup.shingles(t.encode(), 5) for i, t in texts.items()}
    df = Counter(x for v in s.values() for x in set(v.tolist()))
    ids = np.array(sorted(i for i, n in df.items() if n > 1), np.uint64)
    weights = near_dup.Weights(ids, np.array([df[int(i)] for i in ids]), len(texts) + others, 1000, near_dup.NearDupRules().idf_spread)
    v = {i: weights.vector(x) for i, x in s.items() if len(x)}
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in v:
        for b in v:
            if a < b and near_dup.weighted_jaccard(v[a], v[b]) >= 0.8:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in texts}


def test_near_duplicates(spark, none):
    base = [f"w{i}" for i in range(120)]
    texts = {0: " ".join(base), 1: " ".join(base), 50: "one two", 51: "ONE  two", 52: "one three"}
    for k in range(2, 40):  # a group of copies with one or more edits each
        edited = list(base)
        for e in range(1 + k % 7):
            edited[(k * 13 + 17 * e) % 120] = f"edit{k}-{e}"
        texts[k] = " ".join(edited)
    rows = [(i, t) for i, t in texts.items()] + [(90, None), (91, ""), (92, ""), (93, " \n ")]
    got = near_dup.classes(spark.createDataFrame(rows, "doc_id long, text string"), near_dup.NearDupRules(tile=6)).collect()
    want = brute_classes(texts, 3) | {90: 90, 91: 91, 92: 92, 93: 93}
    assert {r["doc_id"]: r["class_id"] for r in got} == want and len(got) == len(rows)
    assert near_dup.classes(none).isEmpty()


def test_first_of_each_class_stays(spark, docs):
    kept = near_dup.without_copies(docs.withColumn("key", F.lit("k")).withColumn("_text", F.lit("t"))).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept if (r["text"] or "").strip()) == sorted(
        (r[0] or 0, r[1]) for r in {r[0]: r for r in ROWS}.values() if (r[1] or "").strip() and r[0] not in (2, 3))
    assert sum(not (r["text"] or "").strip() for r in kept) == 3


def test_close_pairs_by_matrices_are_those_by_sets():
    r = np.random.default_rng(1)
    w = near_dup.Weights(np.arange(5, dtype=np.uint64), np.full(5, 9), 100, 10, 0.5)
    vectors = [w.vector(r.integers(0, 12, 60).astype(np.uint64)) for _ in range(30)]
    pairs = near_dup.close_pairs(vectors, list(range(30)), 0.8)
    parent = list(range(30))

    def joined(links):
        of = list(range(30))
        for _ in range(30):
            for i, j in links:
                of[i] = of[j] = min(of[i], of[j])
        return of

    every = [(i, j) for i in range(30) for j in range(i) if near_dup.weighted_jaccard(vectors[i], vectors[j]) >= 0.8]
    assert joined(pairs) == joined(every) != parent


def test_byte_bpe(spark, docs, none):
    ranks = byte_bpe.Codec(BYTE_BPE).ranks
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = sorted((r[0] or 0, len(i), sha(" ".join(map(str, i)).encode()), sha((r[1] or "").encode()))
                  for r in ROWS for i in [own.encode_ordinary(r[1] or "")])
    got = byte_bpe.round_trip(docs, BYTE_BPE, keep=["doc_id"])
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got.collect()) == want
    back = byte_bpe.decoded(byte_bpe.encoded(docs, BYTE_BPE), BYTE_BPE, keep=["text"]).collect()
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in back)
    assert byte_bpe.round_trip(none, BYTE_BPE).isEmpty()


def test_bpe_queries_and_heap_agree(sf):
    codec = byte_bpe.Codec(BYTE_BPE)
    pieces = [p for (t,) in duckdb.sql(f"SELECT text FROM '{sf}/documents.parquet' LIMIT 40").fetchall() for p in codec.pattern.findall(t)]
    codec.learn(pieces)
    for p in set(pieces) - {p for p in pieces if p.encode() in codec.ranks}:
        assert np.frombuffer(codec.known.new[p], "<u4").tolist() == codec._merged(p.encode())


def test_sharding(spark, docs, none):
    hot = docs.unionByName(docs.where("doc_id = 10").crossJoin(spark.range(500)).drop("id"))
    got = sharding.sharded(sharding.document_sizes(hot), ["doc_id", "text_crc32"], "size", 24).collect()
    rows = [(r["doc_id"], r["text"] or "") for r in hot.collect()]
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((i, len(t.encode()) + 8, crc(t)) for i, t in rows)
    total, largest = sum(r["size"] for r in got), max(r["size"] for r in got)
    held, slots = Counter(), {}
    for r in got:
        held[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(abs(held[s] - total / 24) <= largest for s in range(24))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    order = [r["shard"] for r in sorted(got, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text_crc32"], r["shard"]))]
    assert order == sorted(order)
    assert sharding.sharded(sharding.document_sizes(none), ["doc_id"], "size", 24).isEmpty()


def test_columns_named_as_the_operators_own(spark, docs):
    """Shards, near duplicates: columns of those names keep their values or give way, and none comes twice."""
    odd = docs.select("*", F.lit("k").alias("_key"), F.lit(7).alias("row"), F.lit(8).alias("key"), F.lit(9).alias("shard"),
                      F.lit(1).alias("_row"), F.lit(2).alias("_crc"), F.lit(3).alias("slot"), F.lit(4).alias("id"), F.lit(5).alias("x.y"))
    kept = near_dup.without_copies(odd)
    assert kept.columns == odd.columns
    assert {tuple(r)[5:] for r in kept.collect()} == {tuple(r)[5:] for r in odd.collect()}
    sizes = odd.withColumn("size", F.lit(3))
    placed = sharding.sharded(sizes, ["doc_id"], "size", 3)
    assert placed.columns == [c for c in sizes.columns if c not in ("shard", "slot")] + ["shard", "slot"]
    assert {(r["_row"], r["row"], r["key"]) for r in placed.collect()} == {(1, 7, 8)} and {r["shard"] for r in placed.collect()} == {0, 1, 2}
    written = spark.read.parquet(sharding.write_shards(odd.where("doc_id is not null").drop("x.y"), None, 3))
    assert sorted(written.columns) == sorted([*(c for c in odd.columns if c not in ("shard", "x.y")), "shard"])
    assert {r["_crc"] for r in written.collect()} == {2}


def test_shards_are_written(spark, docs):
    path = sharding.write_shards(docs.where("doc_id is not null"), None, 3)
    assert spark.read.parquet(path).count() == len(ROWS) - 1


TURNS = [
    (1, 0, "system", "be [good] & <kind>"), (1, 1, "user", "hi <|end|>\n"), (1, 2, "assistant", "</s>[INST] ok [/INST] &lt;"),
    *((2, i, ["user", "assistant"][i % 2], f"turn {i} " + "word " * (40 * i % 130)) for i in range(30)), (2, 30, "assistant", "big " * 900),
    (3, None, None, None), (3, 1, "assistant", ""), (3, 1, "assistant", ""), (None, 0, "a|b\nc", "x"), (4, 5, "system", "late"), (4, 4, "assistant", "a" * 5000),
]


def keeps_to_budget(windows, rules):
    """Whole windows: only a system turn and one new turn that are too much by themselves may exceed it."""
    count = 0
    for r in windows.collect():
        cells = [x for x in r["text"].split("<|end|>\n") if x]
        sizes = [len(re.findall(r"\w+|[^\w\s]", html.unescape(x.split("|>", 1)[1]))) + 3 for x in cells]
        system = sizes[0] if cells[0].startswith("<|system|>") and r["n_repeated"] else 0
        new = sizes[r["n_repeated"]:]
        assert sum(sizes) <= rules.budget or (len(new) == 1 and (system + new[0] > rules.budget and r["n_repeated"] <= (system > 0)))
        count += len(sizes) - len(new)
    return count


@pytest.mark.parametrize("system, sizes", [
    (900, [300] * 9), (10, [300, 5, 5, 5, 900, 5, 5, 300, 300]), (0, [1000, 20, 1000, 20]), (1200, [10, 20, 30]), (100, [200] * 20), (500, [20] * 90), (767, [1, 255, 254, 256]),
])
def test_whole_windows_keep_to_the_budget(spark, system, sizes):
    rows = [(1, 0, "system", "s " * system)] if system else []
    rows += [(1, k + 1, ["user", "assistant"][k % 2], f"{'w ' * n}{k}") for k, n in enumerate(sizes)]
    for rules in (chat.ChatRules(), chat.ChatRules(history_turns=1), chat.ChatRules(history_turns=0), chat.ChatRules(history_turns=3, history_tokens=600)):
        windows = chat.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), rules)
        repeated = keeps_to_budget(windows, rules)
        assert repeated or not rules.history_turns or windows.count() == 1 or max(sizes) + system > 900
        got = chat.digests(chat.read_back(windows)).first()
        assert got["n_turns"] == len(rows) and got["loss_chars"] == sum(len(r[3]) for r in rows if r[2] == "assistant")


def test_chat(spark):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumn("window", F.lit(1))
    rules = chat.ChatRules(budget=200)
    windows = chat.formatted(turns, rules)
    got = {r["conv_id"]: r for r in chat.digests(chat.read_back(windows)).collect()}
    told = {}
    for t in sorted(TURNS, key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or "")):
        told.setdefault(t[0], []).append((t[2] or "", t[3] or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for conv, own in told.items():
        learned = "".join(x for role, x in own if role == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(own), sha("".join(f"{a}\n{b}\n" for a, b in own)))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(learned), sha(learned))
    many = windows.where("conv_id = 2").orderBy("window").collect()
    assert len(many) > 3 and any(r["n_repeated"] for r in many)
    assert got[2]["formatted_chars"] == sum(len(r["text"]) for r in many)
    keeps_to_budget(windows, rules)
    assert chat.formatted(turns.limit(0)).isEmpty()


def test_token_records(spark, docs, none):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    path = token_records.fresh_path(spark)
    files = token_records.written(docs, path, WORD_BPE)
    got = sorted(token_records.read_back(files, path, WORD_BPE).collect(), key=lambda r: r["start"])
    at = 0
    assert [r["doc_id"] for r in got] == [None, *sorted(r[0] for r in ROWS if r[0] is not None)]
    texts = {r[0]: r[1] or "" for r in ROWS}
    for r in got:
        ids = np.array([*tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 2], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    first = files.orderBy("file").first()
    payload = token_records.record_at(path, first["file"], first["n_docs"] - 1)
    assert struct.unpack_from("<q", payload)[0] in texts
    assert token_records.read_back(token_records.written(none, path + "-none", WORD_BPE), path, WORD_BPE).isEmpty()


def test_damaged_records_are_noticed():
    good = token_records.framed(b"abc")
    for k in range(len(good)):
        bad = bytearray(good)
        bad[k] ^= 1
        with pytest.raises(ValueError):
            data = memoryview(bytes(bad))
            place = [0]

            def read(n):
                place[0] += n
                return bytes(data[place[0] - n:place[0]])

            list(token_records.unframed(read))


def test_wu_manber_finds_what_find_finds():
    r = np.random.default_rng(2)
    text = "".join(r.choice(list("ab "), 3000)).encode()
    patterns = [text[i:i + n] for i, n in zip(r.integers(0, 2900, 60), r.integers(1, 90, 60))] + [b"c", b"abababababab"]
    want = {(i, p) for p in set(patterns) for i in range(len(text)) if text.startswith(p, i)}
    assert set(wu_manber.WuManber(patterns, block=4).find(text)) == want


def test_benchmark_in_slices(spark, docs):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    whole = wu_manber.contamination(docs, bench, keep=["doc_id"]).collect()
    assert Counter(map(str, whole)) == Counter(map(str, wu_manber.contamination(docs, bench, keep=["doc_id"], slice_bytes=40).collect()))


@pytest.mark.parametrize("slice_bytes", [40, 512 << 10])
def test_items_without_an_id_are_found_but_not_named(spark, slice_bytes):
    docs = spark.createDataFrame([(1, "x secret passage here y"), (2, "clean"), (3, "known thing")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "Secret passage, here"), (9, "known thing"), (None, None), (None, "known thing")], "item_id long, text string")
    got = wu_manber.contamination(docs, bench, keep=["doc_id"], slice_bytes=slice_bytes).collect()
    assert {r["doc_id"]: (r["n_hit"], r["items"]) for r in got} == {1: (3, []), 2: (0, []), 3: (2, ["9"])}


def test_clean_documents_of_bad_hosts_stay(spark):
    clean = " ".join(f"word{i % 50} thing{i}" for i in range(60))
    rows = [(i, "bad " * 3, "x", "h", 1) for i in range(50)] + [(100, clean, "x", "h", 1), (101, clean + " #" * 90, "x", "h", 1), (102, clean + " #" * 90, "x", "ok", 1)]
    rows += [(200 + i, clean, "x", "ok", 1) for i in range(50)]
    got = {r["doc_id"]: r["kept"] for r in host_quality.judged_by_host(spark.createDataFrame(rows, DDL)).collect()}
    assert got[100] and not got[101] and not got[0] and got[200]


def test_language(spark, sf, none, docs):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    held = id_remainder(F.col("doc_id"), 4) == 2
    model = language_id.fit(table.where(~held))
    got = language_id.identified(table.where(held), model).collect()
    worded = [r for r in got if len(r["text"].split()) >= 5]
    assert sum(r["lang"] == r["lang_pred"] for r in worded) >= 0.97 * len(worded)
    edge = {r["doc_id"]: r for r in language_id.identified(docs, model).collect()}
    assert edge[4]["lang_pred"] == edge[5]["lang_pred"] == edge[6]["lang_pred"] == "und" and edge[4]["score"] == 0
    assert all(0 <= r["score"] <= 1 for r in edge.values())
    assert language_id.identified(none, model).isEmpty()
    assert {r["lang_pred"] for r in language_id.identified(docs, language_id.fit(none)).collect()} == {"und"}


def test_pipeline(spark, sf):
    got = corpus_pipeline.run(spark, sf).collect()
    table = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    ids = [r["doc_id"] for r in got]
    assert len(ids) == len(set(ids)) > 50
    assert all(r["decoded_sha256"] == hashlib.sha256(table[r["doc_id"]].encode()).hexdigest() for r in got)
    sets = [set(near_dup.shingles(table[i].encode(), 5).tolist()) for i in ids]
    assert all(len(a & b) < 0.85 * len(a | b) for k, a in enumerate(sets) for b in sets[:k])


def test_pipeline_stages_on_edges(spark, sf, docs, none):
    for rows in (docs, none):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, sf)
            assert name == "tokens" or out.columns == rows.columns
            out.collect()


def texts(page):
    return [x.text for x in html_blocks.leaves(page)]


@pytest.mark.parametrize("page, want", [
    ("<p title=it's>hello</p><p>don't lose me</p>", ["hello", "don't lose me"]),
    ('<p title=a"b>x</p><p>y "z"</p>', ["x", 'y "z"']),
    ('<p>a<svg width="1"/>b</p><p>c</p>', ["ab", "c"]),
    ("<p>a<svg><g><title>t</title></g></svg>b</p>", ["ab"]),
    ("<div><svg><path d='M0 0'><p>out</p></div>", ["out"]),
    ("<div>x<object><div>in</div></object>y</div>", ["xy"]),
    ("<div><canvas>lost</div><p>kept</p>", ["kept"]),
    ("<!-->x<p>y", ["x", "y"]), ("<!--->x", ["x"]), ("<!-- a -- b --!>x", ["x"]), ("x<!-- never closed <p>y", ["x"]),
    ("a < b, c <3 <p>x</p><", ["a < b, c <3", "x", "<"]),
    ("<p>x<a href='never closed>y</p>", ["x"]), ("<p>x</p", ["x"]),
    ("<script>if (a<b) '</p>'</script ><p>x", ["x"]), ("<style>p{}</style\n>x", ["x"]), ("<textarea><p>no</textarea>yes", ["yes"]),
    ("<p class=a/b id=>x</p><P\nCLASS='Q'>y", ["x", "y"]), ("a</>b</ c>d<?php x>e<!doctype html>f", ["abdef"]),
    ("<p a=1 =b= c>x</p>", ["x"]), ("<div/>in<p>x", ["in", "x"]), ("<noscript><p>no</p></noscript>x", ["x"]),
])
def test_broken_markup_by_the_standard(page, want):
    assert texts(page) == want


def test_names_of_any_quoting():
    path = html_blocks.leaves("<div class='Side-bar' id=\"x\"><p CLASS = foo role=main>t</p></div>")[0].path
    assert path == ("div", ".side-bar", ".side", ".bar", ".x", "p", ".foo", ".main")


@pytest.mark.parametrize("part", [
    "<a ", "<", "</x ", '<a b="', "<p title='", "<!--", "<svg><g>", "<div>x", "<title>", "&amp", "<a =", "<b><p>", "<object>", "<li x=y"])
def test_time_grows_with_the_page_alone(part):
    def seconds(size):
        page = part * (size // len(part))
        start = time.process_time()
        html_blocks.leaves(page)
        return time.process_time() - start

    assert seconds(5_000_000) < 20 * max(seconds(500_000), 0.05)


def test_deep_and_crossed_elements():
    found = html_blocks.leaves("<div>x" * 3000 + "</div>" * 2000 + "<p>end")
    assert [x.text for x in found] == ["x"] * 3000 + ["end"] and max(len(x.path) for x in found) == 64
    assert texts("<div>" * 100_000 + "</p>" * 100_000 + "y") == ["y"]
