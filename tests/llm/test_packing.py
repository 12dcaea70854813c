"""Packing and the ids of words against the tokenizers library and by exhaustion."""

from __future__ import annotations

import json
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from groundburn.llm import packing
from groundburn.llm.packing import PackRules, Places, patterns
from groundburn.llm.queries import QUERIES, WORD_BPE
from groundburn.llm.word_ids import WordIds, by_bytes

DDL = "doc_id long, text string, offset string, ids int, length long"
RULES = PackRules(WORD_BPE.tokenizer, WORD_BPE.end_id, window=16, pad_id=7)
TEXTS = ["one two three", "one two three", None, "", " \n\t", "w " * 1000, "Zürich, naïve; don't! 日本\U0001F600 x y é 'S", "z" * 3000,
         "a\x1cb \x85c d", "ends in marks... (really?) [ok]", "ĲSSEL İstanbul ŉ ǅ ﬁne ΣΑΣ", "tab\tand\x0bfeed\x0c", "15 tokens " * 5]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(WORD_BPE.tokenizer)


def expected(tokenizer, texts):
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check(rows, ids, window):
    """Every id in exactly one piece, sequences gapless and within the window."""
    for i, own in enumerate(ids):
        at = 0
        for r in sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(own))
            assert r["ids_crc32"] == crc(own[at:at + r["length"]])
            at += r["length"]
        assert at == len(own)
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(held) == list(range(len(held)))
    for spans in held.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= window


def test_whole_table(spark, sf, tokenizer):
    rows = QUERIES["op11_packing"](spark, sf).collect()
    docs = pq.read_table(f"{sf}/documents.parquet").sort_by("doc_id")
    assert docs["doc_id"].to_pylist() == list(range(docs.num_rows))
    ids = expected(tokenizer, docs["text"].to_pylist())
    check(rows, ids, 4096)
    fewest = -(-sum(map(len, ids)) // 4096)
    assert len({r["sequence_id"] for r in rows}) <= fewest + 1


def test_hard_texts_and_clashing_columns(spark, tokenizer):
    docs = spark.createDataFrame([(i, t, "own", 5, 9) for i, t in enumerate(TEXTS)], DDL).repartition(4)
    found = packing.packed(docs, RULES, keep=["doc_id", "offset", "ids", "length"], with_ids=True)
    assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "sequence_id", "offset"]
    rows, ids = found.collect(), expected(tokenizer, TEXTS)
    check(rows, ids, 16)
    whole = {r["sequence_id"]: r for r in packing.sequences(found, RULES).collect()}
    for r in rows:
        sequence = whole[r["sequence_id"]]
        assert sequence["ids"][r["offset"]:r["offset"] + r["length"]] == ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        n = sequence["n_tokens"]
        assert len(sequence["ids"]) == (n if n in (1, 2, 4, 8, 16) else 16) and set(sequence["ids"][n:]) <= {7}


def test_repeated_rows_null_ids_and_one_length(spark):
    docs = spark.createDataFrame([(None, "one two", "", 0, 0)] * 90 + [(3, "one two", "", 0, 0)] * 7, DDL).repartition(6)
    rows = packing.packed(docs, RULES, keep=["doc_id"]).collect()
    assert len(rows) == 97 and {r["length"] for r in rows} == {3} and sum(r["doc_id"] is None for r in rows) == 90
    assert sorted(Counter(r["sequence_id"] for r in rows).values()) == [2] + [5] * 19  # five to a window of 16
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 97


def test_no_documents(spark):
    found = packing.packed(spark.createDataFrame([], DDL), RULES)
    assert found.count() == 0
    assert dict(found.dtypes)["sequence_id"] == "bigint"


def one_by_one(histogram, window):
    """How full packs are by the same rule without patterns: each piece into the
    emptiest pack with room. Which of equally full packs takes it changes nothing here."""
    packs = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            emptiest = min(range(len(packs)), key=lambda k: sum(packs[k]), default=None)
            if emptiest is None or window - sum(packs[emptiest]) < length:
                packs.append([])
                emptiest = len(packs) - 1
            packs[emptiest].append(length)
    return Counter(map(sum, packs))


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 24), st.integers(1, 30), max_size=24))
def test_patterns_against_one_by_one(histogram):
    found = patterns(histogram, 24)
    got = Counter()
    for p in found:
        got[sum(length * copies for length, copies in p.runs)] += p.count
    assert got == one_by_one(histogram, 24)
    assert len(found) <= 3 * 24
    places = Places.of(found)
    seen = set()
    for length, n in histogram.items():
        sequence, offset = places.find(np.full(n, length), np.arange(n))
        for s, o in zip(sequence.tolist(), offset.tolist(), strict=True):
            taken = {(s, o + k) for k in range(length)}
            assert not taken & seen and o + length <= 24
            seen |= taken
    assert {s for s, _ in seen} == set(range(sum(p.count for p in found)))


def test_patterns_do_not_grow_with_the_documents():
    found = patterns({length: 10**12 + length for length in range(1, 4097)}, 4096)
    assert len(found) <= 3 * 4096
    total = sum(length * (10**12 + length) for length in range(1, 4097))
    assert sum(p.count for p in found) * 4096 <= total * 1.001


@lru_cache(maxsize=1)
def small_cache():
    return WordIds(WORD_BPE.tokenizer, cached=50)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.text("aBé.,' 's-12\tÀŒ́x", max_size=60)), max_size=8))
def test_ids_of_any_text(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    own = small_cache()
    ids, ends = own.encode(pa.array(texts, pa.string()))
    want = [e.ids for e in own.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip([0, *ends], ends, strict=False)] == want


def test_slices_and_nulls(tokenizer):
    column = pa.array(TEXTS * 3, pa.string()).slice(2, 30)
    own = WordIds(WORD_BPE.tokenizer, cached=5)
    got = []
    for part in by_bytes(column, 2000):
        ids, ends = own.encode(part)
        got += [ids[a:b].tolist() for a, b in zip([0, *ends], ends, strict=False)]
    assert got == [ids[:-1] for ids in expected(tokenizer, column.to_pylist())]


def test_other_tokenizers(tmp_path, tokenizer):
    """One that the plain way does not fit takes the whole way; one that joins words raises."""
    spec = json.loads(tokenizer.to_str())
    spec["normalizer"] = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "StripAccents"}, {"type": "Lowercase"}]}
    (tmp_path / "accents.json").write_text(json.dumps(spec))
    own = WordIds(str(tmp_path / "accents.json"))
    assert not own.plain
    ids, _ = own.encode(pa.array(["Ünï code, don't"]))
    assert ids.tolist() == Tokenizer.from_file(str(tmp_path / "accents.json")).encode("Ünï code, don't", add_special_tokens=False).ids
    spec["pre_tokenizer"] = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    (tmp_path / "spaces.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        WordIds(str(tmp_path / "spaces.json"))
    with pytest.raises(ValueError):
        WordIds(WORD_BPE.tokenizer, width=1)


def test_staged_tables_need_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from groundburn.llm.base import shared_folder

    def session(master):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, applicationId="app")
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context)

    for master in ("yarn", "spark://host:7077", "k8s://x"):
        with pytest.raises(RuntimeError, match="checkpoint"):
            shared_folder(session(master))
