"""Links found on the driver's documents against all pairs of them."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq

from groundburn.llm import near_dup
from groundburn.llm.base import table
from groundburn.llm.near_dup import NearDupRules, Weights, frequent_shingles, shingles, weighted_jaccard

FOLDER = "/root/testdata/sf0.1"


def all_pairs(vectors, least):
    """Pairs of at least ``least`` weighted similarity, by exact prefix filtering:
    of two such sets, the rarest shingles that weigh more than 1 - least of each must meet."""
    df = defaultdict(int)
    for ids, _, _ in vectors:
        for i in ids.tolist():
            df[i] += 1
    postings = defaultdict(list)
    for k, (ids, weight, _) in enumerate(vectors):
        order = np.lexsort((ids, [df[i] for i in ids.tolist()]))
        prefix = np.searchsorted(np.cumsum(weight[order]), (1 - least) * weight.sum() * (1 + 1e-9), side="right") + 1
        for i in ids[order[:prefix]].tolist():
            postings[i].append(k)
    sums = [v[1].sum() for v in vectors]
    met = {(a, b) for own in postings.values() for n, a in enumerate(own) for b in own[n + 1:]
           if min(sums[a], sums[b]) >= least * max(sums[a], sums[b])}
    return {(a, b) for a, b in met if weighted_jaccard(vectors[a], vectors[b]) >= least}


def test_prefix_filter_finds_all_pairs():
    rng = np.random.default_rng(1)
    base = rng.choice(5000, 60, replace=False)
    vectors = []
    for _ in range(80):
        ids = np.unique(np.where(rng.random(60) < rng.random() * 0.15, rng.choice(5000, 60), base)).astype(np.uint64)
        vectors.append((ids, 1 + (ids % np.uint64(7)) / 70, np.ones(len(ids))))
    slow = {(a, b) for a in range(80) for b in range(a + 1, 80) if weighted_jaccard(vectors[a], vectors[b]) >= 0.8}
    assert all_pairs(vectors, 0.8) == slow and len(slow) > 20


def test_recall_on_the_test_tables(spark):
    docs = pq.read_table(f"{FOLDER}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    rules = NearDupRules()
    first = {}
    for d in docs:
        if d["text"] is not None:
            first.setdefault(d["text"], d["doc_id"])
    texts = [(i, ids) for t, i in first.items() if len(ids := shingles(t.encode(), rules.words))]
    given = table(spark, FOLDER, "documents")
    weights = Weights(*frequent_shingles(given.select("text"), rules), rules.rare, rules.idf_spread)
    pairs = all_pairs([weights.vector(ids) for _, ids in texts], rules.similarity)
    classes = {r["doc_id"]: r["class_id"] for r in near_dup.classes(given).select("doc_id", "class_id").collect()}
    linked = sum(classes[texts[a][0]] == classes[texts[b][0]] for a, b in pairs)
    print(f"{len(pairs)} pairs, {linked} linked")
    assert len(pairs) > 40 and linked >= 0.9 * len(pairs)
    # What the cut of document frequencies changes: with every shingle's own frequency and the same spread.
    df = defaultdict(int)
    for _, ids in texts:
        for i in np.unique(ids).tolist():
            df[i] += 1
    counts = np.array(list(df.values()))
    every = Weights(np.array(list(df), np.uint64)[(order := np.argsort(np.array(list(df), np.uint64)))], counts[order], len(docs), len(docs), rules.idf_spread)
    exact = all_pairs([every.vector(ids) for _, ids in texts], rules.similarity)
    print(f"{len(exact ^ pairs)} of {len(exact | pairs)} pairs differ with uncut frequencies")
    assert len(exact ^ pairs) <= 0.02 * len(exact | pairs)


