"""The divergence audit against SQL over whole tables and by hand on small ones."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import replace

import duckdb
import pytest

from checks.compare import connect, differences
from groundburn.llm import source_audit
from groundburn.llm.oracle import ORACLES
from groundburn.llm.queries import QUERIES
from groundburn.llm.source_audit import AuditRules

DDL = "doc_id long, text string, lang string, source string, term string, block int"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def brute(rows, least=10):
    docs = [((r[2] or ""), (r[3] or ""), Counter(TERM.findall((r[1] or "").translate(FOLD)))) for r in rows]
    having, groups, total = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        having[lang].update(terms.keys())
        groups[lang, source].update(terms)
        total[lang].update(terms)
    out = set()
    for lang in {k[0] for k in groups}:
        kept = [t for t, n in having[lang].items() if n >= least]

        def p(counts):
            n = sum(counts[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // n for t in kept}

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        own = {s: p(c) for (g, s), c in groups.items() if g == lang}
        q = p(total[lang])
        for s in own:
            pairs = [(sum(f(own[s][t], own[o][t]) for t in kept), o) for o in own if o != s]
            terms = [(f(own[s][t], q[t]), t) for t in kept if groups[lang, s][t] and own[s][t] > q[t]]
            for part, found, top in (("pair", pairs, len(pairs)), ("term", terms, 10)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, v, k + 1) for k, (v, item) in enumerate(found[:top])}
    return out


def result(spark, rows, rules=AuditRules()):
    found = [tuple(r) for r in source_audit.divergences(spark.createDataFrame(rows, DDL).repartition(3), rules).collect()]
    assert len(found) == len(set(found))
    return set(found)


def doc(i, text, lang="en", source="a"):
    return (i, text, lang, source, "own", 1)


HARD = (
    [doc(i, f"The cat, the CAT; {'dog ' * (i % 4)}don't x{i}y naïve Ünï \U0001F600日本", source="abc"[i % 3]) for i in range(30)]
    + [doc(None, None), doc(5, ""), doc(5, " \t\n"), doc(6, "12 34 !!", None, None), doc(7, None, "fr", "lone"), doc(8, "un deux", "fr", "é")]
    + [doc(9, "copy of a row the cat")] * 12 + [doc(10, "w " * 30_000 + "z" * 5000, source="Z"), doc(11, "quiet", source="none of the kept")]
    + [doc(i, "tie one two three", "de", s) for i in range(6) for s in ("p", "q")]
)


def test_whole_table_matches_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert not differences(QUERIES["op13_source_audit"](spark, folder), connect(folder), ORACLES["op13_source_audit"])


def test_edge_cases_match_brute_force(spark):
    assert result(spark, HARD) == brute(HARD)


def test_sql_matches_brute_force(spark, tmp_path):
    spark.createDataFrame(HARD, DDL).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert set(con.execute(ORACLES["op13_source_audit"]).fetchall()) == brute(HARD)


def test_tiny_blocks_and_tiles_change_nothing(spark):
    assert result(spark, HARD, replace(AuditRules(), block_bytes=1, range_rows=50, tile_cells=3)) == brute(HARD)


def test_fewer_documents_make_a_term(spark):
    rows = HARD[:8]
    assert result(spark, rows, AuditRules(least_documents=2)) == brute(rows, 2)
    assert {r[2] for r in result(spark, rows)} == {"pair"} and {r[4] for r in result(spark, rows)} == {0}


def test_no_documents(spark):
    found = source_audit.divergences(spark.createDataFrame([], DDL))
    assert found.count() == 0
    assert found.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]


@pytest.mark.parametrize("count, total", [(0, 7), (7, 7), (3, 8_999_999_999_999_999), (8_999_999_999_999_997, 8_999_999_999_999_999), (12345678901, 98765432109876)])
def test_shares_are_exact(count, total):
    assert int(source_audit.shares([count], total)[0]) == 1 + 10**9 * count // total
