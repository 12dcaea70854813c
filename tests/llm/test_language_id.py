"""Language scores against plain counting, and what the fit must not lose."""

from __future__ import annotations

import math
import unicodedata
from collections import Counter, defaultdict
from dataclasses import replace

import numpy as np
import pytest

from groundburn.llm import language_id
from groundburn.llm.language_id import LanguageRules

DDL = "doc_id long, text string, lang string"
RULES = LanguageRules(min_count=2)


def words(text):
    out, run = [], ""
    for c in text.lower() + " ":
        if unicodedata.category(c).startswith("L"):
            run += c
        elif run:
            out.append(run)
            run = ""
    return out


class Brute:
    def __init__(self, rows, rules):
        self.rules, self.names = rules, sorted({r[2] for r in rows if r[1] is not None and r[2] is not None})
        counts = defaultdict(Counter)  # (kind, gram) -> language -> n
        for _, text, lang in rows:
            if text is None or lang is None:
                continue
            for w in words(text):
                counts[0, w][lang] += 1
                for size in range(1, rules.max_gram + 1):
                    for i in range(len(w) - size + 1):
                        counts[size, w[i:i + size]][lang] += 1
        self.counts = {k: c for k, c in counts.items() if sum(c.values()) >= rules.min_count}
        self.mass = {(kind, lang): sum(c[lang] for (k, _), c in self.counts.items() if k == kind)
                     + rules.smoothing * (sum(k == kind for k, _ in self.counts) + 1) for kind in range(rules.max_gram + 1) for lang in self.names}

    def log(self, kind, gram, lang):
        return math.log((self.counts[kind, gram][lang] + self.rules.smoothing) / self.mass[kind, lang])

    def word(self, w, lang):
        if (0, w) in self.counts:
            return self.log(0, w, lang)
        out = 0.0
        while w:
            size = next((s for s in range(min(self.rules.max_gram, len(w)), 0, -1) if (s, w[:s]) in self.counts), 0)
            if size:
                out += self.log(size, w[:size], lang) + math.log(self.rules.discount) * (self.rules.max_gram - size + 1)
            else:
                out += math.log(self.rules.smoothing / self.mass[1, lang])
            w = w[size or 1:]
        return out

    def predict(self, text):
        found = words(text or "")
        if not found:
            return "und", 0.0
        totals = {lang: sum(self.word(w, lang) for w in found) for lang in self.names}
        best = max(self.names, key=lambda lang: (totals[lang], [-ord(c) for c in lang]))
        return best, 1 / sum(math.exp(max(t - totals[best], -self.rules.max_score_nats)) for t in totals.values())


ROWS = [
    *((i, f"the cat and the dog {'walk' * (i % 3)} over there, {i}", "en") for i in range(12)),
    *((20 + i, f"der Hund und die Katze gehen {'über' * (i % 2)} dort", "de") for i in range(9)),
    *((40 + i, "le chat et le chien, là-bas", "fr") for i in range(4)),
    (60, None, "en"), (61, "no label at all", None), (62, "", "fr"), (63, "½ ² Ⅷ", "es"), (None, "el gato y el perro", "es"), (None, "el gato y el perro", "es"),
]
TEXTS = ["the dog", "die Katzen", "chienne et chatte", "zzz qqq", "12 ½ ²", "Ⅷ", "", None, "日本語", "und", "the " * 300 + "der", "ǅ ß ﬁ", "no_score"]


def test_scores_match_plain_counting(spark):
    model = language_id.fit(spark.createDataFrame(ROWS, DDL).repartition(3), rules=RULES)
    brute = Brute(ROWS, RULES)
    assert set(model.words) | {("g", g) for g in model.grams} == {g for k, g in brute.counts if k == 0} | {("g", g) for k, g in brute.counts if k}
    got = language_id.identified(spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], DDL), model).collect()
    for r in got:
        lang, score = brute.predict(TEXTS[r["doc_id"]])
        assert (r["lang_pred"], r["score"]) == (lang, pytest.approx(score, rel=1e-9))


def test_no_letters_is_und(spark):
    model = language_id.fit(spark.createDataFrame(ROWS, DDL), rules=RULES)
    for text in ("½ ²", "Ⅷ ↂ", "①②", "٣ 12 _", "😀", " \n", "", None):
        assert language_id.predict(model, text, {}) == ("und", 0.0)
    assert language_id.words_of("x²y½z Ⅷa") == ["x", "y", "z", "a"]


def test_a_small_language_keeps_its_words(spark):
    """Fifty rows beside many: each of its words that is frequent enough stays, however many others there are."""
    large = [(i, " ".join(f"w{chr(97 + i % 26)}{chr(97 + k)}{chr(97 + (i * 7 + k) % 26)}x" for k in range(26)), "en") for i in range(3000)]
    small = [(10_000 + i, f"kis szó{'abcdefghij'[i % 10]}", "hu") for i in range(50)]
    model = language_id.fit(spark.createDataFrame(large + small, DDL))
    assert {"kis", *(f"szó{c}" for c in "abcdefghij")} <= set(model.words)


def test_copies_are_not_sampled_all_or_none(spark):
    rows = [(i, "one text that a third of the rows share", "en") for i in range(4000)] + [(5000 + i, f"more {'abcdef'[i % 6]}", "en") for i in range(4000)]
    model = language_id.fit(spark.createDataFrame(rows, DDL), rules=replace(RULES, max_rows=800))
    assert "share" in model.words and "more" in model.words
    share = np.exp(model.rows[model.words["share"]] - model.rows[model.words["more"]])
    assert 0.8 < share[0] < 1.25


def test_small_pieces_of_counts_change_nothing(spark):
    table = spark.createDataFrame(ROWS, DDL).coalesce(1)
    whole, cut = (language_id.fit(table, rules=replace(RULES, counted_chars=n)) for n in (10**9, 1))
    assert set(whole.words) == set(cut.words) and set(whole.grams) == set(cut.grams)
    for w, i in whole.words.items():
        np.testing.assert_array_equal(whole.rows[i], cut.rows[cut.words[w]])
