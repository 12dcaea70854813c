"""Language of a text by words first, character n-grams where a word is unknown.

The model holds, per language, the log frequency of each word seen often enough
in labelled documents, and of each character n-gram of words. A known word is
scored by its frequencies. An unseen word is cut, from its start, into the
longest n-grams known, each step backing off to a shorter one. The sums give
the posterior of each language.
"""

from __future__ import annotations

import math
import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundburn.llm.base import carried, ddl, in_arrow

#: Word characters that are numbers but no digits, such as one half or a Roman numeral: no letters.
_NUMERALS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) in ("No", "Nl"))
_LETTERS = re.compile(rf"[^\W\d_{_NUMERALS}]+")
_RUNS = re.compile(r"[^\W\d_]+")  # with those numerals, many times as fast


@dataclass(frozen=True)
class LanguageRules:
    max_rows: int = 40_000      # labelled documents that the model is fitted on, about
    min_count: int = 3          # occurrences that make a word, or n-gram, known
    max_gram: int = 5           # longest n-gram; the shortest is one character
    counted_chars: int = 2_000_000  # of text that a task counts before it sends its counts on
    smoothing: float = 0.5
    discount: float = 0.4       # factor for each step back from a word
    max_score_nats: float = 30.0  # evidence beyond this does not change the score
    cached_words: int = 200_000   # unseen words whose scores a worker keeps


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased."""
    runs = _RUNS.findall(text.lower())
    return runs if all(map(str.isalpha, runs)) else [w for r in runs for w in _LETTERS.findall(r)]


def _counted(max_gram: int, counted_chars: int):
    """Counts of (language, kind, word or n-gram) of some texts at a time; kind 0 a word, n an n-gram."""

    def sent(lang: str, words: Counter[str]) -> Iterator[pa.RecordBatch]:
        for size in range(max_gram + 1):
            grams = words
            if size:
                grams = Counter()
                for w, n in words.items():
                    for i in range(len(w) - size + 1):
                        grams[w[i:i + size]] += n
            if grams:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array([size] * len(grams), pa.int32()),
                     pa.array(list(grams), pa.string()), pa.array(list(grams.values()), pa.int64())],
                    names=["lang", "kind", "gram", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter[str]] = {}
        chars = 0
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                text = text.as_py()
                held.setdefault(lang, Counter()).update(words_of(text))
                chars += len(text)
                if chars >= counted_chars:
                    for item in held.items():
                        yield from sent(*item)
                    held, chars = {}, 0
        for item in held.items():
            yield from sent(*item)

    return run


@dataclass
class LanguageModel:
    """languages; word -> row of log frequencies; n-gram -> row; the fallback row."""

    languages: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    rows: np.ndarray
    unknown: np.ndarray
    rules: LanguageRules


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", rules: LanguageRules = LanguageRules(), doc_id: str = "doc_id") -> LanguageModel:
    """Fits on labelled rows of ``docs``; null texts and null labels are left out.

    At most about ``max_rows`` rows are used, chosen by a hash of id and text,
    so that the same rows are chosen anywhere and copies are not chosen all or
    none; languages are known from all rows. Every word and n-gram that those
    rows have ``min_count`` times is kept, whatever its language. Counting is
    spread over the cluster; what reaches the driver is bounded by the rows.
    """
    by = [F.col(doc_id)] if doc_id in docs.columns else []
    labelled = docs.select(F.col(text).alias("t"), F.col(lang).alias("l"), F.xxhash64(*by, text).alias("h")).where("t is not null and l is not null")
    per_lang = {r["l"]: r["n"] for r in labelled.groupBy("l").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not per_lang:
        return LanguageModel([], {}, {}, np.zeros((0, 0)), np.zeros(0), rules)
    # The same number of rows of each language, as far as there are so many.
    share = max(1, rules.max_rows // len(per_lang))
    keep = F.lit(False)
    spread = F.pmod(F.col("h"), F.lit(1_000_000))
    for name, n in per_lang.items():
        keep = keep | ((F.col("l") == name) & (spread < math.ceil(1_000_000 * min(1.0, share / n))))
    names = sorted(per_lang)
    counts = (
        in_arrow(labelled.where(keep).select("t", "l"), _counted(rules.max_gram, rules.counted_chars), "lang string, kind int, gram string, n long")
        .groupBy("kind", "gram").pivot("lang", names).agg(F.sum("n"))
    )
    total = sum((F.coalesce(F.col(f"`{n}`"), F.lit(0)) for n in names), F.lit(0))
    counts = counts.withColumn("_n", total).where(F.col("_n") >= rules.min_count)
    found = counts.select("kind", "gram", *[F.coalesce(F.col(f"`{n}`"), F.lit(0)).alias(f"n{i}") for i, n in enumerate(names)]).toArrow()
    kind = found["kind"].to_numpy()
    gram = found["gram"].to_numpy().tolist()
    words, grams = ({gram[i]: int(i) for i in np.flatnonzero(at)} for at in (kind == 0, kind > 0))
    seen = np.column_stack([found[f"n{i}"].to_numpy() for i in range(len(names))]).astype(np.float64)
    logs = np.zeros_like(seen)
    unknown = np.zeros(len(names))
    for k in np.unique(kind):
        at = kind == k
        mass = seen[at].sum(0) + rules.smoothing * (at.sum() + 1)
        logs[at] = np.log(seen[at] + rules.smoothing) - np.log(mass)
        if k == 1:
            unknown = np.log(rules.smoothing) - np.log(mass)
    return LanguageModel(names, words, grams, logs, unknown, rules)


def word_scores(model: LanguageModel, word: str) -> np.ndarray:
    """Log score of a word per language: its own, or its longest known n-grams'."""
    row = model.words.get(word)
    if row is not None:
        return model.rows[row]
    total, at, penalty = np.zeros(len(model.languages)), 0, math.log(model.rules.discount)
    while at < len(word):
        for size in range(min(model.rules.max_gram, len(word) - at), 0, -1):
            row = model.grams.get(word[at:at + size])
            if row is not None:
                total += model.rows[row] + penalty * (model.rules.max_gram - size + 1)
                at += size
                break
        else:
            total += model.unknown
            at += 1
    return total


def predict(model: LanguageModel, text: str | None, cache: dict[str, np.ndarray]) -> tuple[str, float]:
    """Language and its posterior; ``und`` and 0.0 where there are no letters
    or nothing was learned. Ties go to the first language by name."""
    words = words_of(text or "")
    if not words or not model.languages:
        return "und", 0.0
    rows, total = [], np.zeros(len(model.languages))
    known = model.words.get
    for w in words:
        row = known(w)
        if row is not None:
            rows.append(row)
            continue
        score = cache.get(w)
        if score is None:
            if len(cache) >= model.rules.cached_words:
                cache.clear()
            score = cache[w] = word_scores(model, w)
        total += score
    if rows:
        total += model.rows[rows].sum(0)
    best = int(total.argmax())
    odds = np.exp(np.clip(total - total[best], -model.rules.max_score_nats, 0))
    return model.languages[best], float(1 / odds.sum())


def identified(docs: DataFrame, model: LanguageModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all by default) with lang_pred and score.
    Whole texts are scored; null and letterless texts are ``und``."""
    keep = carried(docs, keep, "_text lang_pred score")
    model_of = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the rows it was fitted on

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, np.ndarray] = {}
        for batch in batches:
            found = [predict(model_of.value, t, cache) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*keep, "lang_pred", "score"])

    return in_arrow(docs.select(*keep, F.col(text).alias("_text")), run, f"{ddl(docs, keep)}lang_pred string, score double")
