"""Quality rules by host: rule failures of a host's documents, shrunk towards
the rate of all hosts, decide how strictly its documents are judged.

A document fails for itself by the base rules. Beside them soft rules mark
doubtful documents. A host's rate of failing documents (base or soft) is shrunk
with a beta prior fitted to all hosts by moments, so that few documents prove
little. In a host over the limit a soft failure is enough to reject; elsewhere
it is not. A document without any failure is kept whatever its host.

DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundburn.llm.base import SPACE_CLASS, carried, staged


@dataclass(frozen=True)
class HostRules:
    min_words: int = 20             # base: fewer fail
    max_repeat_percent: int = 30    # base: more words in repeated windows fail
    window: int = 8                 # words of a repeated window
    max_symbol_ratio: float = 0.5   # soft: symbols per word
    max_dup_lines: float = 0.3      # soft: repeated lines of all lines with a word
    word_length: tuple[float, float] = (2.0, 14.0)  # soft: mean characters of a word
    max_host_rate: float = 0.5      # shrunk failure rate of a bad host
    host_salts: int = 32            # parts that a host's rows are dealt to in the join


def _pairs_hashed(hashes: Column, step: int) -> Column:
    """Hash of each element with the one ``step`` further on."""
    n = F.greatest(F.size(hashes) - step, F.lit(0))
    return F.zip_with(F.slice(hashes, F.lit(1), n), F.slice(hashes, F.lit(step + 1), n), lambda a, b: F.xxhash64(a, b))


def _covered(windows: Column, width: int) -> Column:
    """Words inside windows that occur twice or more; O(n log n), no shuffle."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    n = F.size(placed)
    same = F.zip_with(F.slice(placed, F.lit(1), n - 1), F.slice(placed, F.lit(2), n - 1), lambda a, b: F.when(
        a["h"] == b["h"], F.array(a["i"], b["i"])))
    spots = F.sort_array(F.array_distinct(F.flatten(F.filter(same, lambda x: x.isNotNull()))))
    gaps = F.zip_with(spots, F.slice(spots, F.lit(2), F.greatest(F.size(spots) - 1, F.lit(0))),
                      lambda a, b: F.least(F.coalesce(b - a, F.lit(width)), F.lit(width)))
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, g: total + g)


def with_features(docs: DataFrame, text: str = "text", rules: HostRules = HostRules()) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (longs).

    Null text counts as empty. Windows are compared by a 64-bit hash of their
    words, within one text. ``window`` must be a power of two.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    width = rules.window
    if width & (width - 1):
        raise ValueError("window must be a power of two")
    out = docs.withColumn("_words", F.filter(F.split(body, f"{SPACE_CLASS}+"), lambda w: w != ""))
    # A column for each step: inside one expression every use of an array would compute it again.
    out = out.withColumn("_windows", F.transform(F.col("_words"), lambda w: F.xxhash64(w)))
    step = 1
    while step < width:
        out, step = out.withColumn("_windows", _pairs_hashed(F.col("_windows"), step)), step * 2
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = out.withColumn("_lines", lines)
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    return out.select(
        *[F.col(c) for c in docs.columns],
        F.size("_words").cast("long").alias("n_words"),
        (F.length(body) - F.regexp_count(body, F.lit(SPACE_CLASS))).cast("long").alias("word_chars"),
        F.regexp_count(body, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(repeated, _covered(F.col("_windows"), width)).otherwise(F.lit(0).cast("long")).alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("_n_lines"),
    )


def with_failures(features: DataFrame, rules: HostRules = HostRules()) -> DataFrame:
    """Adds base_failed and soft_failed."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    mean = F.col("word_chars") / words
    low, high = rules.word_length
    base = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))
    soft = (
        (F.col("n_symbols") > rules.max_symbol_ratio * words)
        | (F.col("n_dup_lines") > rules.max_dup_lines * F.greatest(F.col("_n_lines"), F.lit(1)))
        | (mean < low) | (mean > high)
    )
    return features.withColumn("base_failed", base).withColumn("soft_failed", soft)


def host_verdicts(judged: DataFrame, host: str, rules: HostRules = HostRules()) -> DataFrame:
    """One row per host: host, n_docs, n_failed, rate (shrunk), bad.

    The beta prior's mean and strength are the moments of the hosts' rates,
    each host counting as one. With no spread to learn from (one host, or all
    alike) the prior is worth one document.
    """
    counts = staged(judged.groupBy(F.col(host).alias("_host")).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum((F.col("base_failed") | F.col("soft_failed")).cast("long")).alias("n_failed")), "hosts")
    moments = counts.agg(
        F.avg(F.col("n_failed") / F.col("n_docs")).alias("m"),
        F.var_pop(F.col("n_failed") / F.col("n_docs")).alias("v")).first()  # one row
    mean, spread = moments["m"] or 0.0, moments["v"] or 0.0
    strength = max(mean * (1 - mean) / spread - 1, 1.0) if spread > 0 else 1.0
    rate = (F.col("n_failed") + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength))
    return counts.withColumn("rate", rate).withColumn("bad", F.col("rate") > rules.max_host_rate)


def judged_by_host(docs: DataFrame, text: str = "text", host: str = "source", rules: HostRules = HostRules(),
                   columns: list[str] | None = None) -> DataFrame:
    """Documents with their features, base_failed, soft_failed, host_rate and kept.

    Args:
        columns: columns of ``docs`` to carry (all by default).

    Documents without a host form one host. Repeated rows are judged each.
    Features are computed once and staged; the verdicts meet the rows in a
    join on host and salt, so that a host with a third of the rows is dealt to
    ``host_salts`` tasks whether or not Spark finds the hosts small enough to
    broadcast.
    """
    columns = carried(docs, columns, "_text _of _salt _words _windows _lines _n_lines n_words word_chars n_symbols n_dup_lines "
                      "n_repeat_words base_failed soft_failed host_rate rate bad kept")
    features = with_failures(with_features(docs.select(*columns, F.col(text).alias("_text"), F.col(host).alias("_of")), "_text", rules), rules)
    own = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "_n_lines", "base_failed", "soft_failed"]
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(rules.host_salts)).cast("int")
    judged = staged(features.select(*columns, "_of", *own, salt.alias("_salt")), "features")
    verdicts = host_verdicts(judged, "_of", rules).select(
        "_host", "rate", "bad", F.explode(F.sequence(F.lit(0), F.lit(rules.host_salts - 1))).alias("_salt2"))
    met = judged.join(verdicts, F.col("_of").eqNullSafe(F.col("_host")) & (F.col("_salt") == F.col("_salt2")))
    return met.select(
        *columns, *[c for c in own if c != "_n_lines"], F.col("rate").alias("host_rate"),
        (~(F.col("base_failed") | (F.col("bad") & F.col("soft_failed")))).alias("kept"))
