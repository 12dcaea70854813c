"""Conversations as training windows within a token budget.

Turns are cut into windows by prefix sums of their tokens: a window takes the
turns whose prefix sums fall into one stretch of half of what the budget leaves
beside the conversation's system turn and the history; a longer turn has a
window of its own. Each window repeats the system turn and the last turns of
the window before it, as many as still fit. So a whole window keeps to the
budget unless the system turn and its one new turn are too much by themselves.
Only the new assistant turns are under the loss mask, so every assistant text
is learned once.

A turn is written ``<|role|>text<|end|>`` and a newline; ``&``, ``<``, ``[``
and newlines in roles are escaped, so no text can look like a mark.
DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundburn.llm.base import staged

#: Escapes in the order in which they are applied; undone in the opposite order.
_ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
_ROLE_ESCAPES = (*_ESCAPES, ("|", "&#124;"), ("\n", "&#10;"))


@dataclass(frozen=True)
class ChatRules:
    budget: int = 1024       # tokens of a whole window; a turn is never cut
    history_turns: int = 2   # turns repeated from the window before
    history_tokens: int = 256  # a longer turn is not repeated, nor those before it


def _replaced(col: Column, pairs) -> Column:
    for old, new in pairs:
        col = F.replace(col, F.lit(old), F.lit(new))
    return col


def escaped(text: Column) -> Column:
    return _replaced(text, _ESCAPES)


def unescaped(text: Column) -> Column:
    return _replaced(text, [(b, a) for a, b in reversed(_ESCAPES)])


def n_tokens(text: Column) -> Column:
    """Words and marks, the unit of the budget."""
    return F.regexp_count(text, F.lit(r"\w+|[^\w\s]")).cast("long") + 3


def formatted(turns: DataFrame, rules: ChatRules = ChatRules()) -> DataFrame:
    """Rows of (conv_id, window, text, loss array<struct<start, end>>, n_repeated).

    ``turns`` has conv_id, turn, role, text; null role or text counts as empty.
    Turns are ordered by turn, nulls first, ties by role and text. ``loss``
    gives half-open spans of code points of ``text``. ``n_repeated`` counts the
    turns at the start of the window that an earlier window had. Window sums
    run over sorted rows and spill; no conversation is gathered whole.
    """
    c = F.col
    rows = turns.select(
        c("conv_id"), c("turn"), F.coalesce(c("role"), F.lit("")).alias("role"), F.coalesce(c("text"), F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(c("turn").asc_nulls_first(), "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("tokens", n_tokens(c("text"))).withColumn("nth", F.row_number().over(order))
    head = F.min(F.when(c("role") == "system", F.struct("nth", "tokens"))).over(Window.partitionBy("conv_id"))
    rows = rows.withColumn("room", F.lit(rules.budget) - F.coalesce(head["tokens"], F.lit(0)))  # beside the system turn
    half = F.greatest(F.floor((c("room") - rules.history_tokens) / 2), F.lit(1))
    rows = rows.withColumn("large", c("tokens") > half)
    rows = rows.withColumn("run", F.coalesce(F.sum(c("large").cast("int")).over(upto), F.lit(0)) * 2 + c("large").cast("int"))
    rows = rows.withColumn("bin", F.floor(F.coalesce(F.sum(F.when(~c("large"), c("tokens"))).over(upto), F.lit(0)) / half))
    before = F.lag(F.struct("run", "bin")).over(order)
    rows = rows.withColumn("cut", (before.isNull() | (before != F.struct("run", "bin"))).cast("int"))
    rows = rows.withColumn("window", F.sum("cut").over(order.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    within = Window.partitionBy("conv_id", "window").orderBy(c("nth").desc())
    rows = rows.withColumn("from_end", F.row_number().over(within))
    rows = rows.withColumn("tokens_to_end", F.sum("tokens").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("total", F.sum("tokens").over(Window.partitionBy("conv_id", "window")))
    # A turn from_end places before the next window's first one sees that window's new tokens so many rows on.
    after = F.get(F.array(*[F.lead("total", k).over(order) for k in range(1, rules.history_turns + 1)], F.lit(0).cast("long")), c("from_end") - 1)
    rows = rows.withColumn("may_repeat", F.least(F.lit(rules.history_tokens), c("room") - after))
    rows = staged(rows.select("conv_id", "nth", "role", "text", "window", "from_end", "tokens_to_end", "may_repeat"), "turns")

    last = rows.groupBy("conv_id").agg(F.max("window").alias("last"), F.min(F.when(c("role") == "system", c("nth"))).alias("system"))
    met = rows.alias("r").join(last.alias("l"), c("r.conv_id").eqNullSafe(c("l.conv_id"))).select("r.*", "l.last", "l.system")
    is_system = c("nth") == F.coalesce(c("system"), F.lit(0))
    repeats = (c("window") < c("last")) & ~is_system & (c("from_end") <= rules.history_turns) & (c("tokens_to_end") <= c("may_repeat"))
    copies = F.concat(
        F.array(F.struct(c("window").alias("to"), F.lit(False).alias("again"))),
        F.when(is_system & (c("window") < c("last")), F.transform(F.sequence(c("window") + 1, c("last")), lambda w: F.struct(w.alias("to"), F.lit(True).alias("again"))))
        .when(repeats, F.array(F.struct((c("window") + 1).alias("to"), F.lit(True).alias("again"))))
        .otherwise(F.array().cast("array<struct<to:bigint,again:boolean>>")))
    placed = met.select("conv_id", "nth", "role", "text", F.explode(copies).alias("at"))
    placed = placed.withColumn("head", F.concat(F.lit("<|"), _replaced(c("role"), _ROLE_ESCAPES), F.lit("|>")))
    placed = placed.withColumn("body", escaped(c("text")))
    cell = F.struct("nth", "head", "body", c("at.again").alias("again"), (c("role") == "assistant").alias("target"))
    windows = placed.groupBy("conv_id", c("at.to").alias("window")).agg(F.sort_array(F.collect_list(cell)).alias("cells"))
    end = "<|end|>\n"
    written = F.array_join(F.transform("cells", lambda x: F.concat(x["head"], x["body"], F.lit(end))), "")
    sized = F.transform("cells", lambda x: F.struct(
        F.length(x["head"]).alias("skip"), F.length(x["body"]).alias("size"), (x["target"] & ~x["again"]).alias("learn")))
    spans = F.aggregate(
        sized, F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda s, x: F.struct(
            (s["at"] + x["skip"] + x["size"] + len(end)).alias("at"),
            F.when(x["learn"], F.concat(s["spans"], F.array(F.struct(
                (s["at"] + x["skip"]).alias("start"), (s["at"] + x["skip"] + x["size"]).alias("end"))))).otherwise(s["spans"]).alias("spans")))["spans"]
    return windows.select(
        "conv_id", "window", written.alias("text"), spans.alias("loss"),
        F.size(F.filter("cells", lambda x: x["again"])).alias("n_repeated"))


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation, parsed from the formatted text alone: conv_id, turns
    array<struct<role, text>>, learned (text under the masks), formatted_chars."""
    c = F.col
    parts = F.filter(F.split("text", r"<\|end\|>\n"), lambda x: x != "")
    cut = F.transform(parts, lambda x: F.struct(
        _replaced(F.substring_index(F.substring(x, F.lit(3), F.length(x)), "|>", 1), [(b, a) for a, b in reversed(_ROLE_ESCAPES)]).alias("role"),
        unescaped(F.substring(x, F.instr(x, "|>") + 2, F.length(x))).alias("text")))
    fresh = F.filter(cut, lambda x, i: i >= c("n_repeated"))
    learned = F.array_join(F.transform("loss", lambda s: unescaped(F.substring(c("text"), s["start"] + 1, s["end"] - s["start"]))), "")
    each = windows.select("conv_id", "window", fresh.alias("turns"), learned.alias("learned"), F.length("text").alias("size"))
    whole = each.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("window", "turns", "learned"))).alias("all"), F.sum("size").alias("formatted_chars"))
    return whole.select(
        "conv_id", F.flatten(F.transform("all", lambda w: w["turns"])).alias("turns"),
        F.array_join(F.transform("all", lambda w: w["learned"]), "").alias("learned"), "formatted_chars")


def digests(conversations: DataFrame) -> DataFrame:
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return conversations.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"))
