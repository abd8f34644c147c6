"""Chat formatting in budgeted windows.

A conversation is cut, between turns, into spans whose tokens fit the budget. Each window shows the conversation's system turn, a
limited number of turns before the span, and the span; only assistant texts of the span are under the loss mask, so every assistant
text is trained on exactly once however often it is shown. Beside a long system turn, or a span that is one long turn, history shrinks, down to nothing: a
window exceeds the budget only where the system turn and a single turn together do.

Template of a turn: ``<s>[INST] role [/INST]text</s>``. Control strings inside roles and texts get a backslash after their first
character, and those that already have backslashes there get one more, so that reading back is exact.

Turns are put together in blocks of ``block`` consecutive turn numbers; spans do not cross blocks, while history and system turn do. So
no row ever holds more than a block, however long a conversation is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardloom.llm.common import filled, words_of, written

# fixed values: the template's control strings
OPEN, BETWEEN, CLOSE = "<s>[INST] ", " [/INST]", "</s>"
CONTROL = r"(/?s>|/?INST\])"


@dataclass(frozen=True)
class Budget:
    """``tokens`` for a window, of which at most ``history_tokens`` in at most ``history_turns`` turns are repeated."""

    tokens: int = 1024
    history_turns: int = 2
    history_tokens: int = 256
    block: int = 1024


def word_tokens(text: Column) -> Column:
    """Tokens of a turn: its words and the four marks of the template."""
    return F.size(words_of(text)) + 4


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*){CONTROL}", r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)\\{CONTROL}", "$1$2$3")


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), escape(turn["role"]), F.lit(BETWEEN))


def _turn(turn: Column) -> Column:
    return F.concat(_head(turn), escape(turn["text"]), F.lit(CLOSE))


def _blocks(turns: DataFrame, names: Sequence[str], budget: Budget, tokens: Callable[[Column], Column]) -> DataFrame:
    """(conv_id, block, turns): each turn with its place, role, text and tokens, in order of number, role and text; nulls first."""
    conv_id, turn, role, text = (F.col(f"`{n}`") for n in names)
    rows = turns.select(
        conv_id.alias("conv_id"), F.floor(turn / budget.block).alias("block"),
        F.struct(turn.alias("turn"), filled(role).alias("role"), filled(text).alias("text")).alias("turn"),
    )
    blocks = rows.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    placed = F.transform(
        "turns",
        lambda x, i: F.struct(F.col("block").alias("block"), i.alias("i"), x["role"].alias("role"), x["text"].alias("text"), tokens(x["text"]).alias("tokens")),
    )
    return blocks.select("conv_id", "block", placed.alias("turns"))


def _latest(turns: Column, budget: Budget, limit: Column) -> Column:
    """The longest end of ``turns`` of at most ``limit`` tokens."""
    back = F.reverse(F.slice(turns, -F.least(F.size(turns), F.lit(budget.history_turns)), F.lit(budget.history_turns)))
    back = F.when(F.size(turns) > 0, back).otherwise(turns)
    fits = F.aggregate(
        back,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("used"), F.lit(True).alias("open")),
        lambda s, x: F.struct(
            (s["n"] + (s["open"] & (s["used"] + x["tokens"] <= limit)).cast("int")).alias("n"),
            (s["used"] + x["tokens"]).alias("used"),
            (s["open"] & (s["used"] + x["tokens"] <= limit)).alias("open"),
        ),
        lambda s: s["n"],
    )
    return F.reverse(F.slice(back, F.lit(1), fits))


def _starts(budget: Budget) -> Column:
    """Where spans begin: running sums of tokens, begun anew whenever the next turn would exceed what is left beside the rest."""
    room = F.greatest(F.lit(budget.tokens) - F.coalesce(F.col("system.tokens"), F.lit(0)), F.lit(0))
    own = room - F.least(F.lit(budget.history_tokens), F.floor(room / 2))  # history has at most half of what the system turn leaves
    step = F.aggregate(
        "turns",
        F.struct(F.lit(0).alias("i"), F.lit(0).alias("used"), F.array().cast("array<int>").alias("starts")),
        lambda s, x: F.struct(
            (s["i"] + 1).alias("i"),
            F.when((s["i"] == 0) | (s["used"] + x["tokens"] > own), x["tokens"]).otherwise(s["used"] + x["tokens"]).alias("used"),
            F.when((s["i"] == 0) | (s["used"] + x["tokens"] > own), F.concat(s["starts"], F.array(s["i"]))).otherwise(s["starts"]).alias("starts"),
        ),
        lambda s: s["starts"],
    )
    return step


def format_windows(turns: DataFrame, columns: Sequence[str] = ("conv_id", "turn", "role", "text"), budget: Budget = Budget(),
                   tokens: Callable[[Column], Column] = word_tokens) -> DataFrame:
    """``conv_id, block, window, formatted, repeated, loss``: ``repeated`` turns at the head are shown again, ``loss`` are spans
    (start, length) in characters of ``formatted``.

    Null roles and texts count as empty; a null conversation id is a conversation, and null turn numbers come first in it; equal rows are
    turns of their own; a turn longer than the budget has a window to itself and is not cut; an empty table gives no windows.
    """
    blocks = written(_blocks(turns, columns, budget, tokens), "blocks")
    system = F.get(F.filter("turns", lambda x: x["role"] == "system"), F.lit(0))
    ends = blocks.select("conv_id", "block", _latest(F.col("turns"), budget, F.lit(budget.history_tokens)).alias("latest"), system.alias("system"))
    in_order = Window.partitionBy("conv_id").orderBy(F.col("block").asc_nulls_first())
    seen = F.first("system", ignorenulls=True).over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    heads = ends.select(
        F.col("conv_id").alias("c"), F.col("block").alias("b"), F.lag("latest").over(in_order).alias("before"), seen.alias("system")
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("block").eqNullSafe(F.col("b"))
    rows = blocks.join(heads, same).drop("c", "b").withColumn("starts", _starts(budget))
    rows = rows.withColumn("before", F.coalesce("before", F.slice("turns", 1, 0)))
    spans = rows.select("conv_id", "block", "turns", "before", "system", "starts", F.posexplode("starts").alias("window", "start"))
    until = F.coalesce(F.get("starts", F.col("window") + 1), F.size("turns"))
    earlier = F.concat("before", F.slice("turns", F.lit(1), F.col("start"))).alias("earlier")
    spans = spans.select("conv_id", "block", "window", "system", earlier, F.slice("turns", F.col("start") + 1, until - F.col("start")).alias("span"))
    taken = F.aggregate("span", F.coalesce(F.col("system.tokens"), F.lit(0)), lambda s, x: s + x["tokens"])
    history = _latest(F.col("earlier"), budget, F.least(F.lit(budget.history_tokens), F.lit(budget.tokens) - taken))
    spans = spans.withColumn("history", history).drop("earlier")
    at = F.struct(F.col("system.block"), F.col("system.i"))
    shown = F.exists(F.concat("history", "span"), lambda x: F.struct(x["block"], x["i"]).eqNullSafe(at))
    first = F.get("span", F.lit(0))
    later = (F.col("system.block") == first["block"]) & (F.col("system.i") >= first["i"])
    lead = F.when(F.col("system").isNull() | shown | F.coalesce(later, F.lit(False)), F.slice("span", 1, 0)).otherwise(F.array("system"))
    spans = spans.withColumn("again", F.concat(lead, "history")).withColumn("all", F.concat("again", "span"))
    places = F.aggregate(
        "all",
        F.struct(F.lit(0).alias("i"), F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("loss")),
        lambda s, x: F.struct(
            (s["i"] + 1).alias("i"),
            (s["at"] + F.char_length(_turn(x))).alias("at"),
            F.when(
                (s["i"] >= F.size("again")) & (x["role"] == "assistant"),
                F.concat(s["loss"], F.array(F.struct((s["at"] + F.char_length(_head(x))).alias("start"), F.char_length(escape(x["text"])).alias("length")))),
            )
            .otherwise(s["loss"])
            .alias("loss"),
        ),
        lambda s: s["loss"],
    )
    formatted = F.array_join(F.transform("all", _turn), "")
    return spans.select("conv_id", "block", "window", formatted.alias("formatted"), F.size("again").alias("repeated"), places.alias("loss"))


def read_back(windows: DataFrame) -> DataFrame:
    """From the formatted windows alone: ``conv_id, block, window``, ``turns`` (role, text) without the repeated ones, and the texts
    under the loss mask."""
    pieces = F.split("formatted", CLOSE)
    own = F.slice(pieces, F.col("repeated") + 1, F.size(pieces) - 1 - F.col("repeated"))
    parts = F.transform(own, lambda x: F.split(F.substring(x, len(OPEN) + 1, 1 << 30), r" \[/INST\]", 2))
    turns = F.transform(parts, lambda x: F.struct(unescape(F.get(x, F.lit(0))).alias("role"), unescape(F.get(x, F.lit(1))).alias("text")))
    losses = F.transform("loss", lambda x: unescape(F.substring(F.col("formatted"), x["start"] + 1, x["length"])))
    return windows.select("conv_id", "block", "window", turns.alias("turns"), losses.alias("losses"), F.char_length("formatted").alias("chars"))


def digests(windows: DataFrame) -> DataFrame:
    """One row for each conversation: counts and SHA-256 of its turns and of the texts under the loss mask, read back from the windows.

    A digest of a whole conversation needs its text in one value; this is the one place where it comes together.
    """
    read = read_back(windows)
    texts = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    part = F.struct("block", "window", texts.alias("turns"), F.array_join("losses", "").alias("loss"), F.size("turns").alias("n"), "chars")
    whole = read.groupBy("conv_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    loss = F.array_join(F.transform("parts", lambda x: x["loss"]), "")

    def total(field: str) -> Column:
        return F.aggregate("parts", F.lit(0).cast("long"), lambda s, x: s + x[field])

    return whole.select(
        "conv_id", total("n").alias("n_turns"), F.sha2(F.array_join(F.transform("parts", lambda x: x["turns"]), ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), total("chars").alias("formatted_chars"),
    )
