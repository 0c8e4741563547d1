"""Chat formatting: conversations as windows of whole turns within a token budget, with a loss mask.

``conversations`` needs conv_id, turn, role and text; other columns are not read. Turns are ordered by turn (null first),
then role and text, so repeated turns stay, in a fixed order. A null role or text is empty; a null conv_id is a
conversation of its own. An empty table gives an empty table. A turn is never cut: one beyond the budget has a window to
itself. A conversation is one value in one row, so a single one is limited to what a row can hold.

A turn is written as ``<s>role``, a line feed, its text and ``</s>``. Inside role and text a backslash breaks each control
string and is doubled itself, so no text can end its turn, and taking the backslashes away gives the text back.

Window functions give prefix sums of tokens and characters; a window's new turns, its repeated history and all its
offsets are differences of those. Every window starts with the system turn, if the conversation opens with one, then
holds up to ``history`` tokens of the turns before, then its new turns. Only assistant texts among the new turns are
targets, so each is learned once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET = 1024
HISTORY = 128
OPEN, CLOSE = "<s>", "</s>"
# Control strings of this and common templates: <s> </s> <<SYS>> <</SYS>> [INST] [/INST]
_CONTROL = r"(<(?=/?s>)|<(?=<?/?SYS>>)|<(?=/SYS>>)|\[(?=/?INST\]))"


def tokens(text: Column) -> Column:
    """Words and other visible characters; any count of at least 1 a turn can be given instead."""
    return F.regexp_count(text, F.lit(r"\w+|[^\w\s]"))


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _CONTROL, r"$1\\")


def escape_role(role: Column) -> Column:
    """A role also ends at the first line feed that has no backslash."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _turns(conversations: DataFrame, history: int, count: Callable[[Column], Column]) -> DataFrame:
    """conv_id and the ordered array of its turns, each with what lies before it."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    shown = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    shown = shown.withColumn("head", F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"))).withColumn("body", escape(F.col("text")))
    shown = shown.withColumn("segment", F.concat("head", "body", F.lit(CLOSE)))
    shown = shown.withColumn("cost", count(F.col("segment")).cast("bigint")).withColumn("chars", F.length("segment"))
    of = Window.partitionBy("conv_id")
    line = of.orderBy(F.col("turn").asc_nulls_first(), "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    placed = shown.select(
        "conv_id", "role", "segment", "cost", "chars", F.length("head").alias("from"), (F.length("head") + F.length("body")).alias("to"),
        (F.row_number().over(of.orderBy(F.col("turn").asc_nulls_first(), "role", "text")) - 1).alias("i"),
        (F.sum("cost").over(line) - F.col("cost")).alias("before"), (F.sum("chars").over(line) - F.col("chars")).alias("chars_before"),
    )
    # what can be repeated before a turn: the turns, but for the system turn, within ``history`` tokens
    plain = F.when((F.col("i") > 0) | (F.col("role") != "system"), 1)
    back = of.orderBy("before").rangeBetween(-history, -1)
    placed = placed.withColumn("past", F.coalesce(F.sum(plain).over(back), F.lit(0)).cast("int")).withColumn("past_cost", F.coalesce(F.sum(plain * F.col("cost")).over(back), F.lit(0)))
    names = ("i", "role", "segment", "cost", "chars", "from", "to", "before", "chars_before", "past", "past_cost")
    return placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(*names))).alias("turns"))


def windows(
    conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, count: Callable[[Column], Column] = tokens
) -> DataFrame:
    """One row per conversation: conv_id, n_turns and its windows, an array in order.

    A window has ``text``, the ``spans`` (start, end) of its targets in code points, and ``new_from``, where it begins
    to hold turns that no window before it held as new.
    """
    turns = _turns(conversations, history, count)
    first = F.element_at("turns", 1)
    turns = turns.withColumn("system", (first["role"] == "system").cast("int")).withColumn("system_cost", F.when(first["role"] == "system", first["cost"]).otherwise(0))

    def step(state: Column, x: Column) -> Column:
        """Opens a window where the turn doesn't fit into the one before."""
        room = F.greatest(F.lit(budget) - F.col("system_cost") - x["past_cost"], x["cost"])
        opened = F.struct(F.concat(state["starts"], F.array(x["i"])).alias("starts"), (x["before"] + room).alias("limit"))
        return F.when(x["i"] < F.col("system"), state).when(x["before"] + x["cost"] > state["limit"], opened).otherwise(state)

    none = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(-1).cast("bigint").alias("limit"))
    starts = F.aggregate("turns", none, step, lambda s: F.when(F.size(s["starts"]) > 0, s["starts"]).otherwise(F.array(F.col("system"))))
    turns = turns.withColumn("starts", starts).withColumn("n_turns", F.size("turns").cast("bigint"))

    def window(w: Column) -> Column:
        start = F.get("starts", w)
        end = F.coalesce(F.get("starts", w + 1), F.size("turns"))
        opening = F.get("turns", start)
        past = F.when(w > 0, opening["past"]).otherwise(0)
        told = F.slice("turns", start - past + 1, past)
        new = F.slice("turns", start + 1, end - start)
        system = F.slice("turns", 1, F.col("system"))
        text = F.array_join(F.transform(F.concat(system, told, new), lambda x: x["segment"]), "")
        told_chars = F.coalesce(opening["chars_before"] - F.get("turns", start - past)["chars_before"], F.lit(0))
        at = F.when(F.col("system") > 0, F.element_at("turns", 1)["chars"]).otherwise(0) + told_chars
        targets = F.filter(new, lambda x: x["role"] == "assistant")
        offset = lambda x, edge: (at + x["chars_before"] - opening["chars_before"] + x[edge]).cast("int")
        spans = F.transform(targets, lambda x: F.struct(offset(x, "from").alias("start"), offset(x, "to").alias("end")))
        return F.struct(text.alias("text"), spans.alias("spans"), F.when(w > 0, at).otherwise(0).cast("int").alias("new_from"))

    made = F.transform(F.sequence(F.lit(0), F.size("starts") - 1), window)
    return turns.select("conv_id", "n_turns", made.alias("windows"))


def read_turns(windows_column: str = "windows") -> Column:
    """The turns (role, text) of a conversation, read back from its formatted windows."""

    def parse(part: Column) -> Column:
        whole = F.substring(part, len(OPEN) + 1, 1 << 30)
        role = F.regexp_extract(whole, r"(?s)^((?:[^\\\n]|\\.)*+)\n", 1)
        text = F.substring(whole, F.length(role) + 2, F.length(whole))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    new = lambda w: F.substring(w["text"], w["new_from"] + 1, F.length(w["text"]))
    parts = F.flatten(F.transform(windows_column, lambda w: F.filter(F.split(new(w), CLOSE), lambda p: p != "")))
    return F.transform(parts, parse)


def read_targets(windows_column: str = "windows") -> Column:
    """The texts under the loss mask, in order, read back from the formatted windows."""
    cut = lambda text, s: unescape(F.substring(text, s["start"] + 1, s["end"] - s["start"]))
    return F.flatten(F.transform(windows_column, lambda w: F.transform(w["spans"], lambda s: cut(w["text"], s))))
