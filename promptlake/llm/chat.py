r"""Chat formatting into budgeted windows with a loss mask, in DataFrame functions only.

A turn is written ``<|turn|>role<|text|>text<|end|>`` and a line end.  Inside roles and
texts a backslash is doubled, and one is put after the first character of every
control string, this template's and those of other common ones; so no marker can be
forged, and dropping one backslash before each character restores the text.

Windows: of the budget, the system turn and the history allowance leave ``room``.
Prefix sums of turn tokens, cut every ``stride`` tokens, give each turn its window;
turns are never cut.  A turn of over half the room starts the sums anew, and so does
the turn after one of over a stride, so that a long turn costs its neighbours nothing.
With stride = room - longest other turn no window exceeds the budget unless one turn
alone does, which then has a window of its own.  A later window begins with the system
turn and the last few turns before it, as far as the history allowance goes.  Those
repeated turns are context: the loss mask holds each assistant text once, in the window
it belongs to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import text_of

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
#: Tokens of a window, and of the history that a window may repeat.
BUDGET, HISTORY_TOKENS, HISTORY_TURNS = 1024, 256, 2
TURN_OVERHEAD = 4
#: What follows the first character of a control string.
_OPENERS = r"([<\[])(?=\||/?s>|</?SYS>>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _OPENERS, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]")) + TURN_OVERHEAD


def windows(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", budget: int = BUDGET, history_tokens: int = HISTORY_TOKENS, history_turns: int = HISTORY_TURNS) -> DataFrame:
    """conv_id, window, n_context, formatted and mask (array of start and length, in code points).

    Turns go by turn number; equal numbers by role, then text.  Null roles and texts
    are empty, null numbers come first, repeated rows are turns, rows without a
    conversation form one; very long turns are windows of their own; an empty table
    gives an empty result; other columns don't matter, whatever their names.
    """
    conv = Window.partitionBy("conv_id")
    order = conv.orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    t = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), text_of(role_col).alias("role"), text_of(text_col).alias("text")).withColumn("tokens", _tokens(F.col("text")))
    t = t.withColumn("rn", F.row_number().over(order)).withColumn("is_system", (F.col("rn") == 1) & (F.col("role") == "system"))
    own = F.when(F.col("is_system"), 0).otherwise(F.col("tokens"))
    t = t.withColumn("own", own).withColumn("room", F.greatest(F.lit(budget - history_tokens) - F.max(F.col("tokens") - F.col("own")).over(conv), F.lit(1)))
    t = t.withColumn("long", 2 * F.col("own") > F.col("room")).withColumn("upto", F.coalesce(F.sum("own").over(before), F.lit(0)))
    t = t.withColumn("stride", F.greatest(F.col("room") - F.coalesce(F.max(F.when(~F.col("long"), F.col("own"))).over(conv), F.lit(0)), F.lit(1)))
    anew = F.col("long") | F.coalesce(F.lag("own").over(order) > F.col("stride"), F.lit(False))
    t = t.withColumn("base", F.coalesce(F.max(F.when(anew, F.col("upto"))).over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)))
    t = t.withColumn("window", F.dense_rank().over(conv.orderBy("base", F.floor((F.col("upto") - F.col("base")) / F.col("stride")))) - 1).withColumn("windows", F.max("window").over(conv) + 1)
    # the windows in which a turn is context: all later ones for the system turn, else those that begin soon after it
    later = []
    for d in range(1, history_turns + 1):
        t = t.withColumn(f"w{d}", F.lead("window", d).over(order)).withColumn(f"u{d}", F.lead("upto", d).over(order))
        begins = F.col(f"w{d}") != F.col(f"w{d - 1}" if d > 1 else "window")
        fits = F.col(f"u{d}") - F.col("upto") <= history_tokens
        later.append(F.when(begins & fits & ~F.col("is_system"), F.col(f"w{d}")))
    repeats = F.when(F.col("is_system") & (F.col("windows") > 1), F.sequence(F.col("window") + 1, F.col("windows") - 1)).otherwise(F.array_compact(F.array(*later)))
    t = t.withColumn("role", escape(F.col("role"))).withColumn("text", escape(F.col("text")))
    t = t.withColumn("at", F.explode(F.concat(F.array("window"), repeats))).withColumn("context", F.col("at") != F.col("window"))
    piece = F.concat(F.lit(TURN), F.col("role"), F.lit(TEXT), F.col("text"), F.lit(END))
    t = t.withColumn("piece", piece).withColumn("start", F.coalesce(F.sum(F.length("piece")).over(Window.partitionBy("conv_id", "at").orderBy("rn").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    target = F.when(~F.col("context") & (F.col("role") == "assistant"), F.struct((F.col("start") + len(TURN) + F.length("role") + len(TEXT)).alias("start"), F.length("text").alias("length")))
    return (
        t.groupBy("conv_id", F.col("at").alias("window"))
        .agg(F.count_if("context").cast("int").alias("n_context"), F.array_sort(F.collect_list(F.struct("rn", "piece"))).alias("p"), F.array_sort(F.collect_list(target)).alias("mask"))
        .withColumn("formatted", F.array_join(F.transform("p", lambda x: x["piece"]), "")).drop("p")
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """What the windows say of each conversation: turns without the repeated ones, and the text under the mask."""
    pattern = F.lit(r"(?s)<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>\n")
    roles, texts = (F.regexp_extract_all("formatted", pattern, F.lit(i)) for i in (1, 2))
    w = formatted.withColumn("turns", F.arrays_zip(roles.alias("role"), texts.alias("text")))
    w = w.withColumn("own", F.slice("turns", F.col("n_context") + 1, F.greatest(F.size("turns") - F.col("n_context"), F.lit(0))))
    said = F.array_join(F.transform("own", lambda x: F.concat(unescape(x["role"]), F.lit("\n"), unescape(x["text"]), F.lit("\n"))), "")
    loss = F.array_join(F.transform("mask", lambda m: unescape(F.substr(F.col("formatted"), m["start"] + 1, m["length"]))), "")
    parts = F.array_sort(F.collect_list(F.struct("window", said.alias("said"), loss.alias("loss"))))
    joined = lambda c: F.array_join(F.transform("parts", lambda x: x[c]), "")
    return (
        w.groupBy("conv_id")
        .agg(F.sum(F.size("own")).alias("n_turns"), parts.alias("parts"), F.sum(F.length("formatted")).alias("formatted_chars"), F.count("*").alias("n_windows"))
        .select(
            "conv_id", F.col("n_turns").cast("long").alias("n_turns"), F.sha2(joined("said"), 256).alias("turns_sha256"),
            F.length(joined("loss")).cast("long").alias("loss_chars"), F.sha2(joined("loss"), 256).alias("loss_sha256"), F.col("formatted_chars").cast("long").alias("formatted_chars"), "n_windows",
        )
    )
