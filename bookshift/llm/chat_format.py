"""Chat formatting in budgeted windows.

A conversation becomes one or more training windows, cut at turn boundaries
only.  With ``room`` = budget - system tokens, a window takes the next turns as
long as the sum of their tokens stays within the room (from the second window
on, within the room less what is set aside for history: ``history`` tokens, at
most half the room).  A turn that does not fit any more opens the next window,
so a window is over budget only if one turn of its own is longer than the room
(or the system turn alone fills the budget).
Every window opens with the conversation's system turn, then repeats the last
turns before its own (at most ``history`` tokens and never more than the room
left; prefix sums say which), then holds its own turns.  The loss mask marks
the text of the window's own assistant turns, so a repeated answer is never
trained on twice.

Tokens are counted by ``tokens``, by default the UTF-8 bytes of the formatted
turn: no byte-level tokenizer gives more tokens than bytes, so a window within
the budget is within it for all of them.  Pass a column of real counts to fill
windows further.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``.  In roles and texts ``%``,
``<`` and ``[`` (and line breaks in roles) are percent-escaped, so neither
these control strings nor foreign ones (``</s>``, ``[INST]``) can be forged,
and ``unescape`` gives the text back exactly.

Everything is DataFrame expressions and window functions.  The cuts of a
conversation are one fold over its token counts (numbers only, no texts); each
turn finds its window among the cuts by bisection.

Defined results: a null text or role is empty; turns that share a turn number
are ordered by role, then text (repeated rows stay repeated turns); a null
``conv_id`` is a conversation of its own and null turn numbers come first; a
turn longer than the room is never cut: its window is flagged
``over_budget``; an empty table gives no windows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

BUDGET = 1024
HISTORY = 256
START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    for raw, code in (("%", "%25"), ("<", "%3C"), ("[", "%5B")):
        text = F.replace(text, F.lit(raw), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for raw, code in (("[", "%5B"), ("<", "%3C"), ("%", "%25")):
        text = F.replace(text, F.lit(code), F.lit(raw))
    return text


def _tokens(piece: Column) -> Column:
    """Upper bound of the tokens of a formatted turn: its UTF-8 bytes."""
    return F.octet_length(piece).cast("long")


def _cuts(costs: Column) -> Column:
    """First positions of the windows, from an ordered array of (pos, cost,
    system, room, spare) of one conversation."""
    def deal(acc: Column, t: Column) -> Column:
        limit = t["room"] - F.when(F.size(acc["starts"]) > 1, t["spare"]).otherwise(0)
        fits = t["system"] | (acc["used"] == 0) | (acc["used"] + t["cost"] <= limit)
        return F.struct(
            F.when(t["system"], acc["used"]).when(fits, acc["used"] + t["cost"]).otherwise(t["cost"]).alias("used"),
            F.when(fits, acc["starts"]).otherwise(F.concat(acc["starts"], F.array(t["pos"]))).alias("starts"))

    start = F.struct(F.lit(0).cast("long").alias("used"), F.array(F.lit(1)).alias("starts"))
    return F.aggregate(costs, start, deal)["starts"]


def _window_of(starts: Column, pos: Column) -> Column:
    """Number of the last window that starts at or before ``pos``, by bisection."""
    def step(k: Column, by: Column) -> Column:
        return F.when((k + by <= F.size(starts)) & (F.get(starts, k + by - 1) <= pos), k + by).otherwise(k)

    return F.aggregate(F.array(*(F.lit(1 << b) for b in range(29, -1, -1))), F.lit(0), step) - 1


def format_windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY,
                   tokens=_tokens) -> DataFrame:
    """``turns(conv_id, turn, role, text)`` -> one row per window: conv_id,
    window, formatted, carried (repeated turns at its start), own_turns,
    loss (array of start and length, code points of ``formatted``), n_tokens,
    over_budget."""
    role = F.coalesce(F.col("role"), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit(""))
    head = F.concat(F.lit(START), F.replace(escape(role), F.lit("\n"), F.lit("%0A")), F.lit("\n"))
    base = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                        F.concat(head, escape(text), F.lit(END)).alias("piece"),
                        F.char_length(head).alias("head_chars"))
    conv = W.partitionBy("conv_id")
    order = conv.orderBy("turn", "role", "text")
    t = (base.withColumn("pos", F.row_number().over(order))
         .withColumn("cost", tokens(F.col("piece")))
         .withColumn("system", (F.col("pos") == 1) & (F.col("role") == "system")))
    spent = F.when(F.col("system"), F.lit(0)).otherwise(F.col("cost"))
    sys_cost = F.sum(F.when(F.col("system"), F.col("cost")).otherwise(F.lit(0))).over(conv)
    t = (t.withColumn("room", F.greatest(F.lit(budget) - sys_cost, F.lit(2)))
         .withColumn("spare", F.least(F.lit(history).cast("long"), F.floor(F.col("room") / 2)))
         .withColumn("before", F.sum(spent).over(order.rowsBetween(W.unboundedPreceding, 0)) - spent))
    cuts = t.groupBy(F.col("conv_id").alias("cut_id")).agg(
        _cuts(F.sort_array(F.collect_list(F.struct("pos", "cost", "system", "room", "spare")))).alias("starts"))
    t = (t.join(cuts, F.col("conv_id").eqNullSafe(F.col("cut_id")))
         .withColumn("window", _window_of(F.col("starts"), F.col("pos"))).drop("cut_id", "starts", "spare"))
    after = conv.orderBy("window").rangeBetween(1, 1)
    t = (t.withColumn("next_own", F.sum(spent).over(after))
         .withColumn("next_start", F.min("before").over(after))
         .withColumn("windows", F.max("window").over(conv) + 1))
    left = F.least(F.lit(history).cast("long"), F.col("room") - F.col("next_own"))
    repeats = ~F.col("system") & F.col("next_own").isNotNull() & (F.col("next_start") - F.col("before") <= left)
    into = (F.when(F.col("system"), F.sequence(F.lit(0), F.col("windows") - 1))
            .when(repeats, F.array(F.col("window"), F.col("window") + 1))
            .otherwise(F.array(F.col("window"))))
    copies = t.select("*", F.explode(into).alias("into"))
    own = F.col("window") == F.col("into")
    per = (copies.groupBy("conv_id", "into")
           .agg(F.sort_array(F.collect_list(F.struct(
               "pos", "piece", own.alias("own"), "head_chars",
               (own & (F.col("role") == "assistant")).alias("target")))).alias("pieces"),
               F.sum("cost").alias("n_tokens")))
    step = F.aggregate(
        "pieces",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("loss")),
        lambda acc, p: F.struct(
            (acc["at"] + F.char_length(p["piece"])).alias("at"),
            F.when(p["target"], F.concat(acc["loss"], F.array(F.struct(
                (acc["at"] + p["head_chars"]).alias("start"),
                (F.char_length(p["piece"]) - p["head_chars"] - len(END)).alias("length")))))
            .otherwise(acc["loss"]).alias("loss")))["loss"]
    return per.select(
        "conv_id", F.col("into").alias("window"),
        F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"),
        F.size(F.filter("pieces", lambda p: ~p["own"])).alias("carried"),
        F.size(F.filter("pieces", lambda p: p["own"])).alias("own_turns"),
        step.alias("loss"), "n_tokens", (F.col("n_tokens") > budget).alias("over_budget"))


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation, parsed from the formatted windows alone: the turns in
    order without the repeated ones (struct of role and text) and the text
    under the loss mask."""
    # pieces start with START, so the first part of the split is empty
    parts = F.slice(F.split("formatted", r"<\|im_start\|>", -1), F.col("carried") + 2, F.greatest("own_turns", F.lit(1)))

    def turn(part: Column) -> Column:
        cut = F.locate("\n", part)
        return F.struct(
            unescape(F.replace(F.substring(part, F.lit(1), cut - 1), F.lit("%0A"), F.lit("\n"))).alias("role"),
            unescape(F.substring(part, cut + 1, F.char_length(part) - cut - len(END))).alias("text"))

    parsed = windows.select(
        "conv_id", "window", F.char_length("formatted").alias("chars"),
        F.transform(parts, turn).alias("turns"),
        F.array_join(F.transform("loss", lambda s: unescape(F.substring("formatted", s["start"] + 1, s["length"]))),
                     "").alias("loss_text"))
    return (parsed.groupBy("conv_id")
            .agg(F.sort_array(F.collect_list(F.struct("window", "turns", "loss_text"))).alias("w"),
                 F.sum("chars").alias("formatted_chars"), F.count(F.lit(1)).alias("n_windows"))
            .select("conv_id", F.flatten(F.transform("w", lambda x: x["turns"])).alias("turns"),
                    F.array_join(F.transform("w", lambda x: x["loss_text"]), "").alias("loss_text"),
                    "formatted_chars", "n_windows"))


def digest(conversations: DataFrame) -> DataFrame:
    """Columns of the registered query."""
    back = read_back(format_windows(conversations))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text"), 256).alias("loss_sha256"), "formatted_chars", "n_windows")
