"""Operator 10, chat formatting: budgeted windows of whole turns, in DataFrame functions only.

Template: ``<|turn|>role``, a line break, the text, ``<|end|>`` per turn. Inside roles and texts a backslash becomes ``\\s``
and ``<|`` becomes ``<\\b``, so no marker can occur there, and the escape is undone without loss.

Prefix sums of the turns' tokens (pieces of words, counted with the markers) cut a conversation into spans of whole turns:
a turn of more than half of what the budget leaves beside the system turn and the history is a span of its own, and its
window may exceed the budget, which ``n_tokens`` shows. The others, but a leading system turn, are cut by floor(tokens of such
turns before / room), where room is what is left beside the longest of them, and at each long turn. A window holds the system turn, the history (the latest earlier turns of at most
``history`` tokens), and its span. The loss mask covers the assistant texts of the span; repeated turns are masked.

A conversation's turns meet in one task (its prefix sums and digests need them in order), where each looks ahead by at most
``history`` tokens; the system turn is joined to the spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET, HISTORY = 2048, 256
START, END = "<|turn|>", "<|end|>"
MARK_TOKENS = 4


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\s")), F.lit("<|"), F.lit("<\\b"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\b"), F.lit("<|")), F.lit("\\s"), F.lit("\\"))


def n_tokens(text: Column) -> Column:
    """A token for every started 4 characters of a word, and the markers' share."""
    return (F.length(text) / 4).cast("long") + F.size(F.split(text, r"[\x20\x09-\x0D]+")) + MARK_TOKENS


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, i, role, text, tokens, system): the turns in order of (turn, role, text); NULL roles and texts are empty."""
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return (rows.withColumn("i", F.row_number().over(order))
            .select("conv_id", "i", "role", "text", n_tokens(F.col("text")).alias("tokens"), ((F.col("i") == 1) & (F.col("role") == "system")).alias("system")))


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """(conv_id, window, n_repeated, n_tokens, formatted, loss): one row per window, of conversations (conv_id, turn, role, text).

    n_repeated counts the window's leading turns that an earlier window has too; loss holds the (start, length) of
    the trained texts in ``formatted``, in code points. Equal rows are turns of their own, in any order among
    themselves. A NULL conv_id is one conversation; a NULL turn comes first. No rows: no rows. Further columns are left out.
    """
    conv = Window.partitionBy("conv_id")
    rows = turns(conversations)
    new = F.when(F.col("system"), 0).otherwise(F.col("tokens"))
    earlier = conv.orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    sum_before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    left = F.greatest(budget - history - F.max(F.when(F.col("system"), F.col("tokens")).otherwise(0)).over(conv), F.lit(1))
    rows = rows.withColumn("left", left).withColumn("long", ~F.col("system") & (2 * F.col("tokens") > F.col("left")))
    usual = F.when(F.col("long"), 0).otherwise(new)
    # long turns before a turn move its span by two each, so a long turn's span lies between its neighbours'
    cut = (rows.withColumn("before", sum_before(new)).withColumn("room", F.greatest(F.col("left") - F.max(usual).over(conv), F.lit(1)))
           .withColumn("span", F.floor(sum_before(usual) / F.col("room")) + 2 * sum_before(F.col("long").cast("long")) + F.col("long").cast("long"))
           .withColumn("opens", F.min(F.when(~F.col("system"), F.col("before"))).over(Window.partitionBy("conv_id", "span"))))
    text = F.concat(F.lit(START), escape(F.col("role")), F.lit("\n"), escape(F.col("text")), F.lit(END))
    block = F.struct("i", text.alias("text"), F.length(escape(F.col("role"))).alias("head"), (F.col("role") == "assistant").alias("train"), "tokens", "system")
    # a turn goes to its span and, as history, to those that open at most `history` tokens after its start: turns have tokens, so these are few
    opening = ~F.col("system") & (F.col("before") == F.col("opens"))
    near = F.collect_list(F.when(opening, F.struct("before", "span"))).over(conv.orderBy("before").rangeBetween(Window.currentRow, history))
    later = F.transform(F.filter("near", lambda w: (w["before"] > F.col("before")) & (w["span"] != F.col("span"))), lambda w: w["span"])
    dealt = cut.select("conv_id", block.alias("turn"), "span", "system", opening.alias("opening"), near.alias("near"), "before")
    flat = F.struct("turn.i", "turn.text", "turn.head", "turn.train", "turn.tokens", "turn.system", "span").alias("turn")
    own = dealt.filter(~F.col("system")).select("conv_id", F.explode(F.concat(F.array("span"), later)).alias("window"), flat)
    # the system turn goes to every span
    spans = dealt.filter("opening").select(F.col("conv_id").alias("id__"), F.col("span").alias("window__"))
    systems = dealt.filter("system").select("conv_id", flat).join(spans, F.col("conv_id").eqNullSafe(F.col("id__")), "left")
    placed = own.unionByName(systems.select("conv_id", F.coalesce("window__", F.lit(0).cast("long")).alias("window"), "turn"))
    got = placed.groupBy("conv_id", "window").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    first = F.col("window") == F.min("window").over(conv)
    again = lambda t: F.when(t["system"], ~F.col("first")).otherwise(t["span"] != F.col("window"))
    got = got.withColumn("first", first).withColumn("formatted", F.array_join(F.transform("turns", lambda t: t["text"]), ""))
    starts = F.aggregate("turns", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("loss")), lambda a, t: F.struct(
        (a["at"] + F.length(t["text"])).alias("at"),
        F.when(t["train"] & ~again(t), F.concat(a["loss"], F.array(F.struct(
            (a["at"] + len(START) + t["head"] + 1).alias("start"), (F.length(t["text"]) - len(START) - t["head"] - 1 - len(END)).alias("length"))))).otherwise(a["loss"]).alias("loss")))["loss"]
    return got.select("conv_id", "window", F.size(F.filter("turns", again)).alias("n_repeated"),
                      F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + t["tokens"]).alias("n_tokens"), "formatted", starts.alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), from the windows alone."""
    blocks = F.filter(F.split("formatted", r"<\|end\|>", -1), lambda b: b != "")
    own = F.transform(F.slice(blocks, F.col("n_repeated") + 1, F.greatest(F.size(blocks) - F.col("n_repeated"), F.lit(0))), lambda b: F.substr(b, F.lit(len(START) + 1)))
    trained = F.transform("loss", lambda s: unescape(F.substr(F.col("formatted"), s["start"] + 1, s["length"])))
    rows = formatted.select("conv_id", F.struct("window", F.transform(own, unescape).alias("turns"), trained.alias("loss"), F.length("formatted").alias("chars")).alias("w"))
    got = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("w"), F.sum("w.chars").cast("long").alias("formatted_chars"))
    said, loss = F.flatten("w.turns"), F.array_join(F.flatten("w.loss"), "")
    return got.select("conv_id", F.size(said).cast("long").alias("n_turns"), F.sha2(F.concat(F.array_join(said, "\n"), F.lit("\n")), 256).alias("turns_sha256"),
                      F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
