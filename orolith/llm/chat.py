"""Chat formatting by event-sourced reconstruction, in DataFrame functions only.

A log holds events of conversations: deltas streamed to a message, edits that
replace its text, and regenerations that void what was streamed before. Folding
the events by sequence gives the final messages, which a template renders to one
text a conversation, with the spans that a trainer's loss counts.

Defined results: a null text is empty; a null role renders as an empty role; null
conversation, message and sequence values are values of their own, nulls first;
events equal in sequence follow by kind and text; repeated events count
each time; an empty log gives no rows; only the columns named are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEAD, SEP, END = "### ", ": ", "</turn>\n"
#: What the template gives a meaning, and the two characters that stand for it inside texts. The first also marks the rest.
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"), (":", "\\c"))
RESETS = ("edit", "regenerate")


def escape(text: Column) -> Column:
    """Control characters become escapes, so no text can hold a marker of the template."""
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    """Undoes escape(); the mark itself comes last."""
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def reconstruct(events: DataFrame) -> DataFrame:
    """Folds (conv_id, message, seq, role, kind, text) to messages (conv_id, message, role, text).

    kind: delta appends its text; edit and regenerate put theirs in place of all before.
    The role is that of the latest event that names one. A long log of one conversation
    is grouped by message first, so only a single message's events meet in a group.
    """
    event = F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text"), "role")
    grouped = events.groupBy("conv_id", "message").agg(F.sort_array(F.collect_list(event)).alias("log"))
    last = F.array_max(F.transform("log", lambda e, i: F.when(e["kind"].isin(*RESETS), i + 1).otherwise(0)))
    live = F.when(last > 1, F.slice("log", last, F.size("log"))).otherwise(F.col("log"))
    roles = F.filter(F.transform("log", lambda e: e["role"]), lambda r: r.isNotNull())
    return grouped.select("conv_id", "message", F.try_element_at(roles, F.lit(-1)).alias("role"), F.array_join(F.transform(live, lambda e: e["text"]), "").alias("text"))


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Renders (conv_id, message, role, text), by message, to (conv_id, n_turns, formatted, spans).

    spans has a struct (start, length) a turn: the code points of formatted that the loss
    counts, length 0 for turns of other roles. Offsets come from a running sum.
    """
    by = Window.partitionBy("conv_id").orderBy("message", "role", "text")
    head = F.concat(F.lit(HEAD), escape(F.coalesce("role", F.lit(""))), F.lit(SEP))
    body = escape(F.coalesce("text", F.lit("")))
    turns = messages.select("conv_id", head.alias("head"), body.alias("body"), F.row_number().over(by).alias("ord"), F.coalesce(F.col("role") == loss_role, F.lit(False)).alias("counts"))
    turns = turns.withColumn("turn", F.concat("head", "body", F.lit(END)))
    before = F.sum(F.length("turn")).over(Window.partitionBy("conv_id").orderBy("ord")) - F.length("turn")
    span = F.struct((before + F.length("head")).cast("long").alias("start"), F.when(F.col("counts"), F.length("body")).otherwise(0).cast("long").alias("length"))
    grouped = turns.select("conv_id", F.struct("ord", "turn", span.alias("span")).alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return grouped.select("conv_id", F.size("ts").cast("long").alias("n_turns"), F.array_join(F.transform("ts", lambda t: t["turn"]), "").alias("formatted"), F.transform("ts", lambda t: t["span"]).alias("spans"))


def read_back(rendered: DataFrame) -> DataFrame:
    """Parses rendered texts again: (conv_id, ord, role, text, loss_text), a row a turn.

    loss_text is what the turn's span of the formatted text holds, unescaped; null where
    the span is of another role. Spans are cut from each turn's own piece, so time is linear.
    """
    pieces = F.split("formatted", END, -1)
    turns = rendered.select("conv_id", F.posexplode(F.arrays_zip(F.slice(pieces, 1, F.size(pieces) - 1).alias("piece"), F.col("spans").alias("span"))).alias("ord", "t")).select("conv_id", "ord", "t.piece", "t.span")
    size = F.length("piece") + len(END)
    start = F.sum(size).over(Window.partitionBy("conv_id").orderBy("ord")) - size
    at = F.locate(SEP, F.col("piece"))
    return turns.withColumn("start", start).select(
        "conv_id", "ord",
        unescape(F.col("piece").substr(F.lit(len(HEAD) + 1), at - 1 - len(HEAD))).alias("role"),
        unescape(F.col("piece").substr(at + len(SEP), F.length("piece"))).alias("text"),
        F.when(F.col("span.length") > 0, unescape(F.col("piece").substr((F.col("span.start") - F.col("start") + 1).cast("int"), F.col("span.length").cast("int")))).alias("loss_text"),
    )


def chat_format(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as a log of one delta a message, reconstructed and rendered.

    Rows of a conversation that share a turn are messages of their own, by role and text.
    """
    by = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    events = conversations.select("conv_id", F.row_number().over(by).alias("message"), F.lit(0).alias("seq"), "role", F.lit("delta").alias("kind"), "text")
    return render(reconstruct(events))
