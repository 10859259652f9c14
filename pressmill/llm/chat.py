"""Chat formatting by event-sourced reconstruction, in Spark expressions only.

A log of events (conv_id, seq, kind, turn, role, text) is partitioned by conversation and sorted by sequence.
``message`` starts a message, ``delta`` appends to the newest message of its turn, ``edit`` replaces that
message's text so far, ``regenerate`` withdraws every message of its turn and later ones and starts anew.
The final messages, by turn and then by order of appearance, are rendered.

Template, for each message: <|turn|>role<|text|>text<|end|>. Inside roles and texts & and < are written
&amp; and &lt;, so no text can hold a control string, and reading back inverts this exactly.

A conversation is one key: its events are sorted and its messages gathered in one task, so the longest conversation has
to fit there.

Edge cases: a null text or role is empty; a null turn sorts first, so it stays when a later turn is regenerated, and a
regenerate without a turn withdraws everything before it; texts of any length are kept whole; rows with the same turn are separate
messages, by sequence, role and text; a delta or edit before any message of its turn opens one; an empty log
gives no rows; a null conv_id is a conversation of its own; columns beyond these are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
KINDS = ("message", "regenerate", "edit", "delta")
LOSS_ROLE = "assistant"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def reconstruct(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, turn, pos (order within the conversation's log), role, text."""
    kind = F.when(F.col("kind").isin(*KINDS), F.col("kind")).otherwise("message")
    df = events.select("conv_id", "seq", kind.alias("kind"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rank = F.expr("case kind when 'message' then 0 when 'regenerate' then 1 when 'edit' then 2 else 3 end")
    log = Window.partitionBy("conv_id").orderBy(F.col("seq").asc_nulls_first(), rank, "turn", "role", "text")
    df = df.withColumn("pos", F.row_number().over(log))
    later = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(1, Window.unboundedFollowing)
    df = df.withColumn("cut", F.min(F.when(F.col("kind") == "regenerate", F.col("turn"))).over(later))
    df = df.withColumn("cut_all", F.max((F.col("kind") == "regenerate") & F.col("turn").isNull()).over(later))
    of_turn = Window.partitionBy("conv_id", "turn").orderBy("pos")
    starts = F.col("kind").isin("message", "regenerate").cast("int")
    df = df.withColumn("msg", F.sum(starts).over(of_turn)).withColumn("edits", F.sum((F.col("kind") == "edit").cast("int")).over(of_turn))
    of_msg = Window.partitionBy("conv_id", "turn", "msg")
    df = df.withColumn("last_edit", F.max("edits").over(of_msg)).withColumn("first_pos", F.min("pos").over(of_msg)).withColumn("first_cut", F.min_by("cut", "pos").over(of_msg)).withColumn("first_all", F.min_by("cut_all", "pos").over(of_msg))
    stays = F.col("turn").isNull() | F.col("first_cut").isNull() | (F.col("first_cut") > F.col("turn"))
    alive = (F.col("edits") == F.col("last_edit")) & stays & ~F.coalesce("first_all", F.lit(False))
    pieces = F.array_sort(F.collect_list(F.struct("pos", "text", "role")))
    whole = df.filter(alive).groupBy("conv_id", "turn", "msg", "first_pos").agg(pieces.alias("p"))
    return whole.select("conv_id", "turn", F.col("first_pos").alias("pos"), F.col("p")[0]["role"].alias("role"), F.array_join(F.transform("p", lambda x: x["text"]), "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted."""
    piece = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT), escape(F.col("text")), F.lit(END))
    key = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "pos", piece.alias("piece"))
    return messages.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(key)), lambda x: x["piece"]), "").alias("formatted"))


def parse(formatted: DataFrame) -> DataFrame:
    """Read formatted conversations back: adds turns, an array of struct(role, text)."""
    bodies = F.filter(F.split("formatted", r"<\|end\|>", -1), lambda x: x != "")
    role = lambda x: F.substring_index(F.substring_index(x, TEXT, 1), TURN, -1)
    text = lambda x: F.substring_index(x, TEXT, -1)
    return formatted.withColumn("turns", F.transform(bodies, lambda x: F.struct(unescape(role(x)).alias("role"), unescape(text(x)).alias("text"))))


def format_events(events: DataFrame) -> DataFrame:
    """conv_id, formatted, turns and loss_text (all text under the loss mask: each assistant text, in order)."""
    read = parse(render(reconstruct(events)))
    own = F.filter("turns", lambda x: x["role"] == LOSS_ROLE)
    return read.withColumn("loss_text", F.array_join(F.transform(own, lambda x: x["text"]), ""))


def digest(conversations: DataFrame) -> DataFrame:
    """conversations: conv_id, turn, role, text; each row is one message event whose sequence is its turn."""
    out = format_events(conversations.select("conv_id", F.col("turn").alias("seq"), F.lit("message").alias("kind"), "turn", "role", "text"))
    told = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
