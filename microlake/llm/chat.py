"""Chat formatting by event-sourced reconstruction, in DataFrame functions alone.

A log row is an event of a message of a conversation:

    message     opens the message with its role and text
    delta       appends streamed text
    edit        replaces the text so far; later deltas append to the new one
    regenerate  discards the text so far, and every later message of the conversation whose
                events all came before it; later deltas build the new text

The log is partitioned by conversation and message and folded in sequence order to the
final messages. These are rendered turn by turn into one text:

    <s>role[INST]text[/INST]</s>

The control strings ``<s>``, ``</s>``, ``[INST]``, ``[/INST]`` inside roles and texts are
escaped by a backslash after their bracket; a control string that already has backslashes
there gets one more, so unescaping, which takes one away, gives back every text exactly. The
loss mask is one span per turn, in code points of that turn: the escaped text of turns whose
role is in ``loss_roles``, empty for others.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, TEXT, TEXT_END, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
_PLAIN = r"([<\[])(\\*)(/?s>|/?INST\])"
_ESCAPED = r"([<\[])\\(\\*)(/?s>|/?INST\])"
EVENTS = ("message", "delta", "edit", "regenerate")


def escape(text: Column) -> Column:
    """One backslash more in every control string, with any number of backslashes before."""
    return F.regexp_replace(text, _PLAIN, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    """Inverse of ``escape``."""
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def fold(log: DataFrame) -> DataFrame:
    """Final messages (conv_id, turn, message_id, role, text) of a log.

    ``log``: conv_id, seq, turn, message_id, event, role, text. Events of a message run by
    seq, ties by event (message, delta, edit, regenerate) and text. Null texts are empty,
    null roles the empty role; a message without a ``message`` event has the empty role;
    unknown events change nothing. Null conv_ids form a conversation of their own.
    """
    order = F.coalesce(F.array_position(F.array(*map(F.lit, EVENTS)), F.col("event")), F.lit(0))
    event = F.struct(F.col("seq").cast("long").alias("seq"), order.cast("int").alias("kind"),
                     F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    opened = F.col("event") == "message"
    messages = log.groupBy("conv_id", "turn", "message_id").agg(
        F.sort_array(F.collect_list(event)).alias("events"),
        F.max(F.when(opened, F.struct("seq", "role"))).alias("opening"),
        F.max(F.when(F.col("event") != "regenerate", F.col("seq").cast("long"))).alias("last_seq"),
        F.max(F.when(F.col("event") == "regenerate", F.col("seq").cast("long"))).alias("again_seq"))
    events = F.col("events")
    last_reset = F.array_max(F.transform(events, lambda e, i: F.when(e["kind"].isin(1, 3, 4), i).otherwise(F.lit(-1))))
    kept = F.filter(F.slice(events, F.greatest(last_reset + 1, F.lit(1)), F.size(events)), lambda e: e["kind"].isin(1, 2, 3))
    folded = messages.select(
        "conv_id", "turn", "message_id", F.coalesce(F.col("opening.role").cast("string"), F.lit("")).alias("role"),
        F.array_join(F.transform(kept, lambda e: e["text"]), "").alias("text"), "last_seq", "again_seq")
    # regenerations of earlier turns: few rows, gathered to one short list per conversation
    again = folded.where(F.col("again_seq").isNotNull()).groupBy(F.col("conv_id").alias("again_conv")) \
        .agg(F.collect_list(F.struct("turn", "again_seq")).alias("again"))
    joined = folded.join(again, F.col("conv_id").eqNullSafe(F.col("again_conv")), "left")
    dropped = F.exists(F.coalesce("again", F.array().cast("array<struct<turn:bigint,again_seq:bigint>>")),
                       lambda a: (a["turn"] < F.col("turn")) & (a["again_seq"] > F.coalesce("last_seq", F.lit(-1))))
    return joined.where(~F.coalesce(dropped, F.lit(False))).select("conv_id", "turn", "message_id", "role", "text")


def render(messages: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv_id, formatted, loss_spans): one row per conversation.

    Turns run by turn, null turns first, ties by role and text; equal turns are all kept.
    Each message is escaped and rendered on its own; only finished turns are gathered, and a
    conversation is one row because its formatted text is one value.
    """
    role = escape(F.coalesce(F.col("role"), F.lit("")))
    text = escape(F.coalesce(F.col("text"), F.lit("")))
    before = F.length(role) + len(OPEN) + len(TEXT)
    masked = F.col("role").isin(*loss_roles) & F.col("role").isNotNull()
    turns = messages.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), "role", "text",
        F.concat(F.lit(OPEN), role, F.lit(TEXT), text, F.lit(TEXT_END + CLOSE)).alias("rendered"),
        F.struct(before.alias("start"), (before + F.when(masked, F.length(text)).otherwise(0)).alias("end")).alias("span"))
    # sorted by (turn, role, text) through the rendered form, which begins with the role and goes on with the text
    packed = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "rendered", "span"))).alias("turns"))
    return packed.select("conv_id", F.array_join(F.transform("turns", lambda t: t["rendered"]), "").alias("formatted"),
                         F.transform("turns", lambda t: t["span"]).alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_texts, formatted): roles and texts, and the texts under the mask, from the output alone.

    ``turns``: array of (role, text); ``loss_texts``: array of unescaped texts, empty ones included.
    """
    pieces = F.slice(F.split("formatted", CLOSE), F.lit(1), F.size("loss_spans"))

    def turn(p: Column) -> Column:
        at = F.instr(p, TEXT)
        role = p.substr(F.lit(len(OPEN) + 1), at - len(OPEN) - 1)
        text = p.substr(at + len(TEXT), F.length(p) - at - len(TEXT) + 1 - len(TEXT_END))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    def lost(p: Column, s: Column) -> Column:
        return unescape(p.substr(s["start"] + 1, s["end"] - s["start"]))

    return formatted.select("conv_id", "formatted", F.transform(pieces, turn).alias("turns"),
                            F.zip_with(pieces, F.col("loss_spans"), lost).alias("loss_texts"))


def message_log(conversations: DataFrame) -> DataFrame:
    """A conversation table (conv_id, turn, role, text) as a log: each row opens a message, its text streams in.

    Rows are told apart by their place in the scan, so repeated rows stay separate turns.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")) \
        .withColumn("message_id", F.monotonically_increasing_id())
    half = F.floor(F.length("text") / 2).cast("int")
    steps = F.array(
        F.struct(F.lit(0).cast("long").alias("seq"), F.lit("message").alias("event"), F.lit("").alias("part")),
        F.struct(F.lit(1).cast("long").alias("seq"), F.lit("delta").alias("event"), F.substring("text", F.lit(1), half).alias("part")),
        F.struct(F.lit(2).cast("long").alias("seq"), F.lit("delta").alias("event"),
                 F.substring("text", half + 1, F.length("text")).alias("part")))
    return rows.select("conv_id", "turn", "message_id", "role", F.explode(steps).alias("step")) \
        .select("conv_id", "turn", "message_id", "role", "step.seq", "step.event", F.col("step.part").alias("text"))
