"""Chat formatting from an event log, with DataFrame functions only.

The log of a conversation is a list of events by sequence number: ``start``
opens a message with its role, ``delta`` adds streamed text, ``edit`` puts new
text in place of all before, ``regenerate`` begins the text anew, ``delete``
takes the message away. Events are partitioned by conversation, sorted, folded
into final messages and rendered. The template:

    <s>[INST]role[/INST]text</s>

Inside roles and texts ``\\``, ``<`` and ``[`` are written as ``\\e``, ``\\l`` and
``\\k``. So no control string can occur in a text, and the text can be had back.
The loss mask is a list of spans (code points) of the formatted conversation:
the texts of the assistant.

Nulls and the like: a null text is empty, a null role is an empty role; events
with equal sequence numbers are taken in the order of kind and text; an unknown
kind is an error; a null conv_id is a conversation of its own; a conversation of
deleted messages only is left out; extra columns are ignored; an empty log gives
no rows. A conversation is one row of the result, so its text must fit one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KINDS = ("start", "delta", "edit", "regenerate", "delete")
ESCAPES = (("\\", "\\e"), ("<", "\\l"), ("[", "\\k"))
OPEN, MIDDLE, CLOSE = "<s>[INST]", "[/INST]", "</s>"


def escaped(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescaped(text: Column) -> Column:
    """Every backslash of an escaped text leads an escape, so one replacement
    after the other, the backslash last, undoes it."""
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def events_of(conversations: DataFrame) -> DataFrame:
    """The log of finished conversations: each row (by turn; equal turns by role
    and text) a started message and one delta."""
    place = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = conversations.select("conv_id", "turn", "role", "text").withColumn(
        "message", F.row_number().over(place).cast("long")
    )
    empty = F.lit(None).cast("string")
    event = lambda k, kind, role, text: F.struct(
        (F.col("message") * 2 + k).alias("seq"),
        F.lit(kind).alias("kind"),
        role.alias("role"),
        text.alias("text"),
    )
    both = F.array(event(0, "start", F.col("role"), empty), event(1, "delta", empty, F.col("text")))
    return numbered.select("conv_id", "message", F.explode(both).alias("e")).select(
        "conv_id", "message", "e.*"
    )


def fold(events: DataFrame) -> DataFrame:
    """conv_id, message, seq, event kind, role, text -> the final messages:
    conv_id, message, role, text. Messages keep the order of their numbers."""
    known = F.when(F.col("kind").isin(*KINDS), F.col("kind")).otherwise(
        F.raise_error(F.concat(F.lit("unknown kind of event: "), F.coalesce("kind", F.lit("null"))))
    )
    log = F.sort_array(
        F.collect_list(F.struct("seq", known.alias("kind"), F.coalesce("text", F.lit("")).alias("text"), "role"))
    )
    # Where the text that counts begins: at the last event that puts it anew.
    begins = F.array_max(
        F.transform("log", lambda e, k: F.when(e["kind"] != "delta", k).otherwise(F.lit(0)))
    )
    rest = F.slice("log", F.col("begins") + 1, F.size("log"))
    return (
        events.groupBy("conv_id", "message")
        .agg(log.alias("log"))
        .withColumn("begins", begins)
        .where(F.col("log")[F.col("begins")]["kind"] != "delete")
        .select(
            "conv_id",
            "message",
            F.coalesce(
                F.get(F.filter(F.col("log.role"), lambda r: r.isNotNull()), F.lit(0)), F.lit("")
            ).alias("role"),
            F.array_join(F.transform(rest, lambda e: e["text"]), "").alias("text"),
        )
    )


def render(messages: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_mask (spans from, to; code points, end exclusive)."""
    run = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    head = F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(MIDDLE))
    turns = (
        messages.withColumn("head", head)
        .withColumn("body", escaped(F.col("text")))
        .withColumn("piece", F.concat("head", "body", F.lit(CLOSE)))
        .withColumn("start", F.coalesce(F.sum(F.length("piece")).over(run), F.lit(0)) + F.length("head"))
        .withColumn(
            "span",
            F.when(
                F.col("role") == "assistant",
                F.struct(F.col("start").alias("from"), (F.col("start") + F.length("body")).alias("to")),
            ),
        )
    )
    return (
        turns.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("message", "piece", "span"))).alias("turns"))
        .select(
            "conv_id",
            F.array_join("turns.piece", "").alias("formatted"),
            F.filter(F.col("turns.span"), lambda s: s.isNotNull()).alias("loss_mask"),
        )
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (role and text) and loss_texts, both unescaped,
    had from the formatted text and its mask alone."""
    cut = F.split("formatted", r"<s>\[INST\]")
    pieces = F.slice(cut, F.lit(2), F.size(cut))
    role = lambda p: F.substring_index(p, MIDDLE, 1)
    text = lambda p: F.substring_index(F.substring_index(p, MIDDLE, -1), CLOSE, 1)
    masked = lambda s: F.substr(F.col("formatted"), (s["from"] + 1).cast("int"), (s["to"] - s["from"]).cast("int"))
    return formatted.select(
        "conv_id",
        "formatted",
        F.transform(
            pieces,
            lambda p: F.struct(unescaped(role(p)).alias("role"), unescaped(text(p)).alias("text")),
        ).alias("turns"),
        F.transform("loss_mask", lambda s: unescaped(masked(s))).alias("loss_texts"),
    )


def digests(read: DataFrame) -> DataFrame:
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    loss = F.array_join("loss_texts", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
