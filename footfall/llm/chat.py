"""Chat formatting from event logs.

A conversation is a log of events.  ``message`` opens a message with a text,
``delta`` adds a streamed piece, ``edit`` replaces what there is, and
``regenerate`` drops it so that later pieces start anew; ``delete`` takes the
message away.  Events are folded to final messages by sequence, and messages
are rendered with a template whose control strings are escaped in texts and
roles.  All of it is built-in expressions and aggregates.

Folding deals events out by (conversation, message) and rendering gathers
finished turns by conversation, the unit that is one value in the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The template's marks, and further control strings of chat models.
TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
_REST = r"(?=\||/?s>|/?INST\])"  # what follows < or [ in a control string
_ESCAPE = r"([<\[])(\\*)" + _REST
_UNESCAPE = r"([<\[])\\(\\*)" + _REST
KINDS = ("message", "delta", "edit", "regenerate", "delete")
SEGMENTS = "array<struct<text:string,loss:boolean>>"


def escape(text: Column) -> Column:
    r"""Put one more backslash after the bracket that opens a control string.

    ``<|``, ``<s>``, ``</s>``, ``[INST]`` and ``[/INST]`` are covered, also
    with backslashes already there, so that ``unescape`` is the exact inverse.
    """
    return F.regexp_replace(text, _ESCAPE, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, "$1$2")


def as_events(conversations: DataFrame) -> DataFrame:
    """A table with a row per turn as an event log: each row opens a message.

    Equal rows are told apart by a running number, so every row is a turn.
    """
    same = ["conv_id", "turn", "role", "text"]
    counted = conversations.groupBy(*same).agg(F.count(F.lit(1)).alias("copies"))
    each = counted.select("*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return each.select(
        "conv_id",
        F.col("turn").alias("seq"),
        F.lit("message").alias("kind"),
        F.to_json(F.struct("turn", "role", "text", "copy")).alias("message_id"),
        "role",
        F.coalesce("text", F.lit("")).alias("text"),
    )


def fold(events: DataFrame) -> DataFrame:
    """Final messages: ``conv_id``, ``seq`` (of the first event), ``role``, ``text``.

    Needs ``conv_id``, ``seq``, ``kind``, ``message_id``, ``role``, ``text``;
    other columns are ignored.  Ties in ``seq`` go by kind in the order of
    ``KINDS`` and then by text.  A NULL text adds nothing, a message without
    any role gets an empty one, unknown kinds are ignored, and a message whose
    last word is ``delete`` is gone.
    """
    log = events.where(F.col("kind").isin(*KINDS)).select(
        "conv_id",
        "message_id",
        "seq",
        F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).alias("step"),
        "role",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    step = F.struct("seq", "step", "text")
    message = Window.partitionBy("conv_id", "message_id")
    afresh = F.when(F.col("step") != KINDS.index("delta") + 1, step)
    placed = log.select(
        "*",
        F.max(afresh).over(message).alias("start"),
        F.min("seq").over(message).alias("first"),
        F.first("role", ignorenulls=True)
        .over(message.orderBy("seq", "step", "text").rowsBetween(*_ALL))
        .alias("speaker"),
    )
    pieces = placed.where(F.col("start").isNull() | (step >= F.col("start")))
    folded = pieces.groupBy("conv_id", "message_id").agg(
        F.first("first").alias("seq"),
        F.first("speaker").alias("role"),
        F.max("step").alias("last"),
        F.array_sort(F.collect_list(F.struct("seq", "step", "text"))).alias("pieces"),
    )
    deleted, again = KINDS.index("delete") + 1, KINDS.index("regenerate") + 1
    kept = F.filter("pieces", lambda p: p["step"] != again)
    return folded.where(F.get("pieces", F.lit(0))["step"] != deleted).select(
        "conv_id",
        "seq",
        F.coalesce("role", F.lit("")).alias("role"),
        F.array_join(F.transform(kept, lambda p: p["text"]), "").alias("text"),
        "message_id",
    )


_ALL = (Window.unboundedPreceding, Window.unboundedFollowing)


def render(messages: DataFrame, learn: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id``, ``n_turns``, ``segments``.

    ``segments`` is the formatted text in order, cut where the loss mask
    changes: each has ``text`` and ``loss``, true for what ``learn`` said.
    Turns go by seq, then role, text and message id.
    """
    turn = F.struct("seq", "role", "text", "message_id")
    gathered = messages.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"), F.array_sort(F.collect_list(turn)).alias("turns")
    )

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def written(x: Column) -> Column:
        head = F.concat(F.lit(TURN), escape(x["role"]), F.lit(SAYS))
        return F.array(
            segment(head, F.lit(False)),
            segment(escape(x["text"]), x["role"] == learn),
            segment(F.lit(f"{END}\n"), F.lit(False)),
        )

    segments = F.flatten(F.transform("turns", written)).cast(SEGMENTS)
    return gathered.select("conv_id", "n_turns", segments.alias("segments"))


def formatted(segments: Column) -> Column:
    """The text of a conversation."""
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def learned(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    masked = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(masked, lambda s: unescape(s["text"])), "")


def parse(text: Column) -> Column:
    """Turns (role, text) read back from a formatted conversation."""
    turns = F.filter(F.split(text, f"\\Q{TURN}\\E", -1), lambda t: F.length(t) > 0)

    def read(t: Column) -> Column:
        parts = F.split(t, f"\\Q{SAYS}\\E", 2)
        said = F.get(F.split(F.get(parts, F.lit(1)), f"\\Q{END}\\E", 2), F.lit(0))
        return F.struct(
            unescape(F.get(parts, F.lit(0))).alias("role"), unescape(said).alias("text")
        )

    return F.transform(turns, read)


def digests(rendered: DataFrame) -> DataFrame:
    """Counts and digests of each conversation, read back from its rendered form."""
    turns = F.transform(
        parse(F.col("whole")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    staged = rendered.select(
        "conv_id", formatted(F.col("segments")).alias("whole"), learned(F.col("segments")).alias("l")
    ).select("*", turns.alias("turns"))
    return staged.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
        F.length("l").cast("long").alias("loss_chars"),
        F.sha2("l", 256).alias("loss_sha256"),
        F.length("whole").cast("long").alias("formatted_chars"),
    )
