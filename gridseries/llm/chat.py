r"""Conversations from event logs, rendered with a reversible template and a loss mask; built-in functions only.

A log holds events (conv_id, message columns, seq, kind, role, text). `message` opens a message with a role
and a first text, `delta` appends a streamed piece, `edit` puts another text in place of all so far,
`regenerate` starts the message over. Regenerating a message also discards the messages opened between its
opening and that event, as they answered a text that is gone.

The log is dealt by conversation and message, so a long stream is folded beside others of its conversation:
the last event that resets a message is its largest seq among openings, edits and regenerations, and what
counts of the message is the pieces from there on, in order. Messages without their logs then meet in a
window per conversation, which finds discarded ones, numbers the rest and sums up their places.

A turn becomes `<turn>`, `### role:`, the text and `</turn>`, each on lines of their own. Within roles and texts
a backslash precedes every backslash and every `<turn>`, `</turn>` and `### `, within roles every line break too. So
a line break before `</turn>`, and the first colon before a line break, are always the template's.

A conversation is one training example: its rendered text has to fit one row, 2 GB.

Defined cases: null texts and roles are empty; events of other kinds are left out; an event delivered twice,
equal in all columns, counts once; events without seq come before all others; of equal seqs the smaller
(kind, text) comes first; a message without opening is opened by its first event; of messages opened
at the same seq that of the smaller message columns counts as the earlier; a null conv_id or message column is a
value like any other; further columns are ignored; an empty log gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values: kinds of events, the template
KINDS = ["message", "delta", "edit", "regenerate"]
HEAD, MIDDLE, TAIL = "<turn>\n### ", ":\n", "\n</turn>\n"
CONTROL = ["\\", "<turn>", "</turn>", "### "]
LEARNED = "assistant"
DELTA_CHARS = 4096


def escape(text: Column, *more: str) -> Column:
    for control in [*CONTROL, *more]:
        text = F.replace(text, F.lit(control), F.lit("\\" + control))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def events_of_turns(turns: DataFrame, delta_chars: int = DELTA_CHARS) -> DataFrame:
    """The log of finished turns (conv_id, turn, role, text): an opening and deltas of at most `delta_chars`.

    Message columns are turn and copy; rows that share conv_id and turn are copies, by role and text. If turns has
    a column `log`, an array of (part, kind, role, text), a log that is not null is taken as it is.
    """
    parts = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"(?s).{{1,{delta_chars}}}"), F.lit(0))
    nothing = F.lit(None).cast("string")

    def event(part, kind, role, text):
        return F.struct(part.cast("int").alias("part"), F.lit(kind).alias("kind"), role.alias("role"), text.alias("text"))

    log = F.concat(F.array(event(F.lit(0), "message", F.col("role"), nothing)),
                   F.transform(parts, lambda piece, i: event(i + 1, "delta", nothing, piece)))
    if "log" in turns.columns:
        log = F.coalesce("log", log)
    order = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    rows = turns.withColumn("copy", F.row_number().over(order)).select("conv_id", "turn", "copy", F.explode(log).alias("event"))
    return rows.select("conv_id", "turn", "copy", F.struct("turn", "copy", "event.part").alias("seq"), "event.kind", "event.role", "event.text")


def fold(events: DataFrame, message: Sequence[str] = ("message_id",)) -> DataFrame:
    """The messages that stand at the end of each log: conv_id, message columns, opened, role, text."""
    kind, key = F.col("kind"), ["conv_id", *message]
    seen = events.where(kind.isin(KINDS)).groupBy(*key).agg(
        F.min(F.when(kind == "message", F.struct("seq", "role"))).alias("opening"),
        F.min(F.struct("seq", "role")).alias("first"),
        F.max(F.when(kind != "delta", F.col("seq"))).alias("reset"),
        F.max(F.when(kind == "regenerate", F.col("seq"))).alias("again"),
        F.collect_set(F.struct("seq", "kind", "text")).alias("log"))
    start = F.coalesce("opening", "first")
    counts = F.filter(F.sort_array("log"), lambda e: F.col("reset").isNull() | (e["seq"] >= F.col("reset")))
    text = F.array_join(F.transform(counts, lambda e: F.coalesce(e["text"], F.lit(""))), "")
    said = seen.select(*key, start["seq"].alias("opened"), F.coalesce(start["role"], F.lit("")).alias("role"), text.alias("text"), "again")
    before = Window.partitionBy("conv_id").orderBy("opened", *message).rowsBetween(Window.unboundedPreceding, -1)
    gone = F.coalesce(F.max("again").over(before) > F.col("opened"), F.lit(False))
    return said.withColumn("gone", gone).where(~F.col("gone")).drop("gone", "again")


def render(messages: DataFrame, message: Sequence[str] = ("message_id",)) -> DataFrame:
    """One row for each turn: conv_id, turn_no (from 1), segment, start (of the segment in its conversation), and
    the loss span within the segment, from `within` on `length` characters, null if nothing is to be learned."""
    role, text = escape(F.col("role"), "\n"), escape(F.col("text"))
    order = Window.partitionBy("conv_id").orderBy("opened", *message)
    learned = F.col("role") == LEARNED
    parts = messages.select("conv_id", "opened", *message, "role", role.alias("shown"), text.alias("body"))
    within = F.when(learned, F.lit(len(HEAD) + len(MIDDLE)) + F.length("shown"))
    parts = parts.select("conv_id", "opened", *message, F.concat(F.lit(HEAD), "shown", F.lit(MIDDLE), "body", F.lit(TAIL)).alias("segment"),
                         within.alias("within"), F.when(learned, F.length("body")).alias("length"))
    start = F.sum(F.length("segment").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return parts.select("conv_id", F.row_number().over(order).alias("turn_no"), "segment", F.coalesce(start, F.lit(0).cast("long")).alias("start"), "within", "length")


def assemble(segments: DataFrame) -> DataFrame:
    """conv_id, formatted, loss: the spans (turn_no, start, within, length) whose characters count in the loss.

    start counts from the beginning of formatted, within from that of the turn.
    """
    turns = segments.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn_no", "segment", "start", "within", "length"))).alias("turns"))
    formatted = F.array_join(F.transform("turns", lambda t: t["segment"]), "")
    learned = F.filter("turns", lambda t: t["within"].isNotNull())
    span = F.transform(learned, lambda t: F.struct(t["turn_no"].alias("turn_no"), (t["start"] + t["within"]).alias("start"), t["within"].alias("within"), t["length"].alias("length")))
    return turns.select("conv_id", formatted.alias("formatted"), span.alias("loss"))


def format_conversations(events: DataFrame, message: Sequence[str] = ("message_id",)) -> DataFrame:
    """conv_id, formatted, loss for each conversation of the log."""
    return assemble(render(fold(events, message), message))


def read_back(formatted: DataFrame) -> DataFrame:
    """The same rows with turns (role, text) parsed from formatted, and the texts under the loss mask."""
    ended = F.split("formatted", TAIL, -1)
    pieces = formatted.withColumn("pieces", F.slice(ended, F.lit(1), F.size(ended) - 1))

    def turn(piece):
        body = F.substr(piece, F.lit(len(HEAD) + 1))
        at = F.instr(body, MIDDLE)
        return F.struct(unescape(F.substr(body, F.lit(1), at - 1)).alias("role"), unescape(F.substr(body, at + len(MIDDLE))).alias("text"))

    def under(span):
        return unescape(F.substr(F.element_at("pieces", span["turn_no"]), span["within"] + 1, span["length"]))

    return pieces.select(*formatted.columns, F.transform("pieces", turn).alias("turns"), F.transform("loss", under).alias("loss_texts"))
