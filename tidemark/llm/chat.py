"""Chat formatting from an event log.

Events belong to a conversation and a message and are numbered. The deltas of a
message are concatenated; an edit replaces what the message holds; a regeneration
empties it, so that later deltas build it anew. The events of a message are folded
first, spread by (conversation, message), and the final messages of a conversation
are then rendered in order: the deltas of a hot conversation are folded by many
tasks, and only final texts meet in its row.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per message. Inside roles and
texts a backslash becomes two and ``<|`` becomes ``<\\|``, so no control string can
come from a text, and every text can be read back. A line end inside a role becomes
``%0A`` and a percent sign ``%25``.

Loss mask: the code point ranges of assistant texts in the formatted conversation.

Built from column expressions alone. A formatted conversation is one value, so its
size is bound by that of a string.

Defined results: null role or text counts as empty; a null conversation is one of its
own; messages go by their number, a message without text stays; events that agree in
all fields are all applied; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import let, named, running_sums, text_of

# Fixed values of the template.
START, END = "<|im_start|>", "<|im_end|>"
DELTA, EDIT, REGENERATE = "delta", "edit", "regenerate"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def _role_out(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _role_in(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def events_of(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", delta_chars: int = 512, revised: bool = False,
) -> DataFrame:
    """Messages as the log in which they would have been streamed: deltas of ``delta_chars`` code points.

    With ``revised`` one message in three was drafted (its text backwards) and regenerated, and one was
    drafted and edited. Rows go by turn, then role and text; rows that agree in all of them stay apart.
    """
    known = rows.select(named(conv_col).alias("conv"), named(turn_col).alias("turn"), text_of(role_col).alias("role"), text_of(text_col).alias("body"))
    numbered = known.withColumn("message", F.row_number().over(Window.partitionBy("conv").orderBy("turn", "role", "body")).cast("long"))

    def event(seq: Column, kind: str, text: Column) -> Column:
        return F.struct(seq.cast("long").alias("seq"), F.lit(kind).alias("kind"), text.alias("text"))

    # One pass over a text of any length; an empty one is one empty delta.
    cut = F.regexp_extract_all("body", F.lit(f"(?s).{{1,{delta_chars}}}"), F.lit(0))
    cut = F.when(F.col("body") == "", F.array(F.lit(""))).otherwise(cut)
    log = F.transform(cut, lambda text, i: event(i, DELTA, text))
    if revised:
        draft = event(F.lit(-2), DELTA, F.substring(F.reverse("body"), 1, delta_chars))
        anew = F.concat(F.array(draft, event(F.lit(-1), REGENERATE, F.lit(""))), log)
        edited = F.array(draft, event(F.lit(0), EDIT, F.col("body")))
        log = F.when(F.col("message") % 3 == 0, anew).when(F.col("message") % 3 == 1, edited).otherwise(log)
    return numbered.select("conv", "message", "role", F.inline(log)).select("conv", "message", "seq", "kind", "role", "text")


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages (conv, message, role, text) of a log (conv, message, seq, kind, role, text).

    Events of a message go by seq, then kind and text. The role is that of the last event
    that names one.
    """
    event = F.struct("seq", "kind", text_of("text").alias("text"), "role")
    listed = events.groupBy("conv", "message").agg(F.array_sort(F.collect_list(event)).alias("events"))
    roles = F.filter(F.col("events")["role"], lambda r: r.isNotNull())
    # The last edit or regeneration starts the text over; deltas after it are added.
    last = F.array_max(F.transform("events", lambda e, i: F.when(e["kind"] != DELTA, i + 1).otherwise(1)))
    live = F.slice("events", last, F.size("events"))
    text = F.array_join(F.transform(live, lambda e: F.when(e["kind"] == REGENERATE, "").otherwise(e["text"])), "")
    role = F.coalesce(F.get(roles, F.size(roles) - 1), F.lit(""))
    return listed.select("conv", "message", role.alias("role"), text.alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """conv, formatted, loss (array of struct start, end: code points of assistant texts in it)."""
    message = F.struct("message", "role", "text")
    listed = messages.groupBy("conv").agg(F.array_sort(F.collect_list(message)).alias("messages"))
    pieces = F.transform(
        "messages",
        lambda m: F.struct(
            F.concat(F.lit(START), _role_out(m["role"]), F.lit("\n")).alias("head"), escape(m["text"]).alias("body"), (m["role"] == "assistant").alias("learn")
        ),
    )
    heads, bodies = F.transform("pieces", lambda p: F.length(p["head"])), F.transform("pieces", lambda p: F.length(p["body"]))
    sizes = F.zip_with(heads, bodies, lambda h, b: h + b + len(END) + 1)

    def span(p: Column, at: Column) -> Column:
        start = at + F.length(p["head"])
        return F.when(p["learn"], F.struct(start.alias("start"), (start + F.length(p["body"])).alias("end")))

    whole = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END + "\n"))), "")
    loss = F.array_compact(F.zip_with("pieces", running_sums(sizes), span))
    return listed.withColumn("pieces", pieces).select("conv", whole.alias("formatted"), loss.alias("loss"))


def parse(formatted: Column) -> Column:
    """Array of struct (role, text), read back from a formatted conversation."""
    parts = F.filter(F.split(formatted, r"<\|im_start\|>", -1), lambda p: p != "")

    def message(part: Column) -> Column:
        head = F.substring_index(part, "\n", 1)
        text = F.substring(part, F.length(head) + 2, F.length(part) - F.length(head) - 1 - (len(END) + 1))
        return F.struct(_role_in(head).alias("role"), unescape(text).alias("text"))

    return F.transform(parts, message)


def masked(formatted: Column, loss: Column) -> Column:
    """The texts under the mask, read back and put together; a span lies within one message.

    The text is cut at the marks once, and each span follows the message that it lies in when both
    are sorted by place, so the work grows with the text and not with text times spans.
    """
    def messages(parts: Column) -> Column:
        starts = running_sums(F.transform(parts, lambda p: F.length(p) + len(START)))
        return F.zip_with(parts, starts, lambda p, at: F.struct(at.alias("at"), F.lit(None).cast("int").alias("end"), p.alias("text")))

    def texts(placed: Column) -> Column:
        before = F.concat(F.slice(placed, 1, 1), placed)
        return F.zip_with(placed, F.slice(before, F.lit(1), F.size(placed)), lambda s, m: F.when(
            s["end"].isNotNull(), unescape(F.substring(m["text"], s["at"] - m["at"] + 1, s["end"] - s["at"]))
        ))

    spans = F.transform(loss, lambda s: F.struct(s["start"].alias("at"), s["end"].alias("end"), F.lit(None).cast("string").alias("text")))
    parts = F.split(formatted, r"<\|im_start\|>", -1)
    # Where a span begins right behind a mark, the message has the place too and goes first: it has no end.
    return F.array_join(let(F.array_sort(F.concat(let(parts, messages), spans)), texts), "")


def format_chats(events: DataFrame) -> DataFrame:
    """conv, formatted, loss: events folded and rendered."""
    return render(fold_events(events))
