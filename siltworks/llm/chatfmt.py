"""Chat formatting by event-sourced reconstruction. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<turn>", "</turn>\n"


def escape(c: Column) -> Column:
    """No `<` is left, so no text can hold a marker; undone by unescape()."""
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def escape_role(c: Column) -> Column:
    """As escape(); line ends too, as a role ends at one."""
    return F.replace(escape(c), F.lit("\n"), F.lit("&nl;"))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("&nl;"), F.lit("\n")))


def events_of_rows(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """An event log of finished messages: conv_id, seq, event, message, role, text.

    One `message` event a row, in the order of turn; equal turns are ordered by
    role and text, and rows that repeat all four are messages of their own. Null turns come first.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    plain = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    seq = F.row_number().over(order).cast("long")
    return plain.select("conv_id", seq.alias("seq"), F.lit("message").alias("event"), seq.alias("message"), "role", "text")


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, message, role, text, from events(conv_id, seq, event, message, role, text).

    Events of a conversation apply in the order of seq (ties: event, text):
    `message` starts a message or starts it again, `delta` appends to it,
    `edit` replaces its text so far, and `regenerate` withdraws it and all messages of greater number,
    which later events may build again. A delta or edit without a message
    before it starts one. Unknown or null events are ignored; null text is
    empty; a message's role is its last non-null one, else empty.
    """
    later = Window.partitionBy("conv_id").orderBy(F.col("seq").desc_nulls_last(), F.col("event").desc(), F.col("text").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    known = events.where(F.col("event").isin("message", "delta", "edit", "regenerate"))
    void = F.min(F.when(F.col("event") == "regenerate", F.col("message"))).over(later)
    live = known.withColumn("__void", void).where("event <> 'regenerate' AND (__void IS NULL OR __void > message)")
    same = Window.partitionBy("conv_id", "message").orderBy(F.col("seq").desc_nulls_last(), F.col("event").desc(), F.col("text").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    resets = F.count(F.when(F.col("event").isin("message", "edit"), 1)).over(same)
    parts = live.withColumn("__resets", resets)
    part = F.struct("seq", "event", F.when(F.col("__resets") == 0, F.coalesce("text", F.lit(""))).otherwise("").alias("text"), "role")
    whole = parts.groupBy("conv_id", "message").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    roles = F.filter(F.col("parts.role"), lambda r: r.isNotNull())
    role = F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit(""))
    return whole.select("conv_id", "message", role.alias("role"), F.array_join("parts.text", "").alias("text"))


def render(messages: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """conv_id, formatted, loss_spans: one row a conversation from messages(conv_id, message, role, text).

    A turn is `<turn>`, role, line end, text, `</turn>`, line end. loss_spans are (start, length) in characters of
    formatted (from 0), of the escaped texts of the loss roles, in order.
    """
    role, text = escape_role(F.coalesce("role", F.lit(""))), escape(F.coalesce("text", F.lit("")))
    turn = F.concat(F.lit(OPEN), role, F.lit("\n"), text, F.lit(CLOSE))
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    lines = messages.select("conv_id", "message", turn.alias("line"), (F.lit(len(OPEN) + 1) + F.length(role)).alias("lead"), F.length(text).alias("size"), F.coalesce(F.col("role").isin(*loss_roles), F.lit(False)).alias("loss"))
    lines = lines.withColumn("at", F.coalesce(F.sum(F.length("line").cast("long")).over(before), F.lit(0)))
    span = F.when(F.col("loss"), F.struct((F.col("at") + F.col("lead")).alias("start"), F.col("size").cast("long").alias("length")))
    whole = lines.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("message", "line", span.alias("span")))).alias("lines"))
    return whole.select("conv_id", F.array_join("lines.line", "").alias("formatted"), F.filter(F.col("lines.span"), lambda s: s.isNotNull()).alias("loss_spans"))


def parse(formatted: Column) -> Column:
    """The (role, text) turns that a formatted conversation holds, read from it alone."""
    turns = F.filter(F.split(formatted, OPEN, -1), lambda t: t != "")
    one = lambda t: F.struct(
        unescape_role(F.substring_index(t, "\n", 1)).alias("role"),
        unescape(F.substr(t, F.length(F.substring_index(t, "\n", 1)) + 2, F.length(t) - F.length(F.substring_index(t, "\n", 1)) - 1 - len(CLOSE))).alias("text"),
    )
    return F.transform(turns, one)


def format_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, formatted, loss_spans of a table of turns. Null conversation ids form one conversation; an empty table gives none; other columns are not read."""
    return render(fold_events(events_of_rows(rows, conv_col, turn_col, role_col, text_col)))


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted text says when it is read back: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    back = formatted.select("conv_id", "formatted", parse(F.col("formatted")).alias("turns"), F.array_join(F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))), "").alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
