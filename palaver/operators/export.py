"""Export shapes: sessions, full-context traces, replay splits.

A session, a fine-tuning record and a stored conversation are one row for each
conversation, so its messages meet in one array whatever their number.  A trace
row carries the whole context up to its message.  Traces are built per
``(conversation, part)`` of ``PART_SIZE`` turn positions, which spreads a huge
conversation over tasks: a part's messages are gathered once, contexts are cut from
them where one is wanted, and the messages of earlier parts are put before.  :func:`trace_index` is the linear form for when copied text is not
wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from palaver.functions.content import flatten_content, inline_content
from palaver.functions.text import chars, floor_div, output_tokens, word_count
from palaver.operators.metrics import KEY, context_scan, is_role
from palaver.operators.scan import TURN_BLOCK, neighbour, turn_bucket, with_key

PART_SIZE = TURN_BLOCK


def _in_turn_order(entry: Column) -> Column:
    """Array of ``entry`` structs whose first field is the turn, sorted by it."""
    return F.array_sort(F.collect_list(entry))


def _role_content(entries: Column) -> Column:
    return F.transform(entries, lambda x: F.struct(x["role"].alias("role"),
                                                   x["content"].alias("content")))


def nested_messages(messages: DataFrame) -> DataFrame:
    """``(conv_id, messages)`` with messages as role/content structs."""
    entry = F.struct("turn", "role", F.col("text").alias("content"))
    return with_key(messages, [KEY]).groupBy(KEY).agg(
        _role_content(_in_turn_order(entry)).alias("messages"))


def sessions(messages: DataFrame, keep_empty: bool = False, content: str = "text") -> DataFrame:
    """User texts per conversation: ``(session_id, turns)``.

    ``keep_empty`` keeps conversations without a user message.  ``content``
    says how list content is flattened: ``text`` (not at all), ``media``
    (markers after the text) or ``inline`` (markers in place).
    """
    flatten = {"text": lambda c: c, "media": flatten_content, "inline": inline_content}[content]
    text = flatten(F.col("text"))
    rows = messages if keep_empty else messages.filter(is_role("user"))
    entry = F.when(is_role("user"), F.struct(F.col("turn"), text.alias("text")))
    grouped = (with_key(rows, [KEY]).select(KEY, entry.alias("entry")).groupBy(KEY)
               .agg(_in_turn_order(F.col("entry")).alias("t")))
    return grouped.select(F.col(KEY).alias("session_id"), F.transform(
        "t", lambda x: F.struct(x["text"].alias("text"))).alias("turns"))


def _scan_with_text(messages: DataFrame, part_size: int) -> DataFrame:
    """Context scan that keeps the text; ``_bkt`` is the part, ``_parts`` their number."""
    return context_scan(messages.select(KEY, "turn", "role", "text"), part_size, buckets="_parts")


def _contexts(rows: DataFrame, wanted: Column, is_message: Column | None = None) -> DataFrame:
    """A row for each ``wanted`` struct, with ``messages`` up to and including its position.

    ``rows`` are scanned messages.  ``wanted`` is NULL for rows that end no context; its
    first field is ``position``.  Rows that fail ``is_message`` only want a context.
    A part's messages are gathered once, and contexts are cut from them for wanted
    positions alone; the messages of earlier parts are put before them.
    """
    entry = F.struct("position", "role", F.col("text").alias("content"))
    if is_message is not None:
        entry = F.when(is_message, entry)

    def gathered(part: DataFrame) -> DataFrame:
        whole = part.groupBy(KEY, "_bkt").agg(_in_turn_order(entry).alias("m"),
                                              F.collect_list(wanted).alias("_w"))
        return whole.select(KEY, "_bkt", F.get("m", F.lit(0))["position"].alias("_first"),
                            _role_content(F.col("m")).alias("_m"), "_w")

    none = F.array().cast("array<struct<role:string,content:string>>")
    short = gathered(rows.filter(F.col("_parts") == 1)).withColumn("_earlier", none)
    before = Window.partitionBy(KEY).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    long = gathered(rows.filter(F.col("_parts") > 1)).withColumn(
        "_earlier", F.flatten(F.collect_list("_m").over(before)))
    each = short.union(long).select(KEY, "_first", "_m", "_earlier", F.explode("_w").alias("_w"))
    own = F.slice("_m", F.lit(1), (F.col("_w.position") - F.col("_first") + 1).cast("int"))
    return each.select(KEY, "_w.*", F.when(F.size("_earlier") == 0, own).otherwise(
        F.concat("_earlier", own)).alias("messages"))


def _delay() -> Column:
    """0 from the second reply on, absent for the first."""
    return F.when(F.col("reply_no") > 1, F.lit(0).cast("bigint"))


def trace(messages: DataFrame, part_size: int = PART_SIZE) -> DataFrame:
    """One row per assistant message with the context up to it."""
    reply = F.when(is_role("assistant"), F.struct(
        "position", "turn", output_tokens(F.col("text")).alias("output_length"),
        _delay().alias("delay")))
    return _contexts(_scan_with_text(messages, part_size), reply).select(
        F.col(KEY).alias("session_id"), "turn", "messages", "output_length", "delay")


def trace_index(messages: DataFrame, part_size: int = PART_SIZE) -> DataFrame:
    """The trace by reference: which message ends each context, no copied text.

    The full trace is quadratic in the conversation length; this form is linear
    and holds the same information together with the message table.
    """
    rows = messages.select(KEY, "turn", "role", chars(F.col("text")).alias("n_chars"))
    scanned = context_scan(rows, part_size).filter(is_role("assistant"))
    return scanned.select(
        F.col(KEY).alias("session_id"), F.col("turn").alias("upto_turn"),
        F.col("position").alias("context_messages"), F.col("cum_chars").alias("context_chars"),
        F.greatest(F.lit(1).cast("bigint"), floor_div(F.col("n_chars"), 4)).alias("output_length"),
        _delay().alias("delay"))


def word_trace(messages: DataFrame, part_size: int = PART_SIZE) -> DataFrame:
    """Pair-based trace: contexts end at every second message, length in words."""
    end = F.when((F.col("position") >= 3) & (F.col("position") % 2 == 1), F.struct(
        "position", "turn", word_count(F.col("text")).alias("output_length")))
    return _contexts(_scan_with_text(messages, part_size), end).select(
        F.col(KEY).alias("session_id"), "turn", "messages", "output_length")


def mixed_trace(messages: DataFrame, granularity: str | Column = "turn",
                part_size: int = PART_SIZE) -> DataFrame:
    """Trace over the cumulative list: entry *i* gets the first 2i+3 messages.

    The output length is the cumulative number of characters.  Positions past
    the end fall back to the whole conversation, so every cumulative entry
    gives exactly one row.  ``granularity`` is ``turn`` or ``message``, or a
    column over the messages that says which, when sources differ.
    """
    kind = F.lit(granularity) if isinstance(granularity, str) else granularity
    by_turn = (kind == "turn").alias("_by_turn")
    scanned = context_scan(messages.select(KEY, "turn", "role", "text", by_turn), part_size,
                           buckets="_parts")
    # entry_no is 1-based: entry i = entry_no - 1 covers 2 * i + 3 messages.
    entry_no = F.when(F.col("_by_turn"), F.col("reply_no")).otherwise(F.col("position"))
    entries = scanned.filter(~F.col("_by_turn") | is_role("assistant")).select(
        F.col(KEY), entry_no.alias("entry"),
        F.least(F.col("num_messages"), entry_no * 2 + 1).alias("position"),
        F.col("cum_chars").alias("output_length"))
    # Lean rows find the part in which their context ends.
    placed = entries.join(scanned.select(KEY, "position", "_bkt", "_parts"), [KEY, "position"])
    rows = scanned.select(KEY, "_bkt", "_parts", "position", "role", "text").unionByName(
        placed, allowMissingColumns=True)
    end = F.when(F.col("entry").isNotNull(), F.struct("position", "entry", "output_length"))
    return _contexts(rows, end, F.col("entry").isNull()).select(
        F.col(KEY).alias("session_id"), "entry", "messages", "output_length")


def replay_trace(messages: DataFrame, default_length: int = 100, nested: bool = True,
                 part_size: int = PART_SIZE) -> DataFrame:
    """One row per message; the output length looks ahead to the next reply."""
    if nested:
        rows = _scan_with_text(messages, part_size)
    else:
        rows = messages.select(KEY, "turn", "role", chars(F.col("text")).alias("n_chars"))
    # Only the length of the next message is wanted, so its text stays where it is.
    if nested:
        rows = rows.withColumn("n_chars", chars(F.col("text")))
    ahead = neighbour(rows, [KEY], turn_bucket("turn", part_size), ["turn"],
                      {"next_role": "role", "next_chars": "n_chars"})
    length = F.when(F.col("next_role") == "assistant", F.col("next_chars")).otherwise(
        F.lit(default_length)).cast("bigint")
    if nested:
        ahead = _contexts(ahead, F.struct("position", "turn", length.alias("output_length")))
        length = F.col("output_length")
    shown = ["messages"] if nested else []
    return ahead.select(F.col(KEY).alias("session_id"), "turn", *shown,
                        length.alias("output_length"))


def replay_split(messages: DataFrame, by_role: bool = True,
                 part_size: int = PART_SIZE) -> DataFrame:
    """The messages before each new exchange, and the exchange itself.

    By role, an exchange is a user message and the reply right after it.
    Otherwise exchanges are positions (2,3), (4,5), ... counted from zero,
    whatever their roles.
    """
    scanned = _scan_with_text(messages, part_size)
    ahead = neighbour(scanned, [KEY], F.col("_bkt"), ["turn"],
                      {"next_role": "role", "next_text": "text"}, ahead=True)
    before = F.col("position") - 1
    if by_role:
        starts = is_role("user") & (F.col("next_role") == "assistant") & (before > 0)
    else:
        starts = (before >= 2) & (before % 2 == 0)
    pair = F.array(F.struct("role", F.col("text").alias("content")),
                   F.struct(F.col("next_role").alias("role"),
                            F.col("next_text").alias("content")))
    new_turn = F.filter(pair, lambda m: m["role"].isNotNull())
    start = F.when(starts, F.struct(
        "position", "turn", before.alias("prefix_messages"),
        (F.col("cum_chars") - chars(F.col("text"))).alias("prefix_chars"), new_turn.alias("new_turn")))
    # The exchange starts after the prefix, which therefore lacks the last message.
    return _contexts(ahead, start).select(
        F.col(KEY).alias("session_id"), "turn", "prefix_messages", "prefix_chars",
        F.slice("messages", F.lit(1), F.col("prefix_messages").cast("int")).alias("prefix"), "new_turn")


def fine_tuning(messages: DataFrame) -> DataFrame:
    """``{"messages": [...]}`` records, one for each conversation."""
    return nested_messages(messages).select("messages")
