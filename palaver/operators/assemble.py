"""Conversation rows (wide form) from messages, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from palaver.functions.content import content_parts, parse_messages, part_chars
from palaver.functions.text import chars, tokens
from palaver.operators.metrics import KEY, context_scan, is_role, with_growth


def conversation_rows(messages: DataFrame, granularity: str = "turn",
                      typed_parts: bool = False) -> DataFrame:
    """One row per conversation with nested messages and the cumulative list.

    The scan and the nesting use the same partitioning, so message texts are
    shuffled once.  With ``typed_parts`` the content may be a JSON part list:
    only the characters of its text parts are counted.
    """
    size = part_chars(F.col("text")) if typed_parts else chars(F.col("text"))
    scanned = context_scan(
        messages.select(KEY, "turn", "role", "text"), size=size,
        totals={"num_messages": "position", "total_characters": "cum_chars",
                "num_turns": "reply_no"}, whole_keys=True)
    entry = is_role("assistant") if granularity == "turn" else F.lit(True)
    fields = [F.col("role"), F.col("text").alias("content")]
    if typed_parts:
        fields.append(content_parts(F.col("text")).alias("parts"))
    grouped = scanned.groupBy(KEY).agg(
        F.max("num_turns").alias("num_turns"), F.max("num_messages").alias("num_messages"),
        F.max("total_characters").alias("total_characters"),
        F.coalesce(F.min_by("text", F.when(is_role("system"), F.col("turn"))),
                   F.lit("")).alias("system_prompt"),
        F.array_sort(F.collect_list(F.struct(F.col("turn"), *fields))).alias("m"),
        F.array_sort(F.collect_list(F.when(entry, F.col("cum_chars")))).alias("cum"))
    names = ["role", "content"] + (["parts"] if typed_parts else [])
    return grouped.select(
        F.col(KEY).alias("conversation_id"), "num_turns", "num_messages", "system_prompt",
        F.transform("m", lambda x: F.struct(*[x[n].alias(n) for n in names])).alias("messages"),
        "total_characters", tokens(F.col("total_characters")).alias("estimated_tokens"),
        F.col("cum").alias("cumulative_char_lengths"))


def to_stored(rows: DataFrame) -> DataFrame:
    """Nested columns as JSON text, the form kept in dataset files."""
    out = rows
    for name, kind in rows.dtypes:
        if kind.startswith(("array", "struct", "map")):
            out = out.withColumn(name, F.to_json(F.col(name)))
    return out


def explode_messages(stored: DataFrame) -> DataFrame:
    """The long message table of stored rows: ``conv_id, turn, role, text``.

    Rows without messages give no row here; :func:`curate.invalid_messages` lists them.
    """
    nested = (parse_messages(F.col("messages"))
              if dict(stored.dtypes)["messages"] == "string" else F.col("messages"))
    return stored.select(F.col("conversation_id").alias(KEY),
                         F.posexplode(nested).alias("_pos", "m")).select(
        KEY, F.col("_pos").cast("bigint").alias("turn"),
        F.col("m.role").alias("role"), F.col("m.content").alias("text"))


def _cumulative(df: DataFrame) -> Column:
    if dict(df.dtypes)["cumulative_char_lengths"] == "string":
        return F.from_json("cumulative_char_lengths", "array<bigint>")
    return F.col("cumulative_char_lengths")


def profile_input(rows: DataFrame) -> DataFrame:
    """Conversation rows with first/last context and growth, ready to profile."""
    cum = _cumulative(rows)
    return with_growth(
        rows.withColumn("num_entries", F.coalesce(F.size(cum), F.lit(0)).cast("bigint"))
        .withColumn("first_chars", F.try_element_at(cum, F.lit(1)))
        .withColumn("last_chars", F.try_element_at(cum, F.lit(-1)))
        .drop("messages", "cumulative_char_lengths", "tool_calls"))
