"""Conversation metrics derived from the long message table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from palaver.functions.text import chars, preview, share, tokens
from palaver.operators.scan import TURN_BLOCK, neighbour, prefix_sums, turn_bucket

KEY = "conv_id"


def is_role(role: str) -> Column:
    return F.col("role") == F.lit(role)


def message_sizes(messages: DataFrame, *keep: str) -> DataFrame:
    """Lean message rows: the text is reduced to its length before any shuffle."""
    return messages.select(KEY, "turn", "role", *keep, chars(F.col("text")).alias("n_chars"))


def context_scan(rows: DataFrame, block: int = TURN_BLOCK, size: Column | None = None,
                 totals: Mapping[str, str] | None = None, **options) -> DataFrame:
    """Running characters, position and reply index at every message.

    Adds ``cum_chars``, ``position`` (1-based), ``reply_no`` (assistant
    messages so far) and ``num_messages`` of the conversation.  ``size`` is the
    length of a message; rows that keep their text derive it after the shuffle.
    Options are those of :func:`prefix_sums`.
    """
    one = F.lit(1).cast("bigint")
    if size is None:
        size = F.col("n_chars") if "n_chars" in rows.columns else chars(F.col("text"))
    return prefix_sums(
        rows, [KEY], turn_bucket("turn", block), ["turn"],
        {"cum_chars": size, "position": one,
         "reply_no": F.when(is_role("assistant"), one).otherwise(F.lit(0).cast("bigint"))},
        totals=totals or {"num_messages": "position"}, **options)


def cumulative_per_turn(messages: DataFrame, granularity: str = "turn",
                        block: int = TURN_BLOCK) -> DataFrame:
    """Cumulative characters: one row per reply, or per message."""
    rows = context_scan(message_sizes(messages), block)
    if granularity == "turn":
        rows = rows.filter(is_role("assistant"))
    elif granularity != "message":
        raise ValueError(f"unknown granularity {granularity!r}")
    entry = F.col("reply_no") if granularity == "turn" else F.col("position")
    return rows.select(KEY, "turn", entry.alias("entry"), "cum_chars")


def turn_growth(messages: DataFrame, block: int = TURN_BLOCK) -> DataFrame:
    """Per reply: cumulative characters and tokens, growth since the previous one."""
    entries = (context_scan(message_sizes(messages), block).filter(is_role("assistant"))
               .select(KEY, "_bkt", "turn", F.col("reply_no").alias("entry"), "cum_chars"))
    linked = neighbour(entries, [KEY], F.col("_bkt"), ["turn"],
                       {"prev_chars": "cum_chars"}, ahead=False)
    return linked.select(KEY, "entry", "cum_chars", tokens(F.col("cum_chars")).alias("cum_tokens"),
                         (F.col("cum_chars") - F.col("prev_chars")).alias("growth_chars"))


def prefix_growth(messages: DataFrame, block: int = TURN_BLOCK) -> DataFrame:
    """Mean and maximum growth per conversation; NULL with fewer than two entries."""
    return turn_growth(messages, block).groupBy(KEY).agg(
        F.count(F.lit(1)).alias("entries"),
        F.avg("growth_chars").alias("mean_growth"),
        F.max("growth_chars").alias("max_growth"))


def conversation_metrics(messages: DataFrame, granularity: str = "turn",
                         block: int = TURN_BLOCK, system_prompt: bool = False) -> DataFrame:
    """One row per conversation with sizes and context growth.

    ``first_chars`` / ``last_chars`` are the first and last entry of the
    cumulative list (they are its minimum and maximum, lengths being
    non-negative), so no ordered list is built.  Only the text of system rows
    is carried along, and only on request.
    """
    keep: list[str] = []
    source = messages
    if system_prompt:
        source = messages.withColumn("_sys", F.when(is_role("system"), F.col("text")))
        keep = ["_sys"]
    rows = context_scan(message_sizes(source, *keep), block)
    entry = is_role("assistant") if granularity == "turn" else F.lit(True)
    cum = F.when(entry, F.col("cum_chars"))
    out = rows.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("num_messages"),
        F.count_if(is_role("assistant")).alias("num_turns"),
        F.sum("n_chars").alias("total_characters"),
        F.count(cum).alias("num_entries"),
        F.min(cum).alias("first_chars"), F.max(cum).alias("last_chars"),
        *([F.coalesce(F.min_by("_sys", F.when(F.col("_sys").isNotNull(), F.col("turn"))),
                      F.lit("")).alias("system_prompt")] if system_prompt else []))
    return with_growth(out)


def basic_metrics(messages: DataFrame) -> DataFrame:
    """Message, turn, character and token counts in one combined aggregate."""
    return (message_sizes(messages).groupBy(KEY).agg(
        F.count(F.lit(1)).alias("num_messages"),
        F.count_if(is_role("assistant")).alias("num_turns"),
        F.sum("n_chars").alias("total_characters"))
        .withColumn("estimated_tokens", tokens(F.col("total_characters"))))


def with_growth(conversations: DataFrame) -> DataFrame:
    """Token estimate and last/first ratio (needs two entries; 0 if first is 0)."""
    ratio = F.when(F.col("num_entries") >= 2,
                   F.when(F.col("first_chars") > 0,
                          F.col("last_chars").cast("double") / F.col("first_chars"))
                   .otherwise(F.lit(0.0)))
    return (conversations
            .withColumn("estimated_tokens", tokens(F.col("total_characters")))
            .withColumn("growth_ratio", ratio))


def role_counts(messages: DataFrame) -> DataFrame:
    """Messages per conversation and role."""
    return messages.groupBy(KEY, "role").agg(F.count(F.lit(1)).alias("count"))


def role_distribution(messages: DataFrame) -> DataFrame:
    """Messages per role over the corpus, with percentage."""
    counted = messages.groupBy("role").agg(F.count(F.lit(1)).alias("count"))
    whole = messages.agg(F.count(F.lit(1)))
    return counted.withColumn("percentage", share(F.col("count"), whole.scalar()))


def message_lengths(messages: DataFrame) -> DataFrame:
    """Shortest, longest and mean message of every conversation."""
    return message_sizes(messages).groupBy(KEY).agg(
        F.min("n_chars").alias("min_chars"), F.max("n_chars").alias("max_chars"),
        F.avg("n_chars").alias("mean_chars"))


def count_distribution(conversations: DataFrame, column: str, first: int | None = None) -> DataFrame:
    """Conversations per exact value, ascending, share of all rows.

    ``first`` keeps the lowest values only; the share still counts everything.
    """
    counted = conversations.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    whole = counted.agg(F.sum("count"))
    out = counted.withColumn("percentage", share(F.col("count"), whole.scalar())).orderBy(column)
    return out.limit(first) if first is not None else out


def opening_messages(messages: DataFrame, n: int = 5, width: int = 80) -> DataFrame:
    """Preview of the first ``n`` message positions of every conversation."""
    return messages.filter(F.col("turn") < n).select(
        KEY, "turn", "role", preview(F.col("text"), width).alias("preview"))


def first_and_last(messages: DataFrame, width: int = 100) -> DataFrame:
    """First and last message of every conversation, cut to ``width``."""
    lean = messages.select(KEY, "turn", "role", preview(F.col("text"), width).alias("text"))
    return lean.groupBy(KEY).agg(
        F.min_by("role", "turn").alias("first_role"), F.min_by("text", "turn").alias("first_text"),
        F.max_by("role", "turn").alias("last_role"), F.max_by("text", "turn").alias("last_text"))


# What a sample row shows besides its sizes, by family.
SAMPLE_FIELDS = {
    "text": ("topic",), "reasoning": ("topic",),
    "pdf": ("paper_title", "paper_arxiv_id", "conversation_type"),
    "image": ("image_topic", "conversation_type"),
    "agentic": ("task_type", "success_score", "num_tool_calls", "num_errors"),
}
SAMPLE_SIZES = ("num_turns", "num_messages", "total_characters", "estimated_tokens")


def family_fields(columns: Sequence[str], kind: Column) -> Column:
    """The fields of a row's family as JSON text; NULL for families without any.

    Columns that the table lacks and fields without a value are left out; scores have
    two decimals.
    """
    out = F.lit(None).cast("string")
    for family, names in SAMPLE_FIELDS.items():
        shown = [(F.format_string("%.2f", F.col(n)) if n == "success_score" else F.col(n)).alias(n)
                 for n in names if n in columns]
        if shown:
            out = F.when(kind == family, F.to_json(F.struct(*shown))).otherwise(out)
    return out


def sample_rows(conversations: DataFrame, messages: DataFrame, kind: Column,
                width: int = 100) -> DataFrame:
    """Rows for display: id, family fields, sizes, first and last message cut to ``width``."""
    rows = conversations.select(KEY, kind.alias("family"),
                                family_fields(conversations.columns, kind).alias("fields"),
                                *[c for c in SAMPLE_SIZES if c in conversations.columns])
    return rows.join(first_and_last(messages, width), KEY)
