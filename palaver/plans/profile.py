"""Profiles composed from the distribution operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from palaver.functions.text import hms, share
from palaver.operators import distribution as d


def context_growth_profile(conversations: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Growth ratio and first/last context over conversations with two entries.

    All figures come from one table of value counts.
    """
    keys = list(keys)
    rows = conversations.filter(F.col("growth_ratio").isNotNull())
    names = {"growth_ratio": "ratio", "first_chars": "first", "last_chars": "last"}
    counts = d.value_counts(rows, keys, list(names))
    n, v = F.col("n"), F.col("value")
    stats = counts.groupBy(*keys, "metric").agg(
        F.sum(n).alias("_n"), F.min(v).alias("min"), F.max(v).alias("max"),
        (F.sum(v * n) / F.sum(n)).alias("mean"))
    both = stats.join(d.medians(counts, [*keys, "metric"]), [*keys, "metric"])

    def of(metric: str, stat: str) -> Column:
        return F.max(F.when(F.col("metric") == metric, F.col(stat))).alias(
            f"{names[metric]}_{stat}")

    return both.groupBy(*keys).agg(
        F.max("_n").alias("n"), *[of("growth_ratio", x) for x in ("min", "max", "mean", "median")],
        *[of(m, x) for m in ("first_chars", "last_chars") for x in ("mean", "median")])


def compare_datasets(conversations: DataFrame, key: str = "dataset_type") -> DataFrame:
    """Size, mean turns and tokens of every dataset."""
    return conversations.groupBy(key).agg(
        F.count(F.lit(1)).alias("conversations"), F.avg("num_turns").alias("avg_turns"),
        F.avg("estimated_tokens").alias("avg_tokens"),
        F.sum("estimated_tokens").alias("total_tokens"),
        F.max("estimated_tokens").alias("max_tokens"))


def side_by_side(conversations: DataFrame, types: Sequence[str],
                 key: str = "dataset_type") -> DataFrame:
    """Profile metrics as rows, one column per dataset type."""
    wide = conversations.groupBy(key).agg(
        F.count(F.lit(1)).alias("conversations"),
        F.min("num_turns").alias("turns_min"), F.max("num_turns").alias("turns_max"),
        F.avg("num_turns").alias("turns_mean"),
        F.sum("estimated_tokens").alias("tokens_total"),
        F.avg("estimated_tokens").alias("tokens_mean"),
        F.max("estimated_tokens").alias("tokens_max"),
        F.coalesce(F.avg("growth_ratio"), F.lit(0.0)).alias("growth_mean"))
    names = [c for c in wide.columns if c != key]
    long = wide.select(key, F.inline(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value"))
        for n in names])))
    return long.groupBy("metric").pivot(key, list(types)).agg(F.first("value"))


def agentic_profile(runs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Score summary, tool-call totals and error rate, from one table of counts."""
    keys = list(keys)
    counts = d.value_counts(runs, keys, ["success_score", "num_tool_calls", "num_errors"])
    n, v = F.col("n"), F.col("value")
    stats = counts.groupBy(*keys, "metric").agg(
        F.min(v).alias("min"), F.max(v).alias("max"), F.sum(v * n).alias("total"),
        (F.sum(v * n) / F.sum(n)).alias("mean"))
    both = stats.join(d.medians(counts, [*keys, "metric"]), [*keys, "metric"])

    def of(metric: str, stat: str) -> Column:
        return F.max(F.when(F.col("metric") == metric, F.col(stat)))

    wide = both.groupBy(*keys).agg(
        *[of("success_score", x).alias(f"score_{x}") for x in ("min", "max", "mean", "median")],
        of("num_tool_calls", "total").cast("bigint").alias("tool_calls"),
        of("num_tool_calls", "mean").alias("tools_mean"),
        of("num_tool_calls", "max").cast("bigint").alias("tools_max"),
        of("num_errors", "total").cast("bigint").alias("errors"))
    return wide.withColumn("error_rate", F.coalesce(
        share(F.col("errors"), F.col("tool_calls")), F.lit(0.0)))


def multimodal_profile(conversations: DataFrame, item: str, category: str,
                       exact: bool = True) -> tuple[DataFrame, DataFrame]:
    """Distinct items, and the distribution over an item category."""
    distinct = F.count_distinct(item) if exact else F.approx_count_distinct(item)
    return (conversations.agg(distinct.alias("unique_items")),
            d.frequency(conversations, [], category))


def time_estimate(conversations: DataFrame, key: str = "dataset_type",
                  tokens_per_second: float = 100.0,
                  workers: Sequence[int] = (1, 5, 10, 20)) -> DataFrame:
    """Run time of a benchmark over all tokens, per number of workers."""
    totals = conversations.groupBy(key).agg(
        F.count(F.lit(1)).alias("conversations"),
        F.sum("estimated_tokens").alias("total_tokens"))
    seconds = F.col("total_tokens") / F.lit(tokens_per_second)
    hours, minutes, rest = hms(seconds)
    return (totals.withColumn("total_seconds", seconds)
            .withColumn("hours", hours).withColumn("minutes", minutes)
            .withColumn("seconds", rest)
            .withColumn("workers", F.explode(F.array(*[F.lit(w).cast("bigint") for w in workers])))
            .withColumn("minutes_at_workers",
                        F.col("total_seconds") / F.col("workers") / F.lit(60.0)))


def run_summary(conversations: DataFrame, key: str, category: str) -> DataFrame:
    """What a generation run reports: size, turn range, category shares, tokens.

    Rows are aggregated once per (key, category); everything else works on
    that small table.
    """
    small = conversations.groupBy(key, category).agg(
        F.count(F.lit(1)).alias("n"), F.min("num_turns").alias("t_min"),
        F.max("num_turns").alias("t_max"), F.sum("num_turns").alias("t_sum"),
        F.sum("estimated_tokens").alias("k_sum"), F.max("estimated_tokens").alias("k_max"))
    share_row = F.struct(F.col(category).alias("metric"), F.col("n"))
    whole = small.groupBy(key).agg(
        F.sum("n").alias("conversations"), F.min("t_min").alias("turns_min"),
        F.max("t_max").alias("turns_max"), F.sum("t_sum").alias("t_sum"),
        F.sum("k_sum").alias("tokens_total"), F.max("k_max").alias("tokens_max"),
        # one entry per configured category
        F.collect_list(share_row).alias("categories"))
    n = F.col("conversations")
    facts = {"conversations": n, "turns_min": F.col("turns_min"), "turns_max": F.col("turns_max"),
             "turns_mean": F.col("t_sum") / n, "tokens_total": F.col("tokens_total"),
             "tokens_mean": F.col("tokens_total") / n, "tokens_max": F.col("tokens_max")}
    sizes = F.array(*[F.struct(F.lit("size").alias("section"), F.lit(name).alias("metric"),
                               value.cast("double").alias("value"))
                      for name, value in facts.items()])
    shares = F.transform("categories", lambda c: F.struct(
        F.lit("category").alias("section"), c["metric"].alias("metric"),
        share(c["n"], n).alias("value")))
    return whole.select(key, F.inline(F.concat(sizes, shares)))


def family_statistics(conversations: DataFrame, key: str, category: str,
                      metrics: Sequence[str] = ("num_turns", "estimated_tokens",
                                                "total_characters")) -> DataFrame:
    """Long statistics per dataset: ``(key, section, metric, stat, value)``.

    Numeric summaries (with success score and tool calls where they exist) and
    the number of conversations per category.
    """
    extra = [c for c in ("success_score", "num_tool_calls", "num_errors")
             if c in conversations.columns]
    wide = d.numeric_summary(conversations, [key], [*metrics, *extra])
    stats = ("min", "max", "mean", "median", "stdev", "total")
    numbers = wide.select(key, F.lit("numbers").alias("section"), "metric", F.inline(F.array(*[
        F.struct(F.lit(x).alias("stat"), F.col(x).cast("double").alias("value")) for x in stats])))
    counts = conversations.groupBy(key, F.col(category).alias("metric")).agg(
        F.count(F.lit(1)).cast("double").alias("value"))
    return numbers.unionByName(counts.select(
        key, F.lit("categories").alias("section"), "metric", F.lit("count").alias("stat"), "value"))


def mixture_summary(mixed: DataFrame, key: str = "source_dataset") -> DataFrame:
    """Share and means per source of a mixture."""
    counted = mixed.groupBy(key).agg(
        F.count(F.lit(1)).alias("count"), F.avg("num_turns").alias("avg_turns"),
        F.avg("estimated_tokens").alias("avg_tokens"))
    # Sources are few: one array holds them, so that the mixture is drawn once.
    listed = counted.agg(F.collect_list(F.struct(*counted.columns)).alias("rows"),
                         F.sum("count").alias("whole"))
    return listed.select("whole", F.inline("rows")).select(
        *counted.columns, share(F.col("count"), F.col("whole")).alias("percentage"))


def column_inspection(df: DataFrame) -> DataFrame:
    """Column name, type, non-null and null counts of a table."""
    counted = df.agg(F.count(F.lit(1)).alias("_rows"),
                     *[F.count(F.col(f"`{c}`")).alias(f"_c{i}") for i, c in enumerate(df.columns)])
    rows = F.array(*[F.struct(F.lit(name).alias("column"), F.lit(kind).alias("type"),
                              F.col("_rows").alias("rows"), F.col(f"_c{i}").alias("non_null"),
                              (F.col("_rows") - F.col(f"_c{i}")).alias("nulls"))
                     for i, (name, kind) in enumerate(df.dtypes)])
    return counted.select(F.inline(rows))


