"""Descriptive tags and names of datasets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Common tags, size / token / turn thresholds, family tags.
COMMON_TAGS = ("synthetic", "multi-turn", "benchmarking", "inference", "prefix-caching")
SIZE_TAGS = ((100, "small"), (500, "medium"), (None, "large"))
TOKEN_TAGS = ((1_000_000, "sub-1M-tokens"), (5_000_000, "1M-5M-tokens"), (None, "5M+-tokens"))
TURN_TAGS = ((5, "short-context"), (15, "medium-context"), (30, "long-context"),
             (None, "very-long-context"))
FAMILY_TAGS = {
    "agentic": ("tool-use", "agent-tasks"),
    "pdf": ("multimodal",),
    "image": ("multimodal",),
    "reasoning": ("deep-reasoning",),
    "random": ("baseline", "gibberish"),
    "repeat": ("repetitive", "cache-stress"),
}


def _threshold(value: Column, steps, closed: bool) -> Column:
    out = None
    for bound, tag in steps:
        if bound is None:
            return out.otherwise(F.lit(tag))
        test = value <= bound if closed else value < bound
        out = F.when(test, tag) if out is None else out.when(test, tag)
    return out


def auto_tags(dataset_type: Column, conversations: Column, total_tokens: Column,
              max_turns: Column) -> Column:
    """Array of automatic tags, in the order they are derived."""
    family = F.array().cast("array<string>")
    for name, tags in FAMILY_TAGS.items():
        family = F.when(dataset_type == name, F.array(*[F.lit(t) for t in tags])).otherwise(family)
    base = F.array(
        *[F.lit(t) for t in COMMON_TAGS], dataset_type,
        _threshold(conversations, SIZE_TAGS, closed=True),
        F.concat(F.lit("n"), conversations.cast("string")),
        _threshold(total_tokens, TOKEN_TAGS, closed=False),
        _threshold(max_turns, TURN_TAGS, closed=True))
    return F.concat(base, family)


def merge_tags(*lists: Column) -> Column:
    """Distinct sorted union of tag lists."""
    return F.array_sort(F.array_distinct(F.concat(*lists)))


def dataset_tags(conversations: DataFrame, key: str = "dataset_type",
                 user_tags: Sequence[str] = (), extra_tags: Sequence[str] = (),
                 kind: Column | None = None) -> DataFrame:
    """``user_tags``, ``auto_tags`` and ``all_tags`` per dataset."""
    facts = conversations.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("estimated_tokens").alias("_tokens"),
        F.max("num_turns").alias("_turns"))
    user = F.array(*[F.lit(t) for t in user_tags]).cast("array<string>")
    extra = F.array(*[F.lit(t) for t in extra_tags]).cast("array<string>")
    kind = F.col(key) if kind is None else kind
    auto = F.concat(auto_tags(kind, F.col("_n"), F.col("_tokens"), F.col("_turns")), extra)
    return (facts.select(key, F.col("_n").alias("conversations"),
                         F.col("_tokens").alias("total_tokens"),
                         user.alias("user_tags"), auto.alias("auto_tags"))
            .withColumn("all_tags", merge_tags(F.col("user_tags"), F.col("auto_tags"))))


def tag_index(tagged: DataFrame, key: str = "dataset_type") -> DataFrame:
    """A row for each tag and dataset with the tag's number of datasets, most used first."""
    members = tagged.select(F.explode("all_tags").alias("tag"), F.col(key).alias("member"))
    used = members.groupBy("tag").agg(F.count(F.lit(1)).alias("datasets"))
    return members.join(used, "tag").select("tag", "datasets", "member").orderBy(
        F.desc("datasets"), "tag", "member")


def with_all_tags(tagged: DataFrame, required: Sequence[str]) -> DataFrame:
    """Datasets that carry every required tag."""
    wanted = F.array(*[F.lit(t) for t in required]).cast("array<string>")
    return tagged.filter(F.size(F.array_except(wanted, F.col("all_tags"))) == 0)


def descriptive_name(base: Column | str, conversations: Column, seed: int, version: Column | str,
                     day: Column | None = None, suffix: str | None = None) -> Column:
    """``base_n{count}_s{seed}_v{version}_{yyyymmdd}[_suffix]``."""
    stem = F.replace(base if isinstance(base, Column) else F.lit(base), F.lit(".parquet"), F.lit(""))
    stamp = F.date_format(day if day is not None else F.current_timestamp(), "yyyyMMdd")
    parts = [stem, F.concat(F.lit("n"), conversations.cast("string")), F.lit(f"s{seed}"),
             F.concat(F.lit("v"), version if isinstance(version, Column) else F.lit(version)),
             stamp]
    if suffix:
        parts.append(F.lit(suffix))
    return F.concat_ws("_", *parts)
