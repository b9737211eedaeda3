"""Mixing datasets: allocation, sampling per source, schema alignment."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from palaver.functions.text import bind
from palaver.operators.sampling import shuffled, stratified_sample

SOURCE = "source_dataset"

# Columns every conversation row has, and family columns.
STANDARD_COLUMNS = {
    "conversation_id": "string", "num_turns": "bigint", "num_messages": "bigint",
    "system_prompt": "string", "messages": "string", "total_characters": "bigint",
    "estimated_tokens": "bigint", "cumulative_char_lengths": "string", SOURCE: "string",
}
OPTIONAL_COLUMNS = {
    "topic": "string", "task_type": "string", "tool_calls": "string",
    "success_metric": "string", "success_score": "double", "num_tool_calls": "bigint",
    "num_errors": "bigint", "conversation_type": "string", "paper_arxiv_id": "string",
    "paper_title": "string", "paper_primary_category": "string", "image_topic": "string",
    "image_url": "string",
}
JSON_LIST_COLUMNS = ("messages", "cumulative_char_lengths")


def source_table(spark: SparkSession, weights: Mapping[str, float]) -> DataFrame:
    """The source list of a configuration: ``(source_dataset, weight, position)``."""
    rows = [(name, float(weight), i) for i, (name, weight) in enumerate(weights.items())]
    return spark.createDataFrame(rows, f"{SOURCE} string, weight double, position bigint")


def with_available(sources: DataFrame, conversations: DataFrame) -> DataFrame:
    """Sources that have rows, with their row counts."""
    counts = conversations.groupBy(SOURCE).agg(F.count(F.lit(1)).alias("available"))
    return sources.join(counts, [SOURCE])


def _listed(sources: DataFrame) -> DataFrame:
    """All sources in one array ``s`` by position; it is as long as the configuration."""
    return sources.agg(F.array_sort(F.collect_list(
        F.struct("position", SOURCE, "available", "weight"))).alias("s"))


def _shares(sources: Column, normalise: bool) -> Column:
    """The sources with their share of all weights; equal ones when all weights are zero."""
    def shared(total: Column) -> Column:
        def share(x: Column) -> Column:
            if not normalise:
                return x["weight"]
            return F.when(total == 0, F.lit(1.0) / F.size(sources)).otherwise(x["weight"] / total)

        return F.transform(sources, lambda x: F.struct(
            share(x).alias("share"), (-x["position"]).alias("order"), x[SOURCE].alias(SOURCE),
            x["available"].alias("available")))

    return bind(F.aggregate(sources, F.lit(0.0), lambda t, x: t + x["weight"]), shared)


def normalised_weights(sources: DataFrame) -> DataFrame:
    """Weights over the loaded sources; equal when all are zero."""
    return _listed(sources).select(F.inline(_shares(F.col("s"), True))).select(
        SOURCE, "available", "share")


def allocate_weighted(sources: DataFrame, n: int, normalise: bool = True) -> DataFrame:
    """Rows per source: floor(n * share), remainder to the heaviest, capped.

    A shortfall of a small source is not given to the others.  Shares, remainder and
    heaviest source come from one array, so the counts are read once.
    """
    whole = F.lit(n).cast("bigint")

    def floor(x: Column) -> Column:
        return F.floor(whole * x["share"]).cast("bigint")

    def allocated(rated: Column) -> Column:
        given = F.aggregate(rated, F.lit(0).cast("bigint"), lambda t, x: t + floor(x))
        rest = F.greatest(F.lit(0).cast("bigint"), whole - given)
        return bind(F.struct(rest.alias("rest"), F.array_max(rated).alias("heaviest")), lambda f: F.transform(
            rated, lambda x: F.struct(
                x[SOURCE].alias(SOURCE), x["share"].alias("share"), x["available"].alias("available"),
                (floor(x) + F.when(x["order"] == f["heaviest"]["order"], f["rest"]).otherwise(0))
                .alias("wanted"))))

    out = _listed(sources).select(F.inline(bind(_shares(F.col("s"), normalise), allocated)))
    return out.withColumn("quota", F.least("wanted", "available"))


def allocate_equal(sources: DataFrame, n: int) -> DataFrame:
    """n div k rows per source, one more for the first n mod k, capped.

    The source list is a configuration list, so numbering it in one array is
    bounded by that list.
    """
    numbered = _listed(sources).select(F.size("s").cast("bigint").alias("k"), F.posexplode("s"))
    extra = F.when(F.col("pos") < F.lit(n) % F.col("k"), F.lit(1)).otherwise(F.lit(0))
    wanted = (F.call_function("div", F.lit(n).cast("bigint"), F.col("k")) + extra).cast("bigint")
    available = F.col("col.available")
    return numbered.select(F.col(f"col.{SOURCE}").alias(SOURCE), available.alias("available"),
                           wanted.alias("wanted"), F.least(wanted, available).alias("quota"))


def mix(conversations: DataFrame, weights: Mapping[str, float], n: int, seed: int,
        strategy: str = "weighted", normalise: bool = True, key: str = "conversation_id",
        ordered: bool = False) -> DataFrame:
    """Sample every source to its allocation; ``ordered`` also shuffles rows."""
    sources = with_available(source_table(conversations.sparkSession, weights), conversations)
    if strategy == "weighted":
        quotas = allocate_weighted(sources, n, normalise)
    elif strategy == "equal":
        quotas = allocate_equal(sources, n)
    else:
        raise ValueError(f"unknown sampling strategy: {strategy}")
    out = stratified_sample(conversations, SOURCE, [key], seed, quotas=quotas, salt="mix")
    return shuffled(out, seed, [key]) if ordered else out


def concat_sources(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Union of datasets with different columns, tagged by source."""
    if not frames:
        raise ValueError("no source datasets could be loaded")
    tagged = [df.withColumn(SOURCE, F.lit(name)) for name, df in frames.items()]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def _default(name: str, kind: str) -> Column:
    if name in JSON_LIST_COLUMNS:
        return F.lit("[]")
    return {"bigint": F.lit(0).cast("bigint"), "double": F.lit(0.0)}.get(kind, F.lit(""))


def align_schema(df: DataFrame, mode: str = "union", frames: Mapping[str, DataFrame] | None = None,
                 parity: bool = False, new_id: Column | None = None) -> DataFrame:
    """Bring a concatenation to one schema.

    ``union`` keeps all columns and adds every known optional one; gaps get
    defaults row by row (with ``parity`` only columns missing everywhere do).
    ``intersection`` keeps the standard columns plus the optional ones present
    in every source (with ``parity`` those present in the concatenation).
    ``new_id`` fills a missing conversation id.
    """
    def fill(name: str, kind: str) -> Column:
        default = (new_id if name == "conversation_id" and new_id is not None
                   else _default(name, kind))
        if name not in df.columns:
            return default.cast(kind).alias(name)
        if parity:
            return F.col(name)
        return F.coalesce(F.col(name), default.cast(dict(df.dtypes)[name])).alias(name)

    standard = [fill(n, k) for n, k in STANDARD_COLUMNS.items()]
    if mode == "union":
        optional = [fill(n, k) for n, k in OPTIONAL_COLUMNS.items()]
        known = STANDARD_COLUMNS.keys() | OPTIONAL_COLUMNS.keys()
        return df.select(*standard, *optional, *[c for c in df.columns if c not in known])
    if mode == "intersection":
        common = [c for c in OPTIONAL_COLUMNS if c in df.columns]
        if frames is not None and not parity:
            common = [c for c in common if all(c in f.columns for f in frames.values())]
        return df.select(*standard, *common)
    raise ValueError(f"unknown schema mode {mode!r}")
