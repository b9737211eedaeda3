"""Payload score: relative prefill and decode effort of a dataset."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from palaver.functions.text import normalise

# Reference maxima, weights and shares of the score.
PREFILL_MAX = {"total_tokens": 10_000_000, "avg_context_size": 50_000,
               "multimodal_penalty": 2.0, "context_growth": 10.0}
DECODE_MAX = {"total_response_tokens": 5_000_000, "num_turns": 10_000,
              "avg_response_length": 50, "tool_call_penalty": 10.0}
PREFILL_WEIGHTS = {"total_tokens": 0.4, "avg_context_size": 0.3,
                   "multimodal_penalty": 0.2, "context_growth": 0.1}
DECODE_WEIGHTS = {"total_response_tokens": 0.4, "num_turns": 0.3,
                  "avg_response_length": 0.2, "tool_call_penalty": 0.1}
DEFAULT_WEIGHT = 0.25
MULTIMODAL_TYPES = ("pdf", "image")
MULTIMODAL_PENALTY = 1.5
TOOL_CALL_PENALTY = 0.1
RESPONSE_SHARE = 0.4

# Sums of ratios are kept as decimals: exact, so independent of the order in
# which partitions are merged.
RATIO = "decimal(28,12)"


def additive_inputs(has_tools: bool = True) -> dict[str, Column]:
    """Per-conversation terms whose sums determine the score."""
    zero = F.lit(0).cast("bigint")
    return {
        "n": F.lit(1).cast("bigint"),
        "tokens": F.col("estimated_tokens"),
        "chars": F.col("total_characters"),
        "turns": F.col("num_turns"),
        "ratios": F.coalesce(F.col("growth_ratio").cast(RATIO), F.lit(0).cast(RATIO)),
        "ratio_n": F.when(F.col("growth_ratio").isNotNull(), F.lit(1)).otherwise(F.lit(0))
                    .cast("bigint"),
        "tools": F.col("num_tool_calls") if has_tools else zero,
    }


def raw_factors(sums: Mapping[str, Column], dataset_type: Column,
                ) -> tuple[dict[str, Column], dict[str, Column]]:
    """Raw prefill and decode factors from additive sums."""
    n = sums["n"]
    growth = F.coalesce(F.try_divide(sums["ratios"].cast("double"),
                                     sums["ratio_n"].cast("double")), F.lit(0.0))
    zero = F.lit(0.0)
    prefill = {
        "total_tokens": sums["tokens"].cast("double"),
        "avg_context_size": F.coalesce(F.try_divide(sums["chars"].cast("double"),
                                                    n.cast("double")), zero),
        "multimodal_penalty": F.when(dataset_type.isin(*MULTIMODAL_TYPES),
                                     F.lit(MULTIMODAL_PENALTY)).otherwise(zero),
        "context_growth": growth,
    }
    decode = {
        "total_response_tokens": sums["tokens"] * F.lit(RESPONSE_SHARE),
        "num_turns": sums["turns"].cast("double"),
        "avg_response_length": F.coalesce(F.try_divide(sums["turns"].cast("double"),
                                                       n.cast("double")), zero),
        "tool_call_penalty": F.when(dataset_type == "agentic",
                                    sums["tools"] * F.lit(TOOL_CALL_PENALTY)).otherwise(zero),
    }
    return prefill, decode


def weighted_score(factors: Mapping[str, Column], maxima: Mapping[str, float],
                   weights: Mapping[str, float]) -> Column:
    score = F.lit(0.0)
    for name, raw in factors.items():
        score = score + normalise(raw, maxima.get(name, 1.0)) * F.lit(
            float(weights.get(name, DEFAULT_WEIGHT)))
    return score


def score_columns(sums: Mapping[str, Column], dataset_type: Column,
                  prefill_weights: Mapping[str, float] = PREFILL_WEIGHTS,
                  decode_weights: Mapping[str, float] = DECODE_WEIGHTS,
                  balance: float = 0.5) -> dict[str, Column]:
    """Unrounded prefill, decode and total score expressions."""
    prefill, decode = raw_factors(sums, dataset_type)
    p = weighted_score(prefill, PREFILL_MAX, prefill_weights)
    q = weighted_score(decode, DECODE_MAX, decode_weights)
    total = p * F.lit(balance) + q * F.lit(1.0 - balance)
    return {"prefill_score": p, "decode_score": q, "total_payload_score": total}


def payload_sums(conversations: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Additive inputs per group: one combinable aggregate."""
    inputs = additive_inputs("num_tool_calls" in conversations.columns)
    return conversations.groupBy(*keys).agg(
        *[F.sum(column).alias(name) for name, column in inputs.items()])


def payload_scores(conversations: DataFrame, key: str = "dataset_type",
                   kind: Column | None = None, breakdown: bool = True, **options) -> DataFrame:
    """Scores per dataset, with raw factors and their normalised values.

    ``kind`` is the family a group is scored as, an expression over ``key``
    (a literal scores a mixture as one family); by default the key itself.
    """
    sums = payload_sums(conversations, [key])
    cols = {name: F.col(name) for name in
            ("n", "tokens", "chars", "turns", "ratios", "ratio_n", "tools")}
    kind = F.col(key) if kind is None else kind
    out = [F.col(key), F.col("n").alias("conversations")]
    out += [c.alias(n) for n, c in score_columns(cols, kind, **options).items()]
    if breakdown:
        prefill, decode = raw_factors(cols, kind)
        for side, factors, maxima in (("prefill", prefill, PREFILL_MAX),
                                      ("decode", decode, DECODE_MAX)):
            for name, raw in factors.items():
                out.append(raw.alias(f"{side}_{name}"))
                out.append(normalise(raw, maxima[name]).alias(f"{side}_{name}_norm"))
    return sums.select(*out)


def ranked_payloads(conversations: DataFrame, key: str = "dataset_type", **options) -> DataFrame:
    """Datasets by total payload, heaviest first."""
    return (payload_scores(conversations, key, **options)
            .orderBy(F.desc("total_payload_score"), key))
