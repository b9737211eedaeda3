"""Profiles that merge: sketches beside exact sums.

A profile row holds, for each metric, exact count, total, extremes and squared
deviations, and a KLL sketch of the values; for each column whose distinct values
are wanted, an HLL sketch.  Profiles of parts (days, files, sources) merge to that of
the whole without reading rows again, so they can be stored next to a manifest.

Quantiles from sketches are approximate: their rank is off by at most
:func:`rank_error` of the rows with 99 % confidence, whatever the distribution.  Distinct counts
have a relative standard error of :func:`distinct_error`.  The sizes ``k`` and ``lg_k`` are the
caller's choice and hold for every size of input; exact figures are those of
``distribution``.  NULL values count nowhere; a metric without values has NULL statistics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

K = 800
LG_K = 14


def rank_error(k: int = K) -> float:
    """Largest difference of a rank, as a share of the rows (99 % confidence)."""
    return 2.446 / k ** 0.9433


def distinct_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a distinct count."""
    return 1.04 / 2 ** (lg_k / 2)


def sketch_profile(df: DataFrame, keys: Sequence[str], metrics: Sequence[str],
                   distinct: Sequence[str] = (), k: int = K, lg_k: int = LG_K) -> DataFrame:
    """One row per key with a struct per metric and a sketch per distinct column (``distinct_<name>``).

    All is one combined aggregate; a part's state has a fixed size.
    """
    aggregates = []
    for metric in metrics:
        value = F.col(metric).cast("double")
        n = F.count(value)
        aggregates.append(F.struct(
            n.alias("n"), F.sum(value).alias("total"), F.min(value).alias("min"),
            F.max(value).alias("max"), (F.var_pop(value) * n).alias("deviations"),
            F.kll_sketch_agg_double(value, k).alias("sketch")).alias(metric))
    for column in distinct:
        aggregates.append(F.hll_sketch_agg(column, lg_k).alias(f"distinct_{column}"))
    return df.groupBy(*keys).agg(*aggregates)


def _metrics(profiles: DataFrame, keys: Sequence[str]) -> tuple[list[str], list[str]]:
    rest = [c for c in profiles.columns if c not in keys]
    sketches = [c for c in rest if c.startswith("distinct_")]
    return [c for c in rest if c not in sketches], sketches


def merge_profiles(profiles: DataFrame, keys: Sequence[str], parts: Sequence[str] = ()) -> DataFrame:
    """Profiles of ``keys`` from profiles of finer ones; ``parts`` are keys that go."""
    metrics, sketches = _metrics(profiles, [*keys, *parts])
    aggregates = []
    for metric in metrics:
        m = F.col(metric)
        n, total = F.sum(m["n"]), F.sum(m["total"])
        between = F.sum(F.try_divide(m["total"] * m["total"], m["n"])) - F.try_divide(total * total, n)
        aggregates.append(F.struct(
            n.alias("n"), total.alias("total"), F.min(m["min"]).alias("min"), F.max(m["max"]).alias("max"),
            (F.sum(m["deviations"]) + F.greatest(between, F.lit(0.0))).alias("deviations"),
            F.kll_merge_agg_double(m["sketch"]).alias("sketch")).alias(metric))
    aggregates += [F.hll_union_agg(c).alias(c) for c in sketches]
    return profiles.groupBy(*keys).agg(*aggregates)


def profile_values(profiles: DataFrame, keys: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """``(keys, metric, n, total, min, max, mean, stdev, quantiles)`` with an array of quantiles."""
    metrics, _ = _metrics(profiles, keys)
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])

    def row(metric: str) -> Column:
        m = F.col(metric)
        stdev = F.when(m["n"] > 0, F.coalesce(
            F.sqrt(F.try_divide(m["deviations"], m["n"] - 1)), F.lit(0.0)))
        return F.struct(
            F.lit(metric).alias("metric"), m["n"].alias("n"), m["total"].alias("total"),
            m["min"].alias("min"), m["max"].alias("max"),
            F.try_divide(m["total"], m["n"]).alias("mean"), stdev.alias("stdev"),
            F.when(m["n"] > 0, F.kll_sketch_get_quantile_double(m["sketch"], wanted)).alias("quantiles"))

    return profiles.select(*keys, F.inline(F.array(*[row(m) for m in metrics])))


def distinct_values(profiles: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, column, distinct)``: estimated distinct counts."""
    _, sketches = _metrics(profiles, keys)
    rows = [F.struct(F.lit(c.removeprefix("distinct_")).alias("column"),
                     F.hll_sketch_estimate(c).alias("distinct")) for c in sketches]
    return profiles.select(*keys, F.inline(F.array(*rows)))
