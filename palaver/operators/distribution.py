"""Exact distribution statistics over value counts.

``value_counts`` is the only step that reads rows; it combines on the map side,
so a hot group costs no more than its number of distinct values.  Quantiles,
histograms and frequency tables then work on that small table.  Rows whose key
is NULL are a group of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from palaver.functions.text import share
from palaver.operators.scan import join_groups

# Reported percentiles, and the turn-count buckets.
PERCENTILES = (0.05, 0.25, 0.50, 0.75, 0.95, 0.99)
TURN_BUCKETS = (
    ("short (1-5)", None, 5),
    ("medium (6-15)", 5, 15),
    ("long (16-30)", 15, 30),
    ("very_long (31+)", 30, None),
)

#: Equal parts into which a bucket that holds a wanted rank is cut, and how often.
SPLITS = 1 << 20
ROUNDS = 1


def value_counts(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """``(keys, metric, value, n)`` for several numeric columns in one shuffle.

    NULL metrics are left out.
    """
    return _long(df, keys, metrics).groupBy(*keys, "metric", "value").agg(
        F.count(F.lit(1)).alias("n"))


def _long(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """``(keys, metric, value)`` without NULL values."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"),
                               F.col(m).cast("double").alias("value")) for m in metrics])
    return df.select(*keys, F.inline(pairs)).filter(F.col("value").isNotNull())


def _magnitude_bucket(value: Column) -> Column:
    """A bucket number that never decreases with the value.

    Its width is about 0.2 % of the value, which bounds the buckets of a group
    by the logarithm of its range, whatever the distribution looks like.
    """
    return F.coalesce(F.signum(value) * F.floor(F.log1p(F.abs(value)) * F.lit(512.0)), F.lit(0.0))


def _bucket_facts(work: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows, cells (an upper bound of distinct values) and range of every bucket."""
    return work.groupBy(*by).agg(
        F.sum("n").alias("_nb"), F.count(F.lit(1)).alias("_cells"),
        F.min("value").alias("_min"), F.max("value").alias("_max"))


def _ranked_buckets(work: DataFrame, keys: Sequence[str],
                    probabilities: Sequence[float]) -> DataFrame:
    """Magnitude buckets that hold a wanted rank, with the ranks they hold (``_probes``)."""
    keys = list(keys)
    along = Window.partitionBy(*keys).orderBy("_b0")
    ranked = _bucket_facts(work, [*keys, "_b0"]).select(
        "*", F.coalesce(F.sum("_nb").over(along.rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0)).alias("_before"),
        F.sum("_nb").over(along.rowsBetween(Window.unboundedPreceding,
                                            Window.unboundedFollowing)).alias("_total"))
    probes = F.transform(F.array(*[F.lit(float(p)) for p in probabilities]), lambda p: F.struct(
        p.alias("p"), ((F.col("_total") - 1) * p).alias("_pos"),
        F.floor((F.col("_total") - 1) * p).alias("_lo"),
        F.ceil((F.col("_total") - 1) * p).alias("_hi")))
    return _holding(ranked.withColumn("_probes", probes), [*keys, "_b0"])


def _holding(ranked: DataFrame, by: Sequence[str]) -> DataFrame:
    """Buckets that hold a rank of ``_probes``, with these only."""
    first, end = F.col("_before"), F.col("_before") + F.col("_nb")
    held = F.filter("_probes", lambda x: (x["_hi"] >= first) & (x["_lo"] < end))
    return (ranked.select(*by, "_before", "_cells", "_min", "_max", held.alias("_probes"))
            .filter(F.size("_probes") > 0))


def _split(work: DataFrame, wanted: DataFrame, by: Sequence[str], name: str
           ) -> tuple[DataFrame, DataFrame]:
    """Cells of ``wanted`` buckets with their part of the bucket's range, and the wanted parts.

    A bucket's own minimum and maximum are cut into ``SPLITS`` equal parts.
    """
    bounds = wanted.select(*by, "_before", "_probes", F.col("_min").alias("_from"),
                           F.col("_max").alias("_to"))
    place = F.floor((F.col("value") - F.col("_from")) / (F.col("_to") - F.col("_from")) * SPLITS)
    part = F.when(F.col("_to") > F.col("_from"), F.least(F.lit(SPLITS - 1), place)).otherwise(0)
    inside = join_groups(work, bounds, by).withColumn(name, part.cast("bigint"))
    # The bucket's rank and probes are the same in all its cells.
    facts = inside.groupBy(*by, name).agg(
        F.sum("n").alias("_nb"), F.count(F.lit(1)).alias("_cells"), F.min("value").alias("_min"),
        F.max("value").alias("_max"), F.first("_before").alias("_before"),
        F.first("_probes").alias("_probes"))
    earlier = Window.partitionBy(*by).orderBy(name).rowsBetween(Window.unboundedPreceding, -1)
    ranked = facts.withColumn("_before", F.col("_before") + F.coalesce(
        F.sum("_nb").over(earlier), F.lit(0)))
    return inside.drop("_before", "_probes", "_from", "_to"), _holding(ranked, [*by, name])


def _cells(work: DataFrame, wanted: DataFrame, keys: Sequence[str], by: Sequence[str],
           rows: bool) -> DataFrame:
    """Distinct values of the wanted buckets with the ranks they cover, once for each probe."""
    if rows:
        work = (join_groups(work, wanted.select(*by), by, "left_semi")
                .groupBy(*by, "value").agg(F.sum("n").alias("n")))
    inside = Window.partitionBy(*by).orderBy("value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (join_groups(work, wanted.select(*by, "_before", "_probes"), by)
            .withColumn("_end", F.col("_before") + F.sum("n").over(inside))
            .withColumn("_start", F.col("_end") - F.col("n"))
            .select(*keys, "value", "_start", "_end", F.inline("_probes")))


def _exact(work: DataFrame, keys: Sequence[str], probabilities: Sequence[float],
           rows: bool, rounds: int = ROUNDS) -> DataFrame:
    """Locate the wanted ranks by ranges that get narrower, then rank what is in them.

    The magnitude bucket that holds a rank is cut by its own range, and so on for
    ``rounds``.  A bucket holds 2 ** 43 doubles at most (those nearest to zero apart), so
    parts of the first round hold 2 ** 23 at most, or a millionth of a bucket's evenly
    spread values.
    """
    keys, by = list(keys), [*keys, "_b0"]
    work = work.withColumn("_b0", _magnitude_bucket(F.col("value")))
    located = _ranked_buckets(work, keys, probabilities)
    for number in range(1, rounds + 1):
        work, located = _split(work, located, by, f"_b{number}")
        by = [*by, f"_b{number}"]
    cells = _cells(work, located, keys, by, rows)

    def at(rank: str) -> Column:
        return F.max(F.when((F.col("_start") <= F.col(rank)) & (F.col(rank) < F.col("_end")),
                            F.col("value")))

    picked = cells.groupBy(*keys, "p", "_pos", "_lo", "_hi").agg(
        at("_lo").alias("_v_lo"), at("_hi").alias("_v_hi"))
    value = F.when(F.col("_lo") == F.col("_hi"), F.col("_v_lo")).otherwise(
        F.col("_v_lo") * (F.col("_hi") - F.col("_pos"))
        + F.col("_v_hi") * (F.col("_pos") - F.col("_lo")))
    return picked.select(*keys, "p", value.alias("value"))


def quantiles(counts: DataFrame, keys: Sequence[str],
              probabilities: Sequence[float], rounds: int = ROUNDS) -> DataFrame:
    """Exact linear-interpolated quantiles of value counts: ``(keys, p, value)``.

    ``rounds`` cuts a bucket again that many times; it changes no result.
    """
    return _exact(counts, keys, probabilities, False, rounds)


def row_quantiles(df: DataFrame, keys: Sequence[str], metrics: Sequence[str],
                  probabilities: Sequence[float], rounds: int = ROUNDS) -> DataFrame:
    """The same for columns with hardly any repeated values.

    Value counts of such a column are as large as the column.  Here the rows
    are read again for each narrower range and only those in a wanted one are shuffled.
    """
    rows = _long(df, keys, metrics).withColumn("n", F.lit(1).cast("bigint"))
    return _exact(rows, [*keys, "metric"], probabilities, True, rounds)


def medians(counts: DataFrame, keys: Sequence[str], name: str = "median") -> DataFrame:
    return quantiles(counts, keys, [0.5]).select(*keys, F.col("value").alias(name))


def histogram(counts: DataFrame, keys: Sequence[str], bins: Column | int) -> DataFrame:
    """Equal-width bins: ``(keys, bin, edge_lo, edge_hi, count)``.

    The last bin is closed, a group with one value has one bin, empty bins are
    kept.  ``bins`` may use the columns ``lo`` and ``hi`` of the group.
    """
    keys = list(keys)
    wanted = bins if isinstance(bins, Column) else F.lit(bins)
    # The row total keeps this an aggregate of the counts: minimum and maximum
    # alone would be taken from the rows in a second scan.
    bounds = (counts.groupBy(*keys)
              .agg(F.min("value").alias("lo"), F.max("value").alias("hi"),
                   F.sum("n").alias("_rows"))
              .filter(F.col("_rows") > 0).drop("_rows")
              .withColumn("k", F.when(F.col("lo") == F.col("hi"), F.lit(1))
                          .otherwise(wanted).cast("bigint"))
              .withColumn("w", (F.col("hi") - F.col("lo")) / F.col("k")))
    lo, w, k, v = F.col("lo"), F.col("w"), F.col("k"), F.col("value")
    guess = F.when(w > 0, F.floor((v - lo) / w)).otherwise(F.lit(0)).cast("bigint")
    # Bins are defined by comparing with the edges, so correct a rounded guess.
    fixed = (F.when(v < lo + guess * w, guess - 1)
             .when(v >= lo + (guess + 1) * w, guess + 1).otherwise(guess))
    binned = (join_groups(counts, bounds, keys)
              .withColumn("bin", F.greatest(F.lit(0), F.least(k - 1, fixed)))
              .groupBy(*keys, "bin").agg(F.sum("n").alias("count")))
    frame = bounds.withColumn("bin", F.explode(F.sequence(F.lit(0).cast("bigint"), k - 1)))
    return (join_groups(frame, binned, [*keys, "bin"], "left")
            .select(*keys, "bin", (lo + F.col("bin") * w).alias("edge_lo"),
                    (lo + (F.col("bin") + 1) * w).alias("edge_hi"),
                    F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def frequency(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Count and percentage per value: ``(keys, value, count, percentage)``."""
    counted = df.groupBy(*keys, F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("count"))
    return with_share(counted, keys)


def with_share(counted: DataFrame, keys: Sequence[str], count: str = "count",
               name: str = "percentage") -> DataFrame:
    """Percentage of the key's total, over already aggregated rows.

    The totals are an aggregate joined back, so a column with very many
    values is not gathered into one window partition.
    """
    keys = list(keys)
    if not keys:
        whole = counted.agg(F.sum(count).alias("_whole"))
        return counted.withColumn(name, share(F.col(count), whole.scalar()))
    totals = counted.groupBy(*keys).agg(F.sum(count).alias("_whole"))
    return (join_groups(counted, totals, keys)
            .withColumn(name, share(F.col(count), F.col("_whole"))).drop("_whole"))


def ranges(df: DataFrame, keys: Sequence[str], labelled: Sequence[tuple[str, Column]]) -> DataFrame:
    """Counts of fixed conditions, zero counts kept: ``(keys, range_no, range, count, percentage)``.

    All conditions are counted in one aggregate and unpivoted afterwards, so
    there is no join and a hot group combines on the map side.
    """
    keys = list(keys)
    counted = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_all"),
        *[F.count_if(test).alias(f"_c{i}") for i, (_, test) in enumerate(labelled)])
    rows = F.array(*[F.struct(F.lit(i).cast("bigint").alias("range_no"), F.lit(label).alias("range"),
                              F.col(f"_c{i}").alias("count"))
                     for i, (label, _) in enumerate(labelled)])
    return (counted.select(*keys, "_all", F.inline(rows))
            .withColumn("percentage", share(F.col("count"), F.col("_all"))).drop("_all"))


def turn_bucket_tests(column: str = "num_turns") -> list[tuple[str, Column]]:
    """Label and condition of every turn-count bucket."""
    tests = []
    for label, above, upto in TURN_BUCKETS:
        test = F.lit(True)
        if above is not None:
            test = test & (F.col(column) > above)
        if upto is not None:
            test = test & (F.col(column) <= upto)
        tests.append((label, test))
    return tests


def turn_buckets(df: DataFrame, keys: Sequence[str], column: str = "num_turns") -> DataFrame:
    return ranges(df, keys, turn_bucket_tests(column))


def moments(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """n, total, min, max, mean and stdev from value counts.

    ``stdev`` is the sample deviation, 0.0 for a single row; it is summed
    around the mean in a second pass over the small table.
    """
    keys = list(keys)
    n, v = F.col("n"), F.col("value")
    stats = (counts.groupBy(*keys).agg(
        F.sum(n).alias("_n"), F.sum(v * n).alias("total"), F.min(v).alias("min"),
        F.max(v).alias("max")).withColumnRenamed("_n", "n")
        .withColumn("mean", F.col("total") / F.col("n")))
    around = join_groups(counts.withColumnRenamed("n", "_n"), stats.select(*keys, "n", "mean"), keys)
    spread = around.groupBy(*keys, "n").agg(
        F.sum(F.col("_n") * (v - F.col("mean")) * (v - F.col("mean"))).alias("_ss"))
    spread = spread.select(*keys, F.coalesce(F.sqrt(F.try_divide(F.col("_ss"), n - 1)),
                                             F.lit(0.0)).alias("stdev"))
    return join_groups(stats, spread, keys)


def summary_from_counts(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The moments and the median."""
    return join_groups(moments(counts, keys), medians(counts, keys), keys)


def numeric_summary(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Long summary per metric: n, total, min, max, mean, median, stdev."""
    return summary_from_counts(value_counts(df, keys, metrics), [*keys, "metric"])
