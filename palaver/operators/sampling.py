"""Seeded sampling without replacement, exact in size and free of global sorts.

Rows are ordered by a seeded draw over their id.  An exact sample is then all
rows up to a cut-off: bucket counts locate the bucket in which the wanted rank
falls, bucket within bucket until few rows are left to rank, and the rows
themselves are filtered where they lie - they are not shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from palaver.functions.draws import draw
from palaver.operators.payload import additive_inputs, score_columns
from palaver.operators.scan import hash_bucket, join_groups, prefix_sums

MIN_BALANCED_ROWS = 10
#: Bits of a draw by which its rows are counted, and those of the bucket that holds a rank.
DIGITS = (12, 20)


def sample_cutoffs(df: DataFrame, ids: Sequence[str], seed: int, by: Sequence[str] = (),
                   n: int | None = None, quotas: DataFrame | None = None,
                   salt: str = "sample", digits: Sequence[int] = DIGITS) -> DataFrame:
    """``(by..., cut)``: the last kept ``(draw, ids)`` of every stratum.

    Strata with fewer rows than wanted have no row here; they are kept whole.
    ``quotas`` holds ``by`` columns and ``quota``; otherwise every stratum
    gets ``n``.

    The rank is found digit by digit (``digits`` are their bits, leading ones first): rows
    are counted by the first digit of their draw, those with the digit that holds the
    rank by the next, and so on.  With all 32 bits in use the rows ranked in the end
    share one draw: a 4,000-millionth of the stratum.
    """
    path = list(by)
    rows = df.select(*by, *ids, draw(seed, salt, *[F.col(i) for i in ids]).alias("_d"))
    shift = 32
    for level, width in enumerate(digits):
        digit, shift = f"_b{level}", shift - width
        rows = rows.withColumn(digit, F.pmod(F.shiftright("_d", shift), F.lit(1 << width)))
        wanted = [] if level == 0 else [F.max("_left").alias("_left")]
        counts = rows.groupBy(*path, digit).agg(F.count(F.lit(1)).alias("_nb"), *wanted)
        if level == 0 and quotas is not None:
            counts = join_groups(counts, quotas.select(*by, F.col("quota").alias("_left")), by)
        elif level == 0:
            counts = counts.withColumn("_left", F.lit(n).cast("bigint"))
        along = Window.partitionBy(*path).orderBy(digit).rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("_nb").over(along), F.lit(0))
        path = [*path, digit]
        edge = (counts.withColumn("_left", F.col("_left") - before)
                .filter((F.col("_left") > 0) & (F.col("_left") <= F.col("_nb"))).select(*path, "_left"))
        rows = join_groups(rows.select(*by, *ids, "_d", *path[len(by):]), edge, path)
    inside = Window.partitionBy(*path).orderBy("_d", *ids)
    return (rows.withColumn("_rn", F.row_number().over(inside)).filter(F.col("_rn") == F.col("_left"))
            .select(*by, F.struct("_d", *ids).alias("cut")))


def exact_sample(df: DataFrame, n: int, ids: Sequence[str], seed: int,
                 salt: str = "sample") -> DataFrame:
    """Exactly ``n`` rows (all rows when there are fewer)."""
    if n <= 0:
        return df.filter(F.lit(False))
    cut = sample_cutoffs(df, ids, seed, n=n, salt=salt)
    here = F.struct(draw(seed, salt, *[F.col(i) for i in ids]).alias("_d"), *ids)
    last = cut.select("cut").scalar()
    return df.filter(last.isNull() | (here <= last))


def stratified_sample(df: DataFrame, by: str, ids: Sequence[str], seed: int,
                      k: int | None = None, quotas: DataFrame | None = None,
                      salt: str = "sample") -> DataFrame:
    """Up to ``k`` rows per stratum, or a quota per stratum.

    Strata without a quota row, or with quota zero, give no rows; rows without
    a stratum (NULL) are a stratum of their own.  The cut-offs (one row per stratum) are computed first, so that the rows can be
    filtered where they lie.
    """
    cuts = sample_cutoffs(df, ids, seed, [by], k, quotas, salt)
    if quotas is not None:
        cuts = join_groups(quotas.filter(F.col("quota") > 0).select(by), cuts, [by], "left")
        joined = join_groups(df, cuts, [by])
    else:
        joined = join_groups(df, cuts, [by], "left")
    here = F.struct(draw(seed, salt, *[F.col(i) for i in ids]).alias("_d"), *ids)
    return joined.filter(F.col("cut").isNull() | (here <= F.col("cut"))).drop("cut")


def shuffled(df: DataFrame, seed: int, ids: Sequence[str], salt: str = "order") -> DataFrame:
    """Rows in a seeded order (a range-partitioned sort)."""
    return df.orderBy(draw(seed, salt, *[F.col(i) for i in ids]), *ids)


def prefix_scores(conversations: DataFrame, ids: Sequence[str], seed: int,
                  key: str = "dataset_type", salt: str = "balance", **options) -> DataFrame:
    """Payload score of every prefix of the seeded order, per dataset.

    Every score input is a sum, so one running-sum pass scores all sample
    sizes at once.
    """
    inputs = additive_inputs("num_tool_calls" in conversations.columns)
    rows = conversations.select(
        key, *ids, draw(seed, salt, *[F.col(i) for i in ids]).alias("_d"),
        *[column.alias(f"in_{name}") for name, column in inputs.items()])
    running = prefix_sums(rows, [key], hash_bucket("_d"), ["_d", *ids],
                          {name: F.col(f"in_{name}") for name in inputs},
                          totals={"rows": "n"})
    scores = score_columns({name: F.col(name) for name in inputs}, F.col(key), **options)
    return running.select(key, *ids, "_d", F.col("n").alias("size"), "rows",
                          scores["total_payload_score"].alias("score"))


def balanced_sizes(conversations: DataFrame, target: float, ids: Sequence[str], seed: int,
                   key: str = "dataset_type", tolerance: float = 0.05,
                   **options) -> DataFrame:
    """Sample size per dataset whose total score is nearest to ``target``.

    Sizes start at ten rows (or all rows of a smaller dataset); the smallest
    size wins among equally near ones.  ``cut`` is the last row of the sample.
    """
    scored = prefix_scores(conversations, ids, seed, key, **options)
    diff = F.abs(F.col("score") - F.lit(target))
    rated = (scored.filter(F.col("size") >= F.least(F.lit(MIN_BALANCED_ROWS), F.col("rows")))
             .withColumn("difference", diff))
    best = F.min_by(F.struct("size", "rows", "score", "difference",
                             F.struct("_d", *ids).alias("cut")),
                    F.struct(F.round("difference", 9), "size"))
    return (rated.groupBy(key).agg(best.alias("b")).select(key, "b.*")
            .withColumn("within_tolerance", F.col("difference") <= tolerance))


def balanced_subset(conversations: DataFrame, target: float, ids: Sequence[str], seed: int,
                    key: str = "dataset_type", salt: str = "balance", **options) -> DataFrame:
    """The rows of the payload-balanced sample of every dataset."""
    sizes = balanced_sizes(conversations, target, ids, seed, key, salt=salt, **options)
    here = F.struct(draw(seed, salt, *[F.col(i) for i in ids]).alias("_d"), *ids)
    return (conversations.join(sizes.select(key, "cut"), [key])
            .filter(here <= F.col("cut")).drop("cut"))

