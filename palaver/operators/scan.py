"""Ordered scans (running sums, neighbours, ranks) that survive a hot key.

A window over ``partitionBy(key)`` puts a whole key into one task.  Here each
key is cut into buckets along its order, so the large window is partitioned by
``(key, bucket)``; only one pre-aggregated row per bucket is scanned per key.
Keys that fit into one bucket get no offset row at all.

The rows are shuffled once.  The per-bucket totals are computed from the same
exchange as the window: both branches read the same columns after an explicit
repartition, which lets Spark reuse the exchange instead of scanning the
source twice.  So pass in only columns that the result needs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from palaver.functions.text import floor_div

TURN_BLOCK = 1024
HASH_BITS = 12


def turn_bucket(order: str = "turn", block: int = TURN_BLOCK) -> Column:
    """Bucket of an integer position: at most ``block`` positions each."""
    return floor_div(F.col(order), block)


def hash_bucket(drawn: str, bits: int = HASH_BITS) -> Column:
    """Bucket of a 32-bit draw: its leading ``bits`` bits."""
    return F.shiftright(F.col(drawn), 32 - bits).cast("bigint")


def with_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that have a key; a row without one belongs to no group."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str],
                how: str = "inner") -> DataFrame:
    """Join on keys where NULL is a group like any other; keys come from ``left``."""
    names = {k: f"_right_{k}" for k in keys}
    other = right.select(*[F.col(k).alias(n) for k, n in names.items()],
                         *[c for c in right.columns if c not in names])
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()]
    return left.join(other, same, how).drop(*names.values())


def _read_all(columns: Sequence[str]) -> Column:
    """A count that refers to every column, so that none is pruned."""
    total = F.count(F.lit(1))
    for column in columns:
        total = total + F.count(F.col(column))
    return total


def prefix_sums(df: DataFrame, keys: Sequence[str], bucket: Column,
                order: Sequence[str], sums: Mapping[str, Column],
                totals: Mapping[str, str] | None = None,
                bucket_name: str = "_bkt", buckets: str | None = None,
                whole_keys: bool = False) -> DataFrame:
    """Add inclusive running sums of ``sums`` per key along ``order``.

    ``bucket`` must not decrease along ``order``.  ``totals`` maps new column
    names to entries of ``sums`` whose whole-key total is wanted on every row.
    The bucket column stays in the result (``bucket_name``): further windows
    over ``(keys, bucket)`` need no shuffle.  ``buckets`` names a column for the
    number of buckets of the key.  With ``whole_keys`` rows are dealt by key
    alone, for results that need the rows of a key together anyway; each key is
    then one scan, so rows that come dealt by key are made only once.  Keys must
    not be NULL; rows without a key are left out.
    """
    totals = dict(totals or {})
    keys = list(keys)
    if whole_keys and not buckets:
        rows = with_key(df, keys).repartition(*keys).withColumn(bucket_name, bucket)
        of_key = Window.partitionBy(*keys).orderBy(*order)
        first = Window.unboundedPreceding
        upto = of_key.rowsBetween(first, Window.currentRow)
        whole = of_key.rowsBetween(first, Window.unboundedFollowing)
        out = {n: F.sum(measure).over(upto) for n, measure in sums.items()}
        out |= {dst: F.sum(sums[src]).over(whole) for dst, src in totals.items()}
        return rows.select(*[c for c in rows.columns if c not in out],
                           *[c.alias(n) for n, c in out.items()])

    dealt = keys if whole_keys else [*keys, bucket]
    shared = with_key(df, keys).repartition(*dealt).withColumn(bucket_name, bucket)

    per_bucket = shared.groupBy(*keys, bucket_name).agg(
        _read_all(df.columns).alias("_read"),
        *[F.sum(measure).alias(f"_s_{n}") for n, measure in sums.items()])
    along = Window.partitionBy(*keys).orderBy(bucket_name)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = per_bucket.select(
        *keys, bucket_name, "_read",
        F.count(F.lit(1)).over(whole).alias("_n_bkt"),
        *[F.sum(f"_s_{n}").over(earlier).alias(f"_o_{n}") for n in sums],
        *[F.sum(f"_s_{src}").over(whole).alias(f"_t_{dst}") for dst, src in totals.items()],
    ).filter((F.col("_n_bkt") > 1) & (F.col("_read") > 0)).drop("_read")

    joined = shared.join(offsets, [*keys, bucket_name], "left")
    inside = Window.partitionBy(*keys, bucket_name).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = {n: F.sum(measure).over(upto) + F.coalesce(F.col(f"_o_{n}"), F.lit(0))
           for n, measure in sums.items()}
    for dst, src in totals.items():
        out[dst] = F.coalesce(F.col(f"_t_{dst}"), F.sum(sums[src]).over(local))
    if buckets:
        out[buckets] = F.coalesce(F.col("_n_bkt"), F.lit(1))
    kept = [c for c in shared.columns if c not in out]
    return joined.select(*kept, *[c.alias(n) for n, c in out.items()])


def neighbour(df: DataFrame, keys: Sequence[str], bucket: Column,
              order: Sequence[str], columns: Mapping[str, str],
              ahead: bool = True, bucket_name: str = "_bkt") -> DataFrame:
    """Add the next (or previous) row's values per key, across bucket edges.

    ``columns`` maps new names to existing columns.  When the frame already has
    the bucket column its partitioning is used as it is.
    """
    keys = list(keys)
    work = df
    if bucket_name not in df.columns:
        work = with_key(df, keys).repartition(*keys, bucket).withColumn(bucket_name, bucket)
    packed = F.struct(*[F.col(src).alias(dst) for dst, src in columns.items()])
    position = F.struct(*[F.col(o) for o in order])
    # Buckets start at 0 and nothing looks ahead into the first one, so its
    # values (perhaps long texts) need not travel.
    edge = (F.min_by(F.when(F.col(bucket_name) > 0, packed), position) if ahead
            else F.max_by(packed, position))
    shift = F.lead if ahead else F.lag
    along = Window.partitionBy(*keys).orderBy(bucket_name)
    edges = (work.groupBy(*keys, bucket_name)
             .agg(edge.alias("_edge"), _read_all(df.columns).alias("_read"))
             .select(*keys, bucket_name, "_read", shift("_edge").over(along).alias("_outer"))
             .filter(F.col("_outer").isNotNull() & (F.col("_read") > 0)).drop("_read"))
    inside = Window.partitionBy(*keys, bucket_name).orderBy(*order)
    return (work.join(edges, [*keys, bucket_name], "left")
            .withColumn("_inner", shift(packed).over(inside))
            .withColumn("_near", F.coalesce("_inner", "_outer"))
            .select(*work.columns, *[F.col(f"_near.{dst}").alias(dst) for dst in columns]))


def hash_rank(df: DataFrame, keys: Sequence[str], drawn: str, tie: Sequence[str],
              name: str = "hash_rank", total: str | None = None,
              bits: int = HASH_BITS) -> DataFrame:
    """Position (1-based) of every row in the seeded order of its key."""
    one = F.lit(1).cast("bigint")
    return prefix_sums(df, keys, hash_bucket(drawn, bits), [drawn, *tie], {name: one},
                       totals={total: name} if total else None).drop("_bkt")
