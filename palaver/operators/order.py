"""Rows by position in a stated order, without sorting or ranking all rows.

A row's key is the tuple of its order columns and a hash of the row, so that ties
are settled alike in every run.  A position is located in rounds: sampled keys (one for
each hash bucket) cut the candidates into up to ``RANGES`` + 1 ranges, the ranges are
counted, and the one that holds the position has the next candidates, until at
most ``FEW`` are left.  The driver gets a row for each range, never more.  The rows
themselves are then compared with the key found, where they lie; on the first
order column readers can prune by it.  It serves numbers, strings, dates, times
and tuples of them alike.

The rounds run when an operator is called.  Order is ascending, NULL first.
All columns must be of types that can be grouped (no maps).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

RANGES = 1024
FEW = 4096

#: A key as text for each of its columns; it lives in the driver between rounds.
Key = tuple[str | None, ...]


def row_key(df: DataFrame, order: Sequence[str]) -> Column:
    """The order columns and a hash of the row."""
    return F.struct(*[F.col(c) for c in order], F.xxhash64(*df.columns).alias("_tie"))


def _types(df: DataFrame, order: Sequence[str]) -> list[T.DataType]:
    return [*(df.schema[c].dataType for c in order), T.LongType()]


def _as_text(value: Column, kind: T.DataType) -> Column:
    """A form from which :func:`_from_text` makes the same value again."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("string")
    return F.hex(value) if isinstance(kind, T.BinaryType) else value.cast("string")


def _from_text(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(text.cast("bigint"))
    return F.unhex(text) if isinstance(kind, T.BinaryType) else text.cast(kind)


def _shown(key: str, names: Sequence[str], kinds: Sequence[T.DataType]) -> list[Column]:
    return [_as_text(F.col(key)[n], t).alias(f"_{i}") for i, (n, t) in enumerate(zip(names, kinds))]


def _literal(key: Key, names: Sequence[str], kinds: Sequence[T.DataType]) -> Column:
    return F.struct(*[_from_text(F.lit(v).cast("string"), t).alias(n)
                      for v, n, t in zip(key, names, kinds)])


def _range_of(key: Column, edges: Column) -> Column:
    """Number of ``edges`` (sorted, at most ``RANGES``) that are not above the key."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(RANGES.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= F.size(edges)) & (F.get(edges, at + step - 1) <= key), at + step).otherwise(at))


class Located:
    """The key at a position, and how many of the rows that share it lie up to it.

    Rows share a key if they are equal in all columns.
    """

    def __init__(self, df: DataFrame, order: Sequence[str], key: Key, kept: int):
        self.df, self.order, self.kept = df, list(order), kept
        self.kinds, self.key = _types(df, order), key
        self.names = [*order, "_tie"]

    def _cut(self) -> Column:
        return _literal(self.key, self.names, self.kinds)

    def _first_column(self) -> Column:
        """What a reader can prune by: the first order column up to that of the key."""
        first = F.col(self.order[0])
        if self.key[0] is None:
            return first.isNull()
        return first.isNull() | (first <= _from_text(F.lit(self.key[0]), self.kinds[0]))

    def below(self) -> Column:
        return self._first_column() & (row_key(self.df, self.order) < self._cut())

    def above(self) -> Column:
        return row_key(self.df, self.order) > self._cut()

    def same(self) -> Column:
        return self._first_column() & (row_key(self.df, self.order) == self._cut())


def locate(df: DataFrame, position: int, order: Sequence[str]) -> Located | None:
    """Where a position (from 0) is; None if there are not so many rows."""
    names, kinds = [*order, "_tie"], _types(df, order)
    spark, left, number = df.sparkSession, position, 0
    candidates = df.select(row_key(df, order).alias("_k"))
    fields = [f"_{i}" for i in range(len(names))]
    while True:
        drawn = F.xxhash64("_k", F.lit(number))
        sampled = (candidates.groupBy(F.pmod(drawn, F.lit(RANGES)).alias("_h"))
                   .agg(F.min_by("_k", drawn).alias("_e"), F.count(F.lit(1)).alias("_n"),
                        (F.min("_k") == F.max("_k")).alias("_one")))
        edges = sampled.orderBy("_e").select(*_shown("_e", names, kinds), "_n", "_one").collect()
        total = sum(r["_n"] for r in edges)
        if left >= total:
            return None
        if len(edges) == 1 and edges[0]["_one"]:
            return Located(df, order, tuple(edges[0])[:len(names)], left + 1)
        if total <= FEW:
            keys = candidates.groupBy("_k").agg(F.count(F.lit(1)).alias("_n")).orderBy("_k")
            for r in keys.select(*_shown("_k", names, kinds), "_n").collect():
                if left < r["_n"]:
                    return Located(df, order, tuple(r)[:len(names)], left + 1)
                left -= r["_n"]
        table = spark.createDataFrame([tuple(r)[:len(names)] for r in edges],
                                      ", ".join(f"{f} string" for f in fields))
        key = F.struct(*[_from_text(F.col(f), t).alias(n) for f, n, t in zip(fields, names, kinds)])
        cuts = table.select(key.alias("_e")).agg(F.array_sort(F.collect_list("_e")).alias("_e")).scalar()
        ranged = candidates.withColumn("_e", cuts).select(
            _range_of(F.col("_k"), F.col("_e")).alias("_r"))
        counts = {r["_r"]: r["_n"] for r in ranged.groupBy("_r").agg(
            F.count(F.lit(1)).alias("_n")).collect()}
        for place in sorted(counts):
            if left < counts[place]:
                break
            left -= counts[place]
        if place > 0:
            low = _literal(tuple(edges[place - 1])[:len(names)], names, kinds)
            candidates = candidates.filter(F.col("_k") >= low)
        if place < len(edges):
            high = _literal(tuple(edges[place])[:len(names)], names, kinds)
            candidates = candidates.filter(F.col("_k") < high)
        number += 1


def _copies(df: DataFrame, number: int) -> DataFrame:
    """``number`` copies of a row that stands in ``df`` more than once; they are counted, not gathered."""
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    copies = F.sequence(F.lit(1).cast("bigint"), F.least("_n", F.lit(number).cast("bigint")))
    return counted.select(*df.columns, F.explode(copies).alias("_copy")).select(*df.columns)


def first_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows (all rows when there are fewer), filtered where they lie."""
    if n <= 0:
        return df.filter(F.lit(False))
    last = locate(df, n - 1, order)
    if last is None:
        return df
    return df.filter(last.below()).union(_copies(df.filter(last.same()), last.kept))


def row_at(df: DataFrame, position: int, order: Sequence[str]) -> DataFrame:
    """The row at a position (from 0); none beyond the end."""
    found = locate(df, position, order)
    return df.filter(F.lit(False)) if found is None else _copies(df.filter(found.same()), 1)


def rows_between(df: DataFrame, start: int, end: int, order: Sequence[str]) -> DataFrame:
    """The rows at positions from ``start`` up to, not including, ``end``."""
    start = max(start, 0)
    if end <= start:
        return df.filter(F.lit(False))
    first, last = locate(df, start, order), locate(df, end - 1, order)
    if first is None:
        return df.filter(F.lit(False))
    if last is not None and last.key == first.key:
        return _copies(df.filter(first.same()), last.kept - first.kept + 1)
    at_start = df.filter(first.same())
    counted = at_start.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    copies = F.sequence(F.lit(first.kept).cast("bigint"), F.col("_n"))
    rows = counted.select(*df.columns, F.explode(copies).alias("_copy")).select(*df.columns)
    if last is None:
        return rows.union(df.filter(first.above()))
    return (rows.union(df.filter(first.above() & last.below()))
            .union(_copies(df.filter(last.same()), last.kept)))
