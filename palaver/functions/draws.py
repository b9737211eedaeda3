"""Seeded draws that depend only on (seed, id, salt), never on partitioning.

A draw is the first 32 bits of an MD5 over the joined key parts, so the same
row gets the same value on any cluster layout, after a task retry, and in any
other SQL engine that has ``md5``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

DRAW_SPAN = 1 << 32


def draw(seed: int, salt: str, *parts: Column) -> Column:
    """Uniform BIGINT in [0, 2**32) for the row identified by ``parts``."""
    text = F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts],
                       F.lit(salt))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def unit(drawn: Column) -> Column:
    """Map a draw to a DOUBLE in [0, 1)."""
    return drawn.cast("double") / F.lit(float(DRAW_SPAN))


def uniform_int(drawn: Column, low: Column | int, high: Column | int) -> Column:
    """Uniform integer in the closed range [low, high]."""
    low_c = low if isinstance(low, Column) else F.lit(low).cast("bigint")
    high_c = high if isinstance(high, Column) else F.lit(high).cast("bigint")
    return low_c + F.pmod(drawn, high_c - low_c + F.lit(1).cast("bigint"))


def cumulative(weights: Mapping[str, float]) -> list[tuple[str, float]]:
    """Normalised running weights, rounded so that both engines see one literal."""
    total = float(sum(weights.values()))
    if total <= 0:
        weights = {k: 1.0 for k in weights}
        total = float(len(weights))
    out, running = [], 0.0
    for name, weight in weights.items():
        running += weight
        out.append((name, round(running / total, 10)))
    return out


def weighted_choice(drawn: Column, weights: Mapping[str, float]) -> Column:
    """Categorical draw: the first category whose running weight exceeds it."""
    steps = cumulative(weights)
    position = unit(drawn)
    choice = None
    for name, bound in steps[:-1]:
        hit = position < F.lit(bound)
        choice = F.when(hit, F.lit(name)) if choice is None else choice.when(hit, F.lit(name))
    last = F.lit(steps[-1][0])
    return last if choice is None else choice.otherwise(last)


def pick(drawn: Column, pool: Column | Sequence[str]) -> Column:
    """Uniform element of an array (a column, or a fixed list of strings)."""
    arr = pool if isinstance(pool, Column) else F.array(*[F.lit(p) for p in pool])
    size = F.size(arr).cast("bigint")
    return F.when(size > 0, F.try_element_at(arr, (F.pmod(drawn, size) + 1).cast("int")))


def seeded_uuid(seed: int, salt: str, *parts: Column) -> Column:
    """Version-4 shaped UUID text from 128 seeded bits."""
    hexes = F.md5(F.concat_ws("|", F.lit(str(seed)),
                              *[p.cast("string") for p in parts], F.lit(salt)))
    variant = F.substring(
        F.lit("89ab"),
        F.pmod(F.conv(F.substring(hexes, 17, 1), 16, 10).cast("int"), F.lit(4)) + 1, F.lit(1))
    marked = F.concat(F.substring(hexes, 1, 12), F.lit("4"), F.substring(hexes, 14, 3),
                      variant, F.substring(hexes, 18, 15))
    return F.regexp_replace(
        marked, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
