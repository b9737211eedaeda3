"""Distribution operators on shapes that break approximate or map-based methods."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from palaver.operators import distribution as d


def percentile(values, p):
    values = sorted(values)
    k = (len(values) - 1) * p
    f, c = math.floor(k), math.ceil(k)
    if f == c:
        return values[int(k)]
    return values[f] * (c - k) + values[c] * (k - f)


SHAPES = {
    "constant": [5.0] * 50,
    "heavy_tail": [float(int(1.5 ** i)) for i in range(60)] + [1e12],
    "negative": [-3.5, -2.0, 0.0, 0.0, 1.25, 1e-9, -1e9],
    "narrow": [1.0 + i * 1e-7 for i in range(300)],
    "single": [42.0],
    "hot_value": [1.0] * 900 + [float(i) for i in range(100)],
}


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(g, v) for g, vs in SHAPES.items() for v in vs]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, "g string, v double")


@pytest.mark.parametrize("by_rows", [False, True])
@pytest.mark.parametrize("rounds, parts", [(d.ROUNDS, d.SPLITS), (0, 1), (3, 8)])
def test_quantiles(frame, monkeypatch, by_rows, rounds, parts):
    """Buckets cut by their own range, not at all, or in many rounds give the same quantiles."""
    monkeypatch.setattr(d, "SPLITS", parts)
    if by_rows:
        out = d.row_quantiles(frame, ["g"], ["v"], d.PERCENTILES, rounds)
    else:
        out = d.quantiles(d.value_counts(frame, ["g"], ["v"]), ["g", "metric"], d.PERCENTILES, rounds)
    got = {(r.g, r.p): r.value for r in out.collect()}
    for g, values in SHAPES.items():
        for p in d.PERCENTILES:
            assert got[g, p] == pytest.approx(percentile(values, p), rel=1e-12, abs=1e-12)
    assert len(got) == len(SHAPES) * len(d.PERCENTILES)


@pytest.mark.parametrize("by_rows", [False, True])
def test_unix_times_are_ranked_in_several_buckets(spark, by_rows):
    n = 300_000
    times = spark.range(n, numPartitions=4).select(
        (F.lit(1.7e9) + F.pmod(F.col("id") * 7919, F.lit(n))).alias("v"))
    if by_rows:
        work = d._long(times, [], ["v"]).withColumn("n", F.lit(1).cast("bigint"))
        out = d.row_quantiles(times, [], ["v"], [0.0, 0.37, 1.0])
    else:
        work = d.value_counts(times, [], ["v"])
        out = d.quantiles(work, ["metric"], [0.0, 0.37, 1.0])
    assert {r.p: r.value for r in out.collect()} == {
        0.0: 1.7e9, 0.37: pytest.approx(1.7e9 + 0.37 * (n - 1), abs=1e-6), 1.0: 1.7e9 + n - 1}
    work = work.withColumn("_b0", d._magnitude_bucket(F.col("value")))
    first = d._ranked_buckets(work, ["metric"], [0.5])
    assert first.first()["_cells"] > 100_000
    inside, narrow = d._split(work, first, ["metric", "_b0"], "_b1")
    assert inside.select("_b1").distinct().count() > 100_000
    assert narrow.first()["_cells"] < 4


def test_summary(frame):
    got = {r.g: r for r in d.numeric_summary(frame, ["g"], ["v"]).collect()}
    for g, values in SHAPES.items():
        r = got[g]
        assert (r.n, r.min, r.max) == (len(values), min(values), max(values))
        assert r.mean == pytest.approx(statistics.mean(values), rel=1e-12)
        assert r.median == pytest.approx(statistics.median(values), rel=1e-12)
        want = statistics.stdev(values) if len(values) > 1 else 0.0
        assert r.stdev == pytest.approx(want, rel=1e-6, abs=1e-12)


@pytest.mark.parametrize("bins", [1, 5, 10])
def test_histogram(frame, bins):
    got = {}
    for r in d.histogram(d.value_counts(frame, ["g"], ["v"]), ["g", "metric"], bins).collect():
        got.setdefault(r.g, {})[r.bin] = r
    for g, values in SHAPES.items():
        lo, hi = min(values), max(values)
        k = 1 if lo == hi else bins
        assert sorted(got[g]) == list(range(k))
        assert sum(r["count"] for r in got[g].values()) == len(values)
        width = (hi - lo) / k
        for i, r in got[g].items():
            inside = [v for v in values if lo + i * width <= v
                      and (v < lo + (i + 1) * width or i == k - 1)]
            assert r["count"] == len(inside)


def test_edge_values_fall_into_the_upper_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in range(0, 11)], "v double")
    counts = [r["count"] for r in d.histogram(
        d.value_counts(df, [], ["v"]), ["metric"], 10).orderBy("bin").collect()]
    assert counts == [1] * 9 + [2]


def test_turn_buckets_keep_zeros(spark):
    df = spark.createDataFrame([(1,), (5,), (6,), (31,)], "num_turns bigint")
    got = [(r.range, r["count"], r.percentage) for r in d.turn_buckets(df, []).orderBy(
        "range_no").collect()]
    assert got == [("short (1-5)", 2, 50.0), ("medium (6-15)", 1, 25.0),
                   ("long (16-30)", 0, 0.0), ("very_long (31+)", 1, 25.0)]


def test_frequency_adds_up(spark):
    df = spark.range(90).withColumn("c", F.when(F.col("id") < 30, "hot").otherwise(
        F.col("id").cast("string")))
    got = d.frequency(df, [], "c").collect()
    assert sum(r["count"] for r in got) == 90
    assert sum(r.percentage for r in got) == pytest.approx(100)
    assert max(got, key=lambda r: r["count"]).value == "hot"
