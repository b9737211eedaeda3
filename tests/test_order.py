"""Rows by position against a sort in memory."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from palaver.operators import order as o
from palaver.operators import sampling as s

SCHEMA = "k string, t timestamp, v double, id bigint"


def rows():
    rnd = random.Random(3)
    start = datetime.datetime(2024, 1, 1)
    made = [(rnd.choice([None, "", "a", "b", "é", "zz"]), rnd.choice([None, start + datetime.timedelta(hours=rnd.randint(0, 5))]),
             rnd.choice([None, -1.5, 0.0, 3.25, 1e9]), rnd.randint(0, 3)) for _ in range(500)]
    return made + [("a", None, None, None)] * 200


def key(r, names):
    at = dict(zip(("k", "t", "v", "id"), r))
    return tuple((at[n] is not None, at[n] if at[n] is None or n != "k" else at[n].encode())
                 if at[n] is not None else (False,) for n in names)


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5)


@pytest.fixture(params=[(1024, 4096), (16, 40)])
def sizes(request, monkeypatch):
    monkeypatch.setattr(o, "RANGES", request.param[0])
    monkeypatch.setattr(o, "FEW", request.param[1])


@pytest.mark.parametrize("order", [["k", "t"], ["v"]])
def test_first_rows(frame, sizes, order):
    want = sorted((key(r, order) for r in rows()))
    for n in (1, 350, 5000):
        got = [tuple(r) for r in o.first_rows(frame, n, order).collect()]
        assert sorted(key(r, order) for r in got) == want[:n]
    assert o.first_rows(frame, 0, order).count() == 0


def test_row_at_and_slices(frame):
    order = ["k", "v", "t", "id"]
    want = sorted((key(r, order) for r in rows()))
    for at in (0, 349, 699):
        got = [key(tuple(r), order) for r in o.row_at(frame, at, order).collect()]
        assert got == [want[at]]
    assert o.row_at(frame, 700, order).count() == 0
    for start, end in ((0, 10), (100, 400), (650, 9000), (700, 800), (5, 5)):
        got = sorted(key(tuple(r), order) for r in o.rows_between(frame, start, end, order).collect())
        assert got == want[start:end]


def test_ties_are_settled_alike(spark, frame):
    order = ["k"]
    a = sorted(map(tuple, o.first_rows(frame, 333, order).collect()), key=str)
    b = sorted(map(tuple, o.first_rows(frame.repartition(3), 333, order).collect()), key=str)
    assert a == b


def test_only_bounded_tables_meet_in_one_task(spark):
    rows = spark.range(100_000, numPartitions=8).select(F.md5(F.col("id").cast("string")).alias("h"))
    half = o.first_rows(rows, 50_000, ["h"])
    assert half.count() == 50_000
    plan = half._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Sort" not in plan and "Window" not in plan
    ids = [r.h for r in rows.orderBy("h").limit(50_000).collect()]
    assert o.row_at(rows, 49_999, ["h"]).first().h == ids[-1]


def test_sample_by_short_digits(spark, monkeypatch):
    df = spark.range(3000).withColumn("g", F.when(F.col("id") < 2500, "hot").when(
        F.col("id") < 2505, "tiny"))
    want = {n: {r.id for r in s.exact_sample(df, n, ["id"], 42).collect()} for n in (1, 700, 2999)}
    strata = {tuple(r) for r in s.stratified_sample(df, "g", ["id"], 1, k=300).collect()}
    cuts = s.sample_cutoffs(df, ["id"], 42, n=700).collect()
    for digits in ((2, 2, 28), (4, 4, 4), (32,)):
        assert s.sample_cutoffs(df, ["id"], 42, n=700, digits=digits).collect() == cuts
    monkeypatch.setattr(s.sample_cutoffs, "__defaults__", (*s.sample_cutoffs.__defaults__[:-1], (3, 3, 26)))
    for n, ids in want.items():
        assert {r.id for r in s.exact_sample(df, n, ["id"], 42).collect()} == ids and len(ids) == n
    assert {tuple(r) for r in s.stratified_sample(df, "g", ["id"], 1, k=300).collect()} == strata
