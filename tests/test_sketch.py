"""Merged sketch profiles against exact figures."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from palaver.plans import sketch as sk

PROBABILITIES = [0.01, 0.25, 0.5, 0.9, 0.99]


@pytest.fixture(scope="module")
def values():
    rnd = random.Random(5)
    return {"wide": [rnd.lognormvariate(3, 2) for _ in range(20_000)],
            "ties": [float(rnd.choice([1, 2, 2, 2, 9])) for _ in range(5000)], "single": [7.0],
            "none": [None, None]}


@pytest.fixture(scope="module")
def frame(spark, values):
    rows = [(g, k % 13, v, k % 700) for g, vs in values.items() for k, v in enumerate(vs)]
    return spark.createDataFrame(rows, "g string, part int, v double, id int").repartition(6)


@pytest.mark.parametrize("k", [200, sk.K])
def test_merged_parts_are_within_the_stated_error(frame, values, k):
    parts = sk.sketch_profile(frame, ["g", "part"], ["v"], ["id"], k=k)
    merged = sk.merge_profiles(parts, ["g"], ["part"])
    assert merged.columns == ["g", "v", "distinct_id"]
    got = {r.g: r for r in sk.profile_values(merged, ["g"], PROBABILITIES).collect()}
    for g, vs in values.items():
        vs = sorted(v for v in vs if v is not None)
        r = got[g]
        assert r.metric == "v" and r.n == len(vs)
        if not vs:
            assert (r.total, r.min, r.mean, r.stdev, r.quantiles) == (None,) * 5
            continue
        assert (r.min, r.max) == (vs[0], vs[-1])
        assert r.total == pytest.approx(sum(vs)) and r.mean == pytest.approx(statistics.mean(vs))
        assert r.stdev == pytest.approx(statistics.stdev(vs) if len(vs) > 1 else 0.0, rel=1e-6)
        slack = 2 * sk.rank_error(k) * len(vs) + 1
        for p, q in zip(PROBABILITIES, r.quantiles):
            below, upto = sum(v < q for v in vs), sum(v <= q for v in vs)
            assert below - slack <= p * len(vs) <= upto + slack
    ids = {r.g: r.distinct for r in sk.distinct_values(merged, ["g"]).collect()}
    assert ids["wide"] == pytest.approx(700, rel=5 * sk.distinct_error()) and ids["single"] == 1


def test_merging_reads_no_rows(spark, frame, tmp_path):
    sk.sketch_profile(frame, ["g", "part"], ["v"]).write.parquet(str(tmp_path / "profiles"))
    stored = spark.read.parquet(str(tmp_path / "profiles"))
    whole = sk.merge_profiles(stored, [], ["g", "part"])
    assert whole.select(F.col("v.n")).first()[0] == 25_001
    assert "v:double" not in whole._jdf.queryExecution().executedPlan().toString()
