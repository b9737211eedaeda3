"""Sampling, allocation, mixing and schema alignment."""

import json

import pytest
from pyspark.sql import functions as F

from palaver.operators import curate as c
from palaver.operators import mix as x
from palaver.operators import sampling as s
from palaver.operators import tags as tg
from palaver.operators import toollog as t


@pytest.mark.parametrize("n", [0, 1, 17, 400, 1000, 5000])
def test_exact_sample_size_and_nesting(spark, n):
    df = spark.range(1000).repartition(5)
    got = {r.id for r in s.exact_sample(df, n, ["id"], 42).collect()}
    assert len(got) == min(n, 1000)
    more = {r.id for r in s.exact_sample(df.repartition(2), n + 50, ["id"], 42).collect()}
    assert got <= more


def test_stratified(spark):
    df = spark.range(1000).withColumn("g", F.when(F.col("id") < 900, "hot").when(
        F.col("id") < 905, "tiny").otherwise("rest"))
    got = {r.g: r["count"] for r in s.stratified_sample(df, "g", ["id"], 1, k=30).groupBy("g")
           .count().collect()}
    assert got == {"hot": 30, "tiny": 5, "rest": 30}


def _sources(spark, have, weights):
    frame = spark.createDataFrame(list(have.items()), "source_dataset string, available bigint")
    return x.source_table(spark, weights).join(frame, ["source_dataset"])


def _quota(df):
    return {r.source_dataset: (r.wanted, r.quota) for r in df.collect()}


def test_weighted_allocation(spark):
    have = {"a": 100, "b": 3, "c": 100}
    got = _quota(x.allocate_weighted(_sources(spark, have, {"a": .5, "b": .3, "c": .2, "d": 5}), 11))
    # floor(5.5), floor(3.3), floor(2.2), remainder to the heaviest, b capped
    assert got == {"a": (6, 6), "b": (3, 3), "c": (2, 2)}
    got = _quota(x.allocate_weighted(_sources(spark, {"a": 9, "b": 1}, {"a": 0, "b": 0}), 7))
    assert got == {"a": (4, 4), "b": (3, 1)}
    got = _quota(x.allocate_weighted(_sources(spark, {"a": 90}, {"a": .5}), 10, normalise=False))
    assert got == {"a": (10, 10)}


def test_equal_allocation(spark):
    got = _quota(x.allocate_equal(_sources(spark, {"a": 9, "b": 9, "c": 1}, dict(a=1, b=1, c=1)), 8))
    assert got == {"a": (3, 3), "b": (3, 3), "c": (2, 1)}


@pytest.mark.parametrize("strategy, sizes", [
    ("weighted", {"a": 30, "b": 18, "c": 5}), ("equal", {"a": 20, "b": 20, "c": 5})])
def test_mix(spark, strategy, sizes):
    df = spark.range(400).select(F.col("id").alias("conversation_id"), F.when(
        F.col("id") < 300, "a").when(F.col("id") < 395, "b").otherwise("c").alias("source_dataset"))
    out = x.mix(df, {"a": .5, "b": .3, "c": .2}, 60, 42, strategy, ordered=True)
    got = {r.source_dataset: r["count"] for r in out.groupBy("source_dataset").count().collect()}
    assert got == sizes
    again = x.mix(df.repartition(3), {"a": .5, "b": .3, "c": .2}, 60, 42, strategy)
    assert {r.conversation_id for r in out.collect()} == {r.conversation_id for r in again.collect()}
    with pytest.raises(ValueError):
        x.mix(df, {"a": 1}, 5, 1, "other")


def test_schema_modes(spark):
    a = spark.createDataFrame([("1", "cooking", 5)], "conversation_id string, topic string, num_turns bigint")
    b = spark.createDataFrame([("2", 0.5)], "conversation_id string, success_score double")
    frames = {"text": a, "agentic": b}
    both = x.concat_sources(frames)
    union = {r.conversation_id: r for r in x.align_schema(both, "union").collect()}
    assert union["2"].topic == "" and union["2"].num_turns == 0 and union["1"].success_score == 0.0
    assert union["1"].messages == "[]" and union["1"].num_errors == 0
    parity = {r.conversation_id: r for r in x.align_schema(both, "union", parity=True).collect()}
    assert parity["2"].topic is None and parity["2"].num_errors == 0
    true_inter = x.align_schema(both, "intersection", frames)
    assert set(true_inter.columns) == set(x.STANDARD_COLUMNS)
    wide = x.align_schema(both, "intersection", frames, parity=True)
    assert set(wide.columns) == set(x.STANDARD_COLUMNS) | {"topic", "success_score"}
    with pytest.raises(ValueError):
        x.concat_sources({})
    with pytest.raises(ValueError):
        x.align_schema(both, "other")


@pytest.mark.parametrize("target", [7, 20, 29, 100])
def test_balanced_cap(spark, target):
    counts = {"a": 20, "b": 2, "c": 9}
    rows = [(f"{k}{i}", k, j, i) for j, (k, n) in enumerate(counts.items()) for i in range(n)]
    df = spark.createDataFrame(rows, "id string, cat string, cat_no bigint, pos bigint")
    got = {r.id for r in c.balanced_cap(df, "cat", "cat_no", "pos", target, block=4).collect()}
    quota = target // 3
    want, spare = [], []
    for k, n in counts.items():
        ids = [f"{k}{i}" for i in range(n)]
        want += ids[:quota]
        spare += ids[quota:]
    want += spare[: target - len(want)]
    assert got == set(want)


def test_first_per_key(spark):
    df = spark.createDataFrame([("u", 2, "x"), ("u", 1, "y"), ("v", 3, None), ("u", 1, "z")],
                               "url string, o bigint, t string")
    got = {(r.url, r.o, r.t) for r in c.first_per_key(df, "url", ["o", "t"]).collect()}
    assert got == {("u", 1, "y"), ("v", 3, None)}


def test_usable_media(spark):
    rows = [("Sea.jpg", 400, 300, "image/jpeg", True), ("Sea.SVG", 900, 900, "image/png", False),
            ("Site LOGO.jpg", 900, 900, "image/png", False), ("a.jpg", 399, 900, "image/png", False),
            ("b.jpg", 900, 299, "image/png", False), ("c.jpg", 900, 900, "video/ogg", False),
            ("d.jpg", 900, 900, "image/gif", False)]
    df = spark.createDataFrame(rows, "t string, w int, h int, m string, ok boolean")
    for r in df.withColumn("got", c.usable_media(F.col("t"), F.col("w"), F.col("h"), F.col("m"))).collect():
        assert r.got == r.ok, r.t


def test_stored_tool_calls(spark):
    calls = [{"tool": "a", "call": {"x": [1, 2]}, "result": {"status": "success", "result": "r" * 99}},
             {"tool": "b", "call": {}, "result": {"status": "error", "error": "no", "result": "r"}},
             {"tool": "a", "result": {"status": "success"}}, {"tool": "c"}]
    rows = [(1, json.dumps(calls)), (2, "[]"), (3, "{broken"), (4, None)]
    df = spark.createDataFrame(rows, "conversation_id bigint, tool_calls string")
    log = t.explode_tool_calls(df)
    got = [(r.conv_id, r.seq, r.tool, r.status, r.detail) for r in log.orderBy("seq").collect()]
    assert got == [(1, 0, "a", "success", "r" * 60), (1, 1, "b", "error", "no"),
                   (1, 2, "a", "success", "N/A"), (1, 3, "c", None, "N/A")]
    assert json.loads(log.where("seq = 0").first().call) == {"x": [1, 2]}


def test_invalid_messages(spark):
    rows = [(1, '[{"role":"user","content":"x"}]'), (2, "[]"), (3, "{oops"), (4, '{"a":1}'), (5, None)]
    df = spark.createDataFrame(rows, "id bigint, messages string")
    got = {r.id: r.problem for r in c.invalid_messages(df).collect()}
    assert got == {2: "empty", 3: "invalid", 4: "not a list", 5: "invalid"}


def test_success_score_bands(spark):
    rows = [("data_processing", 0, 5, 1.0), ("planning_execution", 2, 2, 0.9), ("unheard_of", 12, 9, 0.8),
            ("code_generation", 1, 3, 1.0)]
    df = spark.createDataFrame(rows, "task_type string, num_errors bigint, num_turns bigint, base_score double")
    got = t.with_success(df).collect()
    assert [round(r.success_score, 9) for r in got] == [1.0, round(0.9 * 0.8 * 0.8, 9), 0.0, 0.9]
    assert got[2].success_metric == "completion_score"
    closed = [r["count"] for r in t.score_bands(t.with_success(df)).orderBy("range_no").collect()]
    half_open = [r["count"] for r in t.score_bands(t.with_success(df), False).orderBy("range_no").collect()]
    assert closed == [1, 0, 1, 0, 2] and half_open == [1, 0, 1, 0, 1]


def test_no_calls_is_full_success(spark):
    df = spark.createDataFrame([(1, 0, 0), (2, 4, 1)], "conv_id bigint, num_tool_calls bigint, num_errors bigint")
    assert [r.success_rate for r in t.run_success_rate(df).orderBy("conv_id").collect()] == [100.0, 75.0]


def test_tags_and_names(spark):
    rows = [("random", 10, 40), ("repeat", 10, 3), ("agentic", 10, 16)]
    df = spark.createDataFrame(rows, "dataset_type string, estimated_tokens bigint, num_turns bigint")
    got = {r.dataset_type: r for r in tg.dataset_tags(df, user_tags=["mine"], extra_tags=["x"]).collect()}
    assert got["random"].auto_tags == [
        "synthetic", "multi-turn", "benchmarking", "inference", "prefix-caching", "random", "small",
        "n1", "sub-1M-tokens", "very-long-context", "baseline", "gibberish", "x"]
    assert got["repeat"].all_tags == sorted(set(got["repeat"].auto_tags) | {"mine"})
    assert "long-context" in got["agentic"].all_tags
    name = df.limit(1).select(tg.descriptive_name(
        "multi_turn_text_chat.parquet", F.lit(500), 42, "1.0.0", F.to_date(F.lit("2026-04-29")), "v2")
        .alias("n")).first().n
    assert name == "multi_turn_text_chat_n500_s42_v1.0.0_20260429_v2"
