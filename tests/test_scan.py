"""Bucketed scans give what a plain window gives, whatever the block size."""

import random

import pytest
from pyspark.sql import Window, functions as F

from palaver.functions.draws import draw
from palaver.operators import metrics as m
from palaver.operators.scan import hash_rank, neighbour, prefix_sums, turn_bucket


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("block", [1, 4, 7, 1024])
def test_context_scan_matches_plain_window(hot_messages, block):
    plain = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(
        Window.unboundedPreceding, 0)
    want = hot_messages.select(
        "conv_id", "turn", F.sum(F.length("text").cast("bigint")).over(plain).alias("c"),
        F.count(F.lit(1)).over(plain).alias("p"),
        F.sum(F.when(F.col("role") == "assistant", 1).otherwise(0)).over(plain).alias("r"),
        F.count(F.lit(1)).over(Window.partitionBy("conv_id")).alias("n"))
    got = m.context_scan(m.message_sizes(hot_messages), block).select(
        "conv_id", "turn", "cum_chars", "position", "reply_no", "num_messages")
    assert rows(got) == rows(want)


@pytest.mark.parametrize("ahead", [True, False])
@pytest.mark.parametrize("block", [1, 3, 1024])
def test_neighbour_crosses_blocks(hot_messages, block, ahead):
    lean = hot_messages.select("conv_id", "turn", "role")
    shift = F.lead if ahead else F.lag
    plain = Window.partitionBy("conv_id").orderBy("turn")
    want = lean.withColumn("near", shift("role").over(plain))
    got = neighbour(lean, ["conv_id"], turn_bucket("turn", block), ["turn"], {"near": "role"},
                    ahead=ahead).drop("_bkt")
    assert rows(got) == rows(want)


@pytest.mark.parametrize("bits", [1, 4, 12])
def test_hash_rank_is_a_total_order(spark, bits):
    df = spark.range(500).withColumn("g", F.col("id") % 3).withColumn(
        "_d", draw(1, "s", F.col("id")))
    got = hash_rank(df, ["g"], "_d", ["id"], "k", total="n", bits=bits)
    want = df.withColumn("k", F.row_number().over(Window.partitionBy("g").orderBy("_d", "id"))
                         .cast("bigint")).withColumn("n", F.count("*").over(Window.partitionBy("g")))
    assert rows(got.select("id", "k", "n")) == rows(want.select("id", "k", "n"))


def test_sparse_positions(spark):
    rng = random.Random(3)
    data = [(1, t, rng.randint(0, 5)) for t in rng.sample(range(10_000), 40)]
    df = spark.createDataFrame(data, "k bigint, t bigint, v bigint")
    got = prefix_sums(df, ["k"], turn_bucket("t", 100), ["t"], {"s": F.col("v")})
    total, want = 0, {}
    for _, t, v in sorted(data, key=lambda x: x[1]):
        total += v
        want[t] = total
    assert {r.t: r.s for r in got.collect()} == want


def test_whole_keys_scan_equals_bucketed_scan(spark):
    rng = random.Random(5)
    data = [(k, t, rng.randint(0, 9)) for k in (1, 2, 3, None) for t in rng.sample(range(50), 12 * (k or 1))]
    df = spark.createDataFrame(data, "k bigint, t bigint, v bigint")
    got, want = (prefix_sums(df, ["k"], turn_bucket("t", 7), ["t"], {"s": F.col("v")}, {"all": "s"},
                             whole_keys=whole) for whole in (True, False))
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.select(want.columns)) == rows(want)
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()


def test_one_source_scan_per_context_scan(spark):
    msgs = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    df = m.conversation_metrics(msgs, block=2)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1
    assert "ReusedExchange" in plan


@pytest.mark.parametrize("block", [2, 5, 1024])
def test_conversation_metrics_brute_force(hot_messages, by_conversation, block):
    got = {r.conv_id: r for r in m.conversation_metrics(
        hot_messages, block=block, system_prompt=True).collect()}
    assert set(got) == set(by_conversation)
    for conv, msgs in by_conversation.items():
        cum, entries = 0, []
        for _, role, text in msgs:
            cum += len(text)
            if role == "assistant":
                entries.append(cum)
        r = got[conv]
        assert r.num_messages == len(msgs) and r.num_turns == len(entries)
        assert r.total_characters == cum and r.estimated_tokens == cum // 4
        assert r.system_prompt == next((t for _, role, t in msgs if role == "system"), "")
        want = None
        if len(entries) >= 2:
            want = entries[-1] / entries[0] if entries[0] > 0 else 0
        assert r.growth_ratio == want
