"""Payload scores against published raw factors, and balancing invariants."""

import pytest
from pyspark.sql import functions as F

from palaver.operators import payload as p
from palaver.operators import sampling as s

# Tokens, characters per conversation, growth ratio, turns,
# conversations, tool calls, and the expected prefill / decode / total scores.
GOLDEN = [
    ("text", 88844, 35539.0, 41.155355108498235, 207, 10, 0, .3168, .0919, .2043),
    ("reasoning", 5800452, 46405.15, 21.322704706125457, 7760, 500, 0, .6104, .4805, .5455),
    ("agentic", 191641, 1534.642, 9.62995996333087, 3584, 500, 4716, .1132, .2423, .1777),
    ("pdf", 3004181, 24034.954, 13.098619697412364, 5153, 500, 0, .5144, .2919, .4032),
    ("image", 3016582, 24134.218, 12.632070150193085, 5321, 500, 0, .5155, .2987, .4071),
    ("random", 5060456, 40485.164, 41.1047375440387, 9533, 500, 0, .5453, .5242, .5348),
    ("repeat", 4789638, 38318.602, 29.650552635973252, 9301, 500, 0, .5215, .5067, .5141),
]


def test_golden_scores(spark):
    rows = [(k, t, c, g, r, n, x) for k, t, c, g, r, n, x, *_ in GOLDEN]
    df = spark.createDataFrame(rows, "kind string, tokens bigint, avg_chars double, g double, "
                                     "turns bigint, n bigint, tools bigint")
    sums = {"n": F.col("n"), "tokens": F.col("tokens"), "chars": F.col("avg_chars") * F.col("n"),
            "turns": F.col("turns"), "ratios": F.col("g"), "ratio_n": F.lit(1),
            "tools": F.col("tools")}
    out = df.select("kind", *[c.alias(n) for n, c in p.score_columns(sums, F.col("kind")).items()])
    got = {r.kind: r for r in out.collect()}
    for kind, *_, pre, dec, total in GOLDEN:
        assert got[kind].prefill_score == pytest.approx(pre, abs=5e-5)
        assert got[kind].decode_score == pytest.approx(dec, abs=5e-5)
        assert got[kind].total_payload_score == pytest.approx(total, abs=5e-5)


def test_unknown_weight_falls_back(spark):
    df = spark.range(1)
    score = p.weighted_score({"total_tokens": F.lit(10_000_000.0)}, p.PREFILL_MAX, {})
    assert df.select(score.alias("s")).first().s == pytest.approx(0.25)


@pytest.fixture(scope="module")
def conversations(spark):
    ids = spark.range(300).withColumnRenamed("id", "conv_id")
    key = F.col("conv_id")
    return ids.select(
        "conv_id", F.when(key < 280, "text").when(key < 294, "agentic").otherwise("pdf")
        .alias("dataset_type"),
        (key * 37 % 900 + 20).alias("estimated_tokens"),
        ((key * 37 % 900 + 20) * 4).alias("total_characters"),
        (key % 17 + 1).alias("num_turns"),
        F.when(key % 5 > 0, (key % 11 + 1) / F.lit(2.0)).alias("growth_ratio"),
        (key % 3).alias("num_tool_calls"))


def test_balanced_sizes_against_every_prefix(conversations):
    target = 0.2
    scored = s.prefix_scores(conversations, ["conv_id"], 42).collect()
    chosen = {r.dataset_type: r for r in s.balanced_sizes(conversations, target, ["conv_id"], 42)
              .collect()}
    assert set(chosen) == {"text", "agentic", "pdf"}
    for kind, best in chosen.items():
        rows = [r for r in scored if r.dataset_type == kind]
        assert sorted(r.size for r in rows) == list(range(1, len(rows) + 1))
        allowed = [r for r in rows if r.size >= min(10, len(rows))]
        want = min(allowed, key=lambda r: (round(abs(r.score - target), 9), r.size))
        assert best.size == want.size
        assert best.within_tolerance == (abs(best.score - target) <= 0.05)
    assert chosen["pdf"].size == 6  # fewer than ten rows: all of them
    subset = s.balanced_subset(conversations, target, ["conv_id"], 42)
    sizes = {r.dataset_type: r["count"] for r in subset.groupBy("dataset_type").count().collect()}
    assert sizes == {k: r.size for k, r in chosen.items()}


def test_score_of_a_prefix_is_the_score_of_its_rows(conversations):
    sizes = s.balanced_sizes(conversations, 0.2, ["conv_id"], 42)
    subset = s.balanced_subset(conversations, 0.2, ["conv_id"], 42)
    direct = {r.dataset_type: r.total_payload_score for r in p.payload_scores(subset).collect()}
    for r in sizes.collect():
        assert direct[r.dataset_type] == pytest.approx(r.score, rel=1e-9)
