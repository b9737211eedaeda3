"""Synthetic text by its properties; the exact texts are compared through check SQL."""

import re

import pytest
from pyspark.sql import functions as F

from palaver.functions import synth as y
from palaver.functions.draws import seeded_uuid
from palaver.functions.text import cut_at_sentence, fit_words
from palaver.operators import generate as g
from registry import QUERIES

SEED = 42
SF_DIR = "/root/testdata/sf0.001"
POOL = ["alpha", "beta gamma", "delta.", "epsilon zeta eta", "theta"]
ENTRY = "(?:" + "|".join(map(re.escape, POOL)) + ")"


def _pools():
    return {n: y.fixed_pool(POOL) for n in ("words", "lorem", "subjects", "adverbs", "verbs",
                                            "objects", "phrases", "fillers")}


def repeats(pattern, low, high, between=" "):
    """A text of ``low`` to ``high`` occurrences of the pattern."""
    return re.compile(f"{pattern}(?:{between}{pattern}){{{low - 1},{high - 1}}}")


@pytest.fixture(scope="module")
def turns(spark):
    rows = [(c, t, s, 30 + 17 * t) for c in range(6) for t in range(4) for s in y.USER_BOUNDS]
    return spark.createDataFrame(rows, "conv_id bigint, turn_no bigint, style string, target bigint")


def test_random_user_text_keeps_its_bounds(turns):
    d = y.Draws(SEED, (F.col("conv_id"), F.col("turn_no")))
    text = y.random_text(F.col("style"), _pools(), d, y.user_bounds(F.col("turn_no")))
    seen = set()
    for r in turns.withColumn("t", text).collect():
        a, b, c, e = y.USER_BOUNDS[r.style]
        low, high = (a if r.turn_no < 3 else b), (c if r.turn_no < 5 else e)
        seen.add((r.style, r.t))
        if r.style == "random_words":
            assert repeats(ENTRY, low, high).fullmatch(r.t)
        elif r.style == "random_sentences":
            assert repeats(rf"{ENTRY}(?: {ENTRY}){{2,4}}\.", low, high).fullmatch(r.t)
        elif r.style == "random_chars":
            assert low <= len(r.t.replace(" ", "")) <= high
            assert re.fullmatch("[A-Za-z0-9]+(?: [A-Za-z0-9]+)*", r.t)
        elif r.style == "random_lorem":
            assert r.t.endswith(".") and r.t[0].isupper()
            assert low <= len(r.t.replace("beta gamma", "b").replace(
                "Beta gamma", "b").replace("epsilon zeta eta", "e").replace(
                "Epsilon zeta eta", "e").split()) <= high
        else:
            assert low <= len(r.t.split()) <= high * 3
    assert len(seen) > 100


def test_random_reply_reaches_its_target(turns):
    d = y.Draws(SEED, (F.col("conv_id"), F.col("turn_no")))
    reply = y.random_reply(F.col("style"), _pools(), d, F.col("target"))
    for r in turns.withColumn("t", reply).collect():
        n = len(r.t.split())
        # List marks count as words here, not towards the target; a long text was cut to it.
        assert 0.7 * r.target <= n <= 1.3 * r.target + 1
        blocks = r.t.split("\n\n")
        assert all(blocks)
        for block in blocks[:-1]:
            lines = block.split("\n")
            if lines[0].startswith("- "):
                assert 3 <= len(lines) <= 6 and all(x.startswith("- ") for x in lines)
            elif lines[0].startswith("1. ") and len(lines) > 1:
                assert [x.split(". ")[0] for x in lines] == [str(k + 1) for k in range(len(lines))]


def test_registered_replies_have_the_default_ranges(spark):
    rows = QUERIES["gen_random_reply"](spark, SF_DIR).collect()
    assert rows and all(r.n_chars > 0 for r in rows)
    assert min(r.target_words for r in rows) >= 20 and max(r.target_words for r in rows) > 250


@pytest.mark.parametrize("target", [3, 9, 30])
def test_a_pool_is_used_up_before_it_repeats(spark, target):
    pool = ["a b.", "c", "d e f", "g h", "i"]
    df = spark.range(40).select("id", F.lit("x y").alias("t"))
    reply = g.sized_reply(F.col("t"), F.lit(target).cast("bigint"), y.fixed_pool(pool),
                          y.Draws(SEED, (F.col("id"),)), use_up=True)
    orders = set()
    for r in df.select(reply.alias("r")).collect():
        words = r.r.split()
        assert words[:2] == ["x", "y"] and target <= len(words) < target + 3
        rest, used = words[2:], []
        while rest and len(used) < len(pool):
            used.append(next(p for p in pool if rest[:len(p.split())] == p.split()))
            rest = rest[len(used[-1].split()):]
        assert len(set(used)) == len(used) and (not rest or len(used) == len(pool))
        orders.add(tuple(used))
    assert len(orders) > 3


def test_sized_reply(spark):
    texts = ["one two three", " ".join(f"w{i}." for i in range(90)), "x " * 52]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id bigint, t string")
    d = y.Draws(SEED, (F.col("id"),))
    ext = ["\n\nadd some more.", "a longer extension sentence here."]
    got = {r.id: r.r for r in df.select("id", g.sized_reply(
        F.col("t"), F.lit(40).cast("bigint"), y.fixed_pool(ext), d).alias("r")).collect()}
    # Drawn sentences are appended whole until the target is reached.
    whole = "(?: add some more\\.| a longer extension sentence here\\.)+"
    assert re.fullmatch("one two three" + whole, got[0])
    assert 40 <= len(got[0].split()) < 40 + 5
    assert got[1] == " ".join(f"w{i}." for i in range(40))
    assert got[2] == " ".join(["x"] * 52)


def test_sized_reply_makes_its_text_once(spark):
    df = spark.createDataFrame([(1, "one two")], "id bigint, t string")
    reply = g.sized_reply(F.upper("t"), F.lit(40).cast("bigint"), y.fixed_pool(["a b.", "c", ""]),
                          y.Draws(SEED, (F.col("id"),)))
    df = df.select(reply.alias("r"))
    assert df._jdf.queryExecution().analyzed().toString().count("upper(") == 1
    words = df.first().r.split(" ")
    assert words[:2] == ["ONE", "TWO"] and len(words) in (40, 41)
    # Drawn one after the other, whole sentences only.
    assert all(words[k + 1] == "b." for k in range(2, len(words)) if words[k] == "a")


def test_extension_words_take_the_first_draws(spark):
    """The same words as drawing sentence by sentence until there are enough."""
    pool, draws = ["a b c.", "", "d", None], y.Draws(SEED, (F.col("id"),))
    column = F.array(*[F.lit(p) for p in pool])
    steps = F.array(*[F.pmod(draws("extension", F.lit(k).cast("bigint")), F.lit(len(pool)))
                      for k in range(12)])
    rows = spark.range(60).select(
        "id", steps.alias("at"), (F.col("id") % 13).alias("n")).select(
        "n", "at", y.extension_words(column, draws, F.col("n")).alias("got")).collect()
    for r in rows:
        want = []
        for k in r["at"][:r["n"]]:
            want += (pool[k] or "").split() if len(want) < r["n"] else []
        assert r["got"] == want


def test_conversations_are_generated_once(spark):
    df = QUERIES["gen_conversations"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate inline") == 1


def test_pad_then_trim(spark):
    df = spark.createDataFrame([("a b c",)], "t string")
    ext = F.array(*[F.lit(f"e{i}.") for i in range(30)])
    got = df.select(fit_words(F.col("t"), ext, F.lit(10).cast("bigint"), True).alias("p"),
                    fit_words(F.col("t"), ext, F.lit(10).cast("bigint")).alias("q"),
                    cut_at_sentence(F.lit("a. b c d e f g h"), F.lit(5)).alias("c")).first()
    assert got.p == "a b c " + " ".join(f"e{i}." for i in range(7))
    assert got.q == "a b c " + " ".join(f"e{i}." for i in range(30))
    assert got.c == "a. b c d e"


def test_render(spark):
    df = spark.createDataFrame([(k, "{a}: {w}, {w} {gone}!\n", "\tx{w}") for k in range(40)],
                               "id bigint, t string, a string")
    d = y.Draws(SEED, (F.col("id"),))
    pool = {"w": y.fixed_pool(POOL)}
    each = [r.r for r in df.select(y.render(F.col("t"), {"a": F.col("a")}, pool, d).alias("r")).collect()]
    assert all(re.fullmatch(f"x{ENTRY}: {ENTRY}, {ENTRY} !", r) for r in each)
    one = [r.r for r in df.select(
        y.render(F.col("t"), {"a": F.col("a")}, pool, d, True).alias("r")).collect()]
    assert all(re.fullmatch(rf"x({ENTRY}): \1, \1 !", r) for r in one)
    assert len(set(each)) > len(set(one)) > 1


def test_render_fills_markers_of_pool_values(spark):
    df = spark.range(20).select("id", F.lit("{greeting} {n}").alias("t"))
    d = y.Draws(SEED, (F.col("id"),))
    pools = {"greeting": y.fixed_pool(["hello {who}", "hi"]), "who": y.fixed_pool(["you", "all"])}
    got = {r.r for r in df.select(y.render(F.col("t"), {}, pools, d, numbers={"n": (3, 5)})
                                  .alias("r")).collect()}
    assert all(re.fullmatch("(?:hello (?:you|all)|hi) [345]", r) for r in got)
    assert len(got) > 3


def test_allocated_turns_meet_their_counts(spark):
    buckets = ((10, 2, 5), (15, 6, 15), (15, 16, 30), (10, 31, 50))
    rows = g.allocated_turns(g.new_ids(spark, 50), buckets, 3).collect()
    for count, low, high in buckets:
        assert sum(low <= r.num_turns <= high for r in rows) == count


def test_generation_does_not_depend_on_partitions(spark):
    def made(n):
        ids = g.new_ids(spark, 40).repartition(n)
        plan = g.turn_rows(g.uniform_turns(g.with_topic(ids, {"a": 1, "b": 3}, 5), 2, 6, 5))
        msgs = g.chat_messages(plan, F.lit("sys"), F.concat("topic", F.lit("?")), F.lit("!"))
        return sorted(map(tuple, msgs.collect()))

    one = made(1)
    assert one == made(7)
    roles = [r[2] for r in one if r[0] == 0]
    assert roles[0] == "system" and roles[1:3] == ["user", "assistant"]


def test_pick_from_table_by_group(spark):
    pool = spark.createDataFrame([(i, "ab"[i % 2], f"t{i}") for i in range(9)],
                                 "item bigint, kind string, text string")
    rows = spark.range(200).select(F.col("id").alias("conv_id"), F.when(
        F.col("id") % 3 == 0, "a").otherwise("b").alias("kind"))
    from palaver.functions.draws import draw
    got = g.pick_from_table(rows, pool, "item", draw(1, "p", F.col("conv_id")), 1, ["kind"]).collect()
    assert len(got) == 200
    assert {r.text for r in got if r.kind == "a"} == {f"t{i}" for i in range(0, 9, 2)}
    assert all(("ab"[r.item % 2]) == r.kind for r in got)


def test_uuid_shape(spark):
    got = [r.u for r in spark.range(50).select(seeded_uuid(1, "id", F.col("id")).alias("u")).collect()]
    assert len(set(got)) == 50
    assert all(re.fullmatch(r"[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}", u)
               for u in got)
