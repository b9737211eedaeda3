"""Synthetic conversations as a distributed plan.

Ids become conversations, conversations become turns (``explode``), turns
become messages (``inline``).  Texts are expressions over seeded draws, so the
whole path from ids to the message table has no shuffle except the optional
exact turn-count allocation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from palaver.functions.content import media_content
from palaver.functions.draws import draw, uniform_int, weighted_choice
from palaver.functions.text import bind, fit_words, words
from palaver.functions.synth import Draws, extension_words
from palaver.operators.scan import hash_rank

KEY = "conv_id"

# Reply length ranges in words, and their weights by phase.
LENGTH_RANGES = {"short": (20, 80), "medium": (80, 250), "long": (250, 600)}
LENGTH_WEIGHTS = {
    "early": {"short": 0.3, "medium": 0.5, "long": 0.2},
    "middle": {"short": 0.2, "medium": 0.4, "long": 0.4},
    "late": {"short": 0.1, "medium": 0.3, "long": 0.6},
}
CHAT_PHASES = (5, 20)
MEDIA_PHASES = (3, 15)

TurnBucket = tuple[int, int, int]


def new_ids(spark: SparkSession, n: int) -> DataFrame:
    """``n`` conversation ids, generated in parallel."""
    return spark.range(n).select(F.col("id").alias(KEY))


def with_topic(ids: DataFrame, weights: Mapping[str, float], seed: int,
               name: str = "topic") -> DataFrame:
    return ids.withColumn(name, weighted_choice(draw(seed, name, F.col(KEY)), weights))


def uniform_turns(ids: DataFrame, low: int, high: int, seed: int) -> DataFrame:
    """Turn count uniform in [low, high]."""
    return ids.withColumn("num_turns", uniform_int(draw(seed, "turns", F.col(KEY)), low, high))


def _turns_in_bucket(bucket: Column, buckets: Sequence[TurnBucket], seed: int) -> Column:
    out = None
    for i, (_, low, high) in enumerate(buckets):
        value = uniform_int(draw(seed, "turns", F.col(KEY)), low, high)
        out = F.when(bucket == i, value) if out is None else out.when(bucket == i, value)
    return out


def allocated_turns(ids: DataFrame, buckets: Sequence[TurnBucket], seed: int) -> DataFrame:
    """Fixed share of conversations per turn bucket, uniform inside it.

    Buckets are ``(count, low, high)``.  Counts are scaled to the number of
    ids (and met exactly when they add up to it); which conversation falls
    into which bucket follows the seeded order.
    """
    whole = sum(count for count, _, _ in buckets)
    drawn = ids.withColumn("_d", draw(seed, "bucket", F.col(KEY)))
    placed = hash_rank(drawn, [], "_d", [KEY], "_place", total="_all")
    bucket, running = F.lit(len(buckets) - 1), 0
    bounds = []
    for count, _, _ in buckets[:-1]:
        running += count
        bounds.append(running)
    for i in range(len(bounds) - 1, -1, -1):
        limit = F.call_function("div", F.col("_all") * F.lit(bounds[i]).cast("bigint"),
                                F.lit(whole).cast("bigint"))
        bucket = F.when(F.col("_place") <= limit, F.lit(i)).otherwise(bucket)
    return (placed.withColumn("num_turns", _turns_in_bucket(bucket, buckets, seed))
            .drop("_d", "_place", "_all"))


def free_bucket_turns(ids: DataFrame, buckets: Sequence[TurnBucket], seed: int) -> DataFrame:
    """Every bucket equally likely whatever its count, uniform inside it."""
    bucket = F.pmod(draw(seed, "bucket", F.col(KEY)), F.lit(len(buckets)))
    return ids.withColumn("num_turns", _turns_in_bucket(bucket, buckets, seed))


def turn_rows(plan: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row per turn, numbered from zero.

    Plans are tiny next to the texts made from them: ``partitions`` spreads
    them over that many tasks first.
    """
    if partitions is not None:
        plan = plan.repartition(partitions, KEY)
    return plan.withColumn("turn_no", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.col("num_turns") - 1)))


def with_target_words(turns: DataFrame, seed: int, phases: tuple[int, int] = CHAT_PHASES,
                      weights: Mapping[str, Mapping[str, float]] = LENGTH_WEIGHTS,
                      ranges: Mapping[str, tuple[int, int]] = LENGTH_RANGES) -> DataFrame:
    """Reply length class by phase of the conversation, and target words."""
    at = (F.col(KEY), F.col("turn_no"))
    drawn = draw(seed, "length", *at)
    first, second = phases
    bucket = (F.when(F.col("turn_no") < first, weighted_choice(drawn, weights["early"]))
              .when(F.col("turn_no") < second, weighted_choice(drawn, weights["middle"]))
              .otherwise(weighted_choice(drawn, weights["late"])))
    target = None
    for name, (low, high) in ranges.items():
        value = uniform_int(draw(seed, "target", *at), low, high)
        hit = F.col("length_class") == name
        target = F.when(hit, value) if target is None else target.when(hit, value)
    return turns.withColumn("length_class", bucket).withColumn("target_words", target)


def pick_from_table(rows: DataFrame, pool: DataFrame, pool_id: str, drawn: Column,
                    seed: int, by: Sequence[str] = ()) -> DataFrame:
    """Join every row with one uniformly drawn row of a pool table.

    Pool rows are numbered per ``by`` group in seeded order; the join is an
    equi-join on the drawn number, broadcast by Spark when the pool is small
    and shuffled on evenly spread numbers when it is not.
    """
    by = list(by)
    numbered = hash_rank(pool.withColumn("_pd", draw(seed, "pool", F.col(pool_id))),
                         by, "_pd", [pool_id], "_no").drop("_pd")
    if by:
        # Groups are few (kinds, topics), so their sizes are one value, not a join on few keys.
        group = F.struct(*by)
        sizes = pool.dropna(subset=by).groupBy(group.alias("g")).agg(F.count(F.lit(1)).alias("n"))
        held = sizes.agg(F.map_from_entries(F.collect_list(F.struct("g", "n")))).scalar()
        size = F.try_element_at(held, group)
    else:
        size = pool.agg(F.count(F.lit(1))).scalar()
    wanted = rows.withColumn("_no", F.pmod(drawn, size) + 1)
    return wanted.join(numbered, [*by, "_no"]).drop("_no")


def by_turn_kind(turns: DataFrame) -> DataFrame:
    """``kind``: opener for the first turn, followup afterwards."""
    return turns.withColumn("kind", F.when(F.col("turn_no") == 0, "opener").otherwise("followup"))


def sized_reply(text: Column, target: Column, extensions: Column, d: Draws,
                pad_then_trim: bool = False, use_up: bool = False) -> Column:
    """A reply brought to its target length with drawn extension sentences.

    With ``use_up`` every extension is used once, in a seeded order, before any is
    drawn again.
    """
    # Bound, as every step of the extension reads ``missing`` and the fit reads both others often.
    def fit(reply: Column) -> Column:
        missing = F.greatest(F.lit(0).cast("bigint"), target - F.size(words(reply)))
        extension = bind(missing, lambda n: extension_words(extensions, d, n, use_up))
        return bind(extension, lambda added: fit_words(reply, added, target, pad_then_trim))

    return bind(text, fit)


def chat_messages(turns: DataFrame, system_prompt: Column, user_text: Column,
                  reply_text: Column, media_kind: str | None = None,
                  media_url: Column | None = None) -> DataFrame:
    """The message table of generated turns.

    The system message is turn 0, then user and assistant alternate.  With
    ``media_kind`` the first user message becomes a part list with the media.
    """
    user = user_text
    if media_kind is not None:
        user = F.when(F.col("turn_no") == 0,
                      media_content(user_text, media_kind, media_url)).otherwise(user_text)
    base = F.col("turn_no") * 2
    entries = F.array(
        F.struct(F.lit(0).cast("bigint").alias("turn"), F.lit("system").alias("role"),
                 F.coalesce(system_prompt, F.lit("")).alias("text")),
        F.struct((base + 1).alias("turn"), F.lit("user").alias("role"), user.alias("text")),
        F.struct((base + 2).alias("turn"), F.lit("assistant").alias("role"),
                 reply_text.alias("text")))
    wanted = F.when(F.col("turn_no") == 0, entries).otherwise(F.slice(entries, 2, 2))
    return turns.select(KEY, F.inline(wanted))
