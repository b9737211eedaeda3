"""Payload scores, ranking and time estimates."""

from pyspark.sql import functions as F

from palaver.operators import payload as p
from palaver.plans import profile as plans
from registry.base import CONV_CTE, RUN_CTE, query, r6, task_runs, tool_log, typed_conversations, typed_sizes

SUMS = """count(*) AS n, sum(estimated_tokens) AS t, sum(total_characters) AS c,
       sum(num_turns) AS r, coalesce(avg(growth_ratio), 0.0) AS g, sum(num_tool_calls) AS x"""


def score_sql(source: str, kind: str = "dataset_type") -> str:
    """The score formula over a CTE with columns n, t, c, r, g, x."""
    return f"""
raw AS (
  SELECT *, t::DOUBLE AS f1, c::DOUBLE / n AS f2,
         CASE WHEN {kind} IN ('pdf', 'image') THEN 1.5 ELSE 0.0 END::DOUBLE AS f3, g AS f4,
         0.4::DOUBLE * t AS d1, r::DOUBLE AS d2, r::DOUBLE / n AS d3,
         CASE WHEN {kind} = 'agentic' THEN 0.1 * x ELSE 0.0 END::DOUBLE AS d4
  FROM {source}),
scored AS (
  SELECT *, least(f1 / 1e7, 1) * 0.4 + least(f2 / 5e4, 1) * 0.3 + least(f3 / 2.0, 1) * 0.2
            + least(f4 / 10.0, 1) * 0.1 AS pre,
         least(d1 / 5e6, 1) * 0.4 + least(d2 / 1e4, 1) * 0.3 + least(d3 / 50.0, 1) * 0.2
            + least(d4 / 10.0, 1) * 0.1 AS dec
  FROM raw)"""


PAYLOAD_SQL = f"""WITH {CONV_CTE},
agg AS (SELECT dataset_type, {SUMS} FROM conv GROUP BY dataset_type),
{score_sql('agg')}
SELECT dataset_type, n AS conversations, round(pre, 6) AS prefill_score,
       round(dec, 6) AS decode_score, round(0.5 * pre + 0.5 * dec, 6) AS total_payload_score
FROM scored"""


def payload_rank_frame(spark, sf_dir):
    out = p.ranked_payloads(typed_conversations(spark, sf_dir), breakdown=False)
    return out.select("dataset_type", "conversations", *[
        r6(c).alias(c) for c in ("prefill_score", "decode_score", "total_payload_score")])


@query("payload_rank", PAYLOAD_SQL)
def payload_rank(spark, sf_dir):
    return payload_rank_frame(spark, sf_dir)


@query("payload_breakdown", f"""WITH {CONV_CTE},
agg AS (SELECT dataset_type, {SUMS} FROM conv GROUP BY dataset_type),
{score_sql('agg')}
SELECT dataset_type, round(f1, 6) AS prefill_total_tokens,
       round(least(f1 / 1e7, 1), 6) AS prefill_total_tokens_norm,
       round(f2, 6) AS prefill_avg_context_size,
       round(least(f2 / 5e4, 1), 6) AS prefill_avg_context_size_norm,
       f3 AS prefill_multimodal_penalty, f3 / 2.0 AS prefill_multimodal_penalty_norm,
       round(f4, 6) AS prefill_context_growth,
       round(least(f4 / 10.0, 1), 6) AS prefill_context_growth_norm,
       round(d1, 6) AS decode_total_response_tokens,
       round(least(d1 / 5e6, 1), 6) AS decode_total_response_tokens_norm,
       round(d2, 6) AS decode_num_turns, round(least(d2 / 1e4, 1), 6) AS decode_num_turns_norm,
       round(d3, 6) AS decode_avg_response_length,
       round(least(d3 / 50.0, 1), 6) AS decode_avg_response_length_norm,
       round(d4, 6) AS decode_tool_call_penalty,
       round(least(d4 / 10.0, 1), 6) AS decode_tool_call_penalty_norm
FROM scored""")
def payload_breakdown(spark, sf_dir):
    out = p.payload_scores(typed_conversations(spark, sf_dir))
    return out.select("dataset_type", *[r6(c).alias(c) for c in out.columns[5:]])


@query("payload_whole", f"""WITH {CONV_CTE},
agg AS (SELECT 'mixed' AS dataset_type, {SUMS} FROM conv),
{score_sql('agg')}
SELECT dataset_type, n AS conversations, round(pre, 6) AS prefill_score,
       round(dec, 6) AS decode_score, round(0.3 * pre + 0.7 * dec, 6) AS total_payload_score
FROM scored""")
def payload_whole(spark, sf_dir):
    conv = typed_conversations(spark, sf_dir).withColumn("dataset_type", F.lit("mixed"))
    out = p.payload_scores(conv, breakdown=False, balance=0.3)
    return out.select("dataset_type", "conversations", *[
        r6(c).alias(c) for c in ("prefill_score", "decode_score", "total_payload_score")])


@query("payload_by_message", f"""WITH {CONV_CTE},
perm AS (SELECT conv_id, count(*) AS k, min(cum_chars) AS a, max(cum_chars) AS b
         FROM scan GROUP BY conv_id),
fixed AS (SELECT c.* EXCLUDE (growth_ratio),
                 CASE WHEN p.k >= 2 THEN CASE WHEN p.a > 0 THEN p.b::DOUBLE / p.a ELSE 0.0 END END
                   AS growth_ratio FROM conv c JOIN perm p USING (conv_id)),
agg AS (SELECT dataset_type, {SUMS} FROM fixed GROUP BY dataset_type),
{score_sql('agg')}
SELECT dataset_type, round(g, 6) AS context_growth,
       round(0.5 * pre + 0.5 * dec, 6) AS total_payload_score FROM scored""")
def payload_by_message(spark, sf_dir):
    out = p.payload_scores(typed_conversations(spark, sf_dir, "message"))
    return out.select("dataset_type", r6("prefill_context_growth").alias("context_growth"),
                      r6("total_payload_score").alias("total_payload_score"))


@query("time_est", f"""WITH {CONV_CTE},
t AS (SELECT dataset_type, count(*) AS conversations,
             sum(estimated_tokens)::BIGINT AS total_tokens FROM conv GROUP BY dataset_type),
s AS (SELECT *, total_tokens / 100.0::DOUBLE AS total_seconds FROM t)
SELECT dataset_type, conversations, total_tokens, round(total_seconds, 6) AS total_seconds,
       (floor(total_seconds)::BIGINT // 3600) AS hours,
       (floor(total_seconds)::BIGINT % 3600) // 60 AS minutes,
       floor(total_seconds)::BIGINT % 60 AS seconds, w::BIGINT AS workers,
       round(total_seconds / w / 60.0, 6) AS minutes_at_workers
FROM s CROSS JOIN (VALUES (1), (5), (10), (20)) AS v(w)""")
def time_est(spark, sf_dir):
    out = plans.time_estimate(typed_sizes(spark, sf_dir))
    return (out.withColumn("total_seconds", r6("total_seconds"))
            .withColumn("minutes_at_workers", r6("minutes_at_workers")))


@query("side_by_side", f"""WITH {CONV_CTE},
s AS (SELECT dataset_type, count(*)::DOUBLE AS conversations, min(num_turns)::DOUBLE AS turns_min,
       max(num_turns)::DOUBLE AS turns_max, avg(num_turns) AS turns_mean,
       sum(estimated_tokens)::DOUBLE AS tokens_total, avg(estimated_tokens) AS tokens_mean,
       max(estimated_tokens)::DOUBLE AS tokens_max,
       coalesce(avg(growth_ratio), 0.0)::DOUBLE AS growth_mean FROM conv GROUP BY dataset_type),
u AS (UNPIVOT s ON conversations, turns_min, turns_max, turns_mean, tokens_total, tokens_mean,
      tokens_max, growth_mean INTO NAME metric VALUE value)
SELECT metric, """ + ", ".join(
    f"round(max(value) FILTER (dataset_type = '{t}'), 6) AS {t}"
    for t in ("text", "pdf", "image", "reasoning", "agentic")) + " FROM u GROUP BY metric")
def side_by_side(spark, sf_dir):
    types = ["text", "pdf", "image", "reasoning", "agentic"]
    out = plans.side_by_side(typed_conversations(spark, sf_dir), types)
    return out.select("metric", *[r6(t).alias(t) for t in types])


@query("run_summary", f"""WITH {CONV_CTE},
s AS (SELECT dataset_type, count(*)::DOUBLE AS conversations, min(num_turns)::DOUBLE AS turns_min,
       max(num_turns)::DOUBLE AS turns_max, avg(num_turns) AS turns_mean,
       sum(estimated_tokens)::DOUBLE AS tokens_total, avg(estimated_tokens) AS tokens_mean,
       max(estimated_tokens)::DOUBLE AS tokens_max FROM conv GROUP BY dataset_type),
u AS (UNPIVOT s ON conversations, turns_min, turns_max, turns_mean, tokens_total, tokens_mean,
      tokens_max INTO NAME metric VALUE value)
SELECT dataset_type, 'size' AS section, metric, round(value, 6) AS value FROM u
UNION ALL
SELECT dataset_type, 'category', topic,
       round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY dataset_type), 6)
FROM conv GROUP BY dataset_type, topic""")
def run_summary(spark, sf_dir):
    out = plans.run_summary(typed_sizes(spark, sf_dir), "dataset_type", "topic")
    return out.withColumn("value", r6("value"))


@query("payload_runs", f"""WITH {RUN_CTE},
firsts AS (SELECT conv_id, min_by(length(props), seq) AS first_chars FROM log GROUP BY conv_id),
grown AS (SELECT runs.*, CASE WHEN num_tool_calls >= 2 THEN CASE WHEN first_chars > 0
            THEN total_characters::DOUBLE / first_chars ELSE 0.0 END END AS growth_ratio
          FROM runs JOIN firsts USING (conv_id)),
agg AS (SELECT task_type, count(*) AS n, sum(estimated_tokens) AS t, sum(total_characters) AS c,
        sum(num_turns) AS r, coalesce(avg(growth_ratio), 0.0) AS g, sum(num_tool_calls) AS x
        FROM grown GROUP BY task_type),
{score_sql('agg', "'agentic'")}
SELECT task_type, n AS conversations, round(pre, 6) AS prefill_score,
       round(dec, 6) AS decode_score, round(0.5 * pre + 0.5 * dec, 6) AS total_payload_score
FROM scored""")
def payload_runs(spark, sf_dir):
    first = tool_log(spark, sf_dir).groupBy("conv_id").agg(
        F.min_by(F.length("props"), "seq").alias("first_chars"))
    grown = F.when(F.col("first_chars") > 0, F.col("total_characters") / F.col("first_chars")).otherwise(0.0)
    runs = task_runs(spark, sf_dir).join(first, "conv_id").withColumn(
        "growth_ratio", F.when(F.col("num_tool_calls") >= 2, grown))
    out = p.payload_scores(runs, "task_type", kind=F.lit("agentic"), breakdown=False)
    return out.select("task_type", "conversations", *[
        r6(c).alias(c) for c in ("prefill_score", "decode_score", "total_payload_score")])


