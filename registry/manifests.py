"""Tags and manifests."""

from pyspark.sql import functions as F

from palaver.operators import tags as tg
from palaver.operators import metrics as m
from palaver.plans.manifest import build_manifests, distribution_profile
from registry.base import (CONV_CTE, RUN_CTE, SEED, query, table, task_runs, typed_conversations,
                           typed_sizes)
from registry.distributions import LONG_CTE
from registry.payloads import SUMS, score_sql

TAG_CTE = CONV_CTE + """,
facts AS (SELECT dataset_type, count(*) AS n, sum(estimated_tokens) AS tok, max(num_turns) AS mt
          FROM conv GROUP BY dataset_type),
lists AS (SELECT *, ['synthetic', 'multi-turn', 'benchmarking', 'inference', 'prefix-caching',
    dataset_type,
    CASE WHEN n <= 100 THEN 'small' WHEN n <= 500 THEN 'medium' ELSE 'large' END,
    'n' || n,
    CASE WHEN tok < 1000000 THEN 'sub-1M-tokens' WHEN tok < 5000000 THEN '1M-5M-tokens'
         ELSE '5M+-tokens' END,
    CASE WHEN mt <= 5 THEN 'short-context' WHEN mt <= 15 THEN 'medium-context'
         WHEN mt <= 30 THEN 'long-context' ELSE 'very-long-context' END]
   || CASE dataset_type WHEN 'agentic' THEN ['tool-use', 'agent-tasks'] WHEN 'pdf' THEN ['multimodal']
      WHEN 'image' THEN ['multimodal'] WHEN 'reasoning' THEN ['deep-reasoning'] ELSE [] END AS auto
  FROM facts),
tagged AS (SELECT *, list_sort(list_distinct(auto || ['chat', 'synthetic'])) AS all_tags FROM lists)"""


def _tagged(spark, sf_dir):
    return tg.dataset_tags(typed_sizes(spark, sf_dir), user_tags=["chat", "synthetic"])


@query("auto_tags", f"""WITH {TAG_CTE}
SELECT dataset_type, n AS conversations, tok::BIGINT AS total_tokens,
       array_to_string(auto, ',') AS auto_tags, array_to_string(all_tags, ',') AS all_tags
FROM tagged""")
def auto_tags(spark, sf_dir):
    return _tagged(spark, sf_dir).select(
        "dataset_type", "conversations", "total_tokens",
        F.array_join("auto_tags", ",").alias("auto_tags"),
        F.array_join("all_tags", ",").alias("all_tags"))


@query("tag_index", f"""WITH {TAG_CTE},
u AS (SELECT dataset_type, unnest(all_tags) AS tag FROM tagged)
SELECT tag, count(*) OVER (PARTITION BY tag) AS datasets, dataset_type AS member FROM u""")
def tag_index(spark, sf_dir):
    return tg.tag_index(_tagged(spark, sf_dir))


@query("tag_filter", f"""WITH {TAG_CTE}
SELECT dataset_type, n AS conversations, tok::BIGINT AS total_tokens FROM tagged
WHERE list_has_all(all_tags, ['multimodal', 'synthetic'])""")
def tag_filter(spark, sf_dir):
    return tg.with_all_tags(_tagged(spark, sf_dir), ["multimodal", "synthetic"]).select(
        "dataset_type", "conversations", "total_tokens")


_H = """(SELECT string_agg(printf('%.1f-%.1f', lo + i * (hi - lo) / k, lo + (i + 1) * (hi - lo) / k)
   || ':' || (SELECT count(*) FROM long l WHERE l.dataset_type = b.dataset_type
        AND l.metric = 'estimated_tokens' AND l.value >= lo + i * ((hi - lo) / k)
        AND (l.value < lo + (i + 1) * ((hi - lo) / k) OR i = k - 1)), ';' ORDER BY i)
   FROM (SELECT unnest(range(10)) AS i, 10 AS k))"""


@query("manifest", f"""WITH {LONG_CTE},
agg AS (SELECT dataset_type, {SUMS} FROM conv GROUP BY dataset_type),
{score_sql('agg')},
s AS (SELECT dataset_type, count(*) AS n, min(num_turns) AS turns_min, max(num_turns) AS turns_max,
        avg(num_turns) AS turns_mean, median(num_turns) AS turns_median,
        sum(estimated_tokens)::BIGINT AS tokens_total,
        quantile_cont(estimated_tokens, 0.95) AS tokens_p95,
        coalesce(stddev_samp(total_characters), 0.0) AS chars_stdev,
        avg(num_messages) AS messages_mean, avg(growth_ratio) AS growth_mean,
        count(*) FILTER (num_turns <= 5) AS short_turns FROM conv GROUP BY dataset_type),
b AS (SELECT dataset_type, min(value) AS lo, max(value) AS hi FROM long
      WHERE metric = 'estimated_tokens' GROUP BY dataset_type),
c AS (SELECT dataset_type, string_agg(topic || ':' || n, ';' ORDER BY n DESC, topic) AS categories
      FROM (SELECT dataset_type, topic, count(*) AS n FROM conv
            WHERE dataset_type IN ('text', 'reasoning') GROUP BY ALL) GROUP BY dataset_type)
SELECT s.dataset_type, 'multi_turn_' || s.dataset_type || '_chat_n' || s.n || '_s42_v1.0.0_20260102'
         AS descriptive_name,
       s.n AS conversations, turns_min, turns_max, round(turns_mean, 2) AS turns_mean,
       round(turns_median, 2) AS turns_median, tokens_total, round(tokens_p95, 2) AS tokens_p95,
       round(chars_stdev, 2) AS chars_stdev, round(messages_mean, 2) AS messages_mean,
       round(growth_mean, 2) AS growth_mean, short_turns, {_H} AS token_histogram, categories,
       round(0.5 * pre + 0.5 * dec, 4) AS total_payload_score
FROM s JOIN b USING (dataset_type) LEFT JOIN c USING (dataset_type)
  JOIN scored x ON x.dataset_type = s.dataset_type""")
def manifest(spark, sf_dir):
    out = build_manifests(typed_conversations(spark, sf_dir), seed=SEED,
                          day=F.to_date(F.lit("2026-01-02")))
    d = "distribution_profile"
    return out.select(
        F.col("dataset.type").alias("dataset_type"),
        F.col("dataset.descriptive_name").alias("descriptive_name"),
        F.col("dataset.num_conversations").alias("conversations"),
        F.col(f"{d}.turn_distribution.min").alias("turns_min"),
        F.col(f"{d}.turn_distribution.max").alias("turns_max"),
        F.col(f"{d}.turn_distribution.mean").alias("turns_mean"),
        F.col(f"{d}.turn_distribution.median").alias("turns_median"),
        F.col(f"{d}.token_distribution.total").alias("tokens_total"),
        F.col(f"{d}.token_distribution.percentiles.p95").alias("tokens_p95"),
        F.col(f"{d}.character_distribution.stdev").alias("chars_stdev"),
        F.col(f"{d}.message_count_distribution.mean").alias("messages_mean"),
        F.col(f"{d}.context_growth.growth_ratio.mean").alias("growth_mean"),
        F.col(f"{d}.turn_distribution.bucket_distribution")[0]["count"].alias("short_turns"),
        F.array_join(F.transform(f"{d}.token_distribution.histogram", lambda b: F.concat_ws(
            ":", b["range"], b["count"].cast("string"))), ";").alias("token_histogram"),
        F.array_join(F.transform(f"{d}.category_distribution.distribution", lambda c: F.concat_ws(
            ":", c["value"], c["count"].cast("string"))), ";").alias("categories"),
        F.col("payload_scores.total_payload_score").alias("total_payload_score"))


def _without_growth(rows):
    """Rows without a message list: no context entries."""
    none = F.lit(None).cast("double")
    return rows.withColumns({"growth_ratio": none, "first_chars": none, "last_chars": none})


_TOP = "string_agg({0} || ':' || n, ';' ORDER BY n DESC, {0})"


@query("manifest_agentic", f"""WITH {RUN_CTE},
h AS (SELECT min(success_score) AS lo, max(success_score) AS hi FROM runs),
c AS (SELECT task_type, count(*) AS n FROM runs GROUP BY task_type)
SELECT count(*) AS conversations, round(min(success_score), 4) AS score_min,
       round(max(success_score), 4) AS score_max, round(avg(success_score), 4) AS score_mean,
       round(median(success_score), 4) AS score_median,
       (SELECT string_agg(printf('%.1f-%.1f', lo + i * (hi - lo) / 5, lo + (i + 1) * (hi - lo) / 5)
          || ':' || (SELECT count(*) FROM runs r WHERE r.success_score >= lo + i * ((hi - lo) / 5)
            AND (r.success_score < lo + (i + 1) * ((hi - lo) / 5) OR i = 4)), ';' ORDER BY i)
        FROM (SELECT unnest(range(5)) AS i), h) AS score_histogram,
       sum(num_tool_calls)::BIGINT AS calls, round(avg(num_tool_calls), 2) AS calls_mean,
       max(num_tool_calls) AS calls_max, sum(num_errors)::BIGINT AS errors,
       round(100.0::DOUBLE * sum(num_errors) / sum(num_tool_calls), 2) AS error_rate,
       (SELECT {_TOP.format('task_type')} FROM c) AS tasks,
       sum(estimated_tokens)::BIGINT AS tokens_total
FROM runs""")
def manifest_agentic(spark, sf_dir):
    """The agentic section of a profile, from the tool-call log."""
    rows = _without_growth(task_runs(spark, sf_dir)).withColumn("dataset_type", F.lit("agentic"))
    p = "distribution_profile"
    a = f"{p}.agentic_metrics"
    return distribution_profile(rows).select(
        "conversations", *[F.col(f"{a}.success_score.{x}").alias(f"score_{x}")
                           for x in ("min", "max", "mean", "median")],
        F.array_join(F.transform(f"{a}.success_score.histogram", lambda b: F.concat_ws(
            ":", b["range"], b["count"].cast("string"))), ";").alias("score_histogram"),
        F.col(f"{a}.tool_calls.total").alias("calls"),
        F.col(f"{a}.tool_calls.mean_per_conversation").alias("calls_mean"),
        F.col(f"{a}.tool_calls.max_per_conversation").alias("calls_max"),
        F.col(f"{a}.errors.total").alias("errors"), F.col(f"{a}.errors.error_rate").alias("error_rate"),
        F.array_join(F.transform(f"{p}.category_distribution.distribution", lambda c: F.concat_ws(
            ":", c["value"], c["count"].cast("string"))), ";").alias("tasks"),
        F.col(f"{p}.token_distribution.total").alias("tokens_total"))


_PAGES_CTE = """media AS (
  SELECT CASE WHEN page_id % 3 = 0 THEN 'pdf' ELSE 'image' END AS dataset_type, url,
         regexp_extract(url, '://([^/?#]*)', 1) AS topic, length(html) AS chars,
         1 + page_id % 7 AS turns,
         CASE WHEN page_id % 2 = 0 THEN 'single' ELSE 'several' END AS conversation_type FROM pages)"""


@query("manifest_multimodal", f"""WITH {_PAGES_CTE},
t AS (SELECT dataset_type, topic, count(*) AS n FROM media WHERE dataset_type = 'image' GROUP BY ALL),
k AS (SELECT dataset_type, conversation_type AS kind, count(*) AS n FROM media GROUP BY ALL)
SELECT dataset_type, count(*) AS conversations,
       CASE WHEN dataset_type = 'pdf' THEN count(DISTINCT url) END AS papers,
       CASE WHEN dataset_type = 'image' THEN count(DISTINCT url) END AS images,
       (SELECT {_TOP.format('topic')} FROM t WHERE t.dataset_type = media.dataset_type) AS topics,
       (SELECT {_TOP.format('kind')} FROM k WHERE k.dataset_type = media.dataset_type) AS kinds,
       round(quantile_cont(chars, 0.99), 2) AS chars_p99, round(avg(turns), 2) AS turns_mean
FROM media GROUP BY dataset_type""")
def manifest_multimodal(spark, sf_dir):
    """The multimodal sections of profiles, from the pages as documents and images."""
    page = F.col("page_id")
    turns = (page % 7 + 1).cast("bigint")
    rows = table(spark, sf_dir, "pages").select(
        F.when(page % 3 == 0, "pdf").otherwise("image").alias("dataset_type"),
        F.col("url").alias("paper_arxiv_id"), F.col("url").alias("image_url"),
        F.regexp_extract("url", "://([^/?#]*)", 1).alias("image_topic"),
        F.when(page % 2 == 0, "single").otherwise("several").alias("conversation_type"),
        turns.alias("num_turns"), (turns * 2 + 1).alias("num_messages"),
        F.length("html").cast("bigint").alias("total_characters"))
    rows = _without_growth(rows.withColumn("estimated_tokens", m.tokens(F.col("total_characters"))))

    def listed(column):
        return F.array_join(F.transform(column, lambda c: F.concat_ws(
            ":", c["value"], c["count"].cast("string"))), ";")

    p = "distribution_profile"
    return distribution_profile(rows).select(
        "dataset_type", "conversations", F.col(f"{p}.multimodal_info.unique_papers").alias("papers"),
        F.col(f"{p}.multimodal_info.unique_images").alias("images"),
        listed(F.col(f"{p}.multimodal_info.image_topic_distribution")).alias("topics"),
        listed(F.col(f"{p}.category_distribution.distribution")).alias("kinds"),
        F.col(f"{p}.character_distribution.percentiles.p99").alias("chars_p99"),
        F.col(f"{p}.turn_distribution.mean").alias("turns_mean"))
