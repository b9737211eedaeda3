"""Query registration and the derived inputs shared by the registered queries.

The test tables stand in for chat datasets: ``conversations`` is the message
table, dataset type and topic are seeded draws over the conversation id, and
``events`` is a tool-call log (one run per user and day).  Each Spark helper
has an SQL twin for the check queries.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from palaver.functions.draws import cumulative, draw, unit, weighted_choice
from palaver.operators import metrics as m
from palaver.operators import toollog

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

SEED = 42

# Default source weights, text topics and task types.
SOURCE_WEIGHTS = {"text": 0.25, "pdf": 0.20, "image": 0.20, "reasoning": 0.20, "agentic": 0.15}
TOPIC_WEIGHTS = {
    "customer_support": 0.15, "coding_help": 0.20, "creative_writing": 0.10, "tutoring": 0.15,
    "travel_planning": 0.10, "data_analysis": 0.10, "business_strategy": 0.10,
    "health_fitness": 0.10,
}
TASK_WEIGHTS = {
    "data_processing": 0.20, "api_integration": 0.20, "system_troubleshooting": 0.15,
    "code_generation": 0.15, "research_synthesis": 0.15, "planning_execution": 0.15,
}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can say it, its check query."""
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def r6(column: Column | str) -> Column:
    """Round a DOUBLE whose summation order may differ between engines."""
    return F.round(column if isinstance(column, Column) else F.col(column), 6)


def type_of(key: Column) -> Column:
    return weighted_choice(draw(SEED, "type", key), SOURCE_WEIGHTS)


def topic_of(key: Column) -> Column:
    return weighted_choice(draw(SEED, "topic", key), TOPIC_WEIGHTS)


def typed_messages(spark, sf_dir) -> DataFrame:
    return messages(spark, sf_dir).withColumn("dataset_type", type_of(F.col("conv_id")))


def typed_conversations(spark, sf_dir, granularity: str = "turn") -> DataFrame:
    """Conversation metrics with dataset type, topic and a tool-call count."""
    conv = m.conversation_metrics(messages(spark, sf_dir), granularity)
    calls = F.when(F.col("dataset_type") == "agentic",
                   F.pmod(draw(SEED, "calls", F.col("conv_id")), F.lit(4))).otherwise(F.lit(0))
    return (conv.withColumn("dataset_type", type_of(F.col("conv_id")))
            .withColumn("topic", topic_of(F.col("conv_id")))
            .withColumn("num_tool_calls", calls.cast("bigint")))


def typed_sizes(spark, sf_dir) -> DataFrame:
    """Conversation sizes with dataset type and topic; one aggregate, no context scan."""
    return (m.basic_metrics(messages(spark, sf_dir))
            .withColumn("dataset_type", type_of(F.col("conv_id")))
            .withColumn("topic", topic_of(F.col("conv_id"))))


def tool_log(spark, sf_dir) -> DataFrame:
    """``events`` as a tool-call log: one run per user and calendar day."""
    failed = F.pmod(draw(SEED, "st", F.col("event_id")), F.lit(100)) < 15
    return table(spark, sf_dir, "events").select(
        F.concat_ws("-", F.col("user_id"), F.date_format("ts", "yyyyMMdd")).alias("conv_id"),
        F.col("event_id").alias("seq"), F.col("event_type").alias("tool"),
        F.when(failed, "error").otherwise("success").alias("status"), "props")


def task_runs(spark, sf_dir) -> DataFrame:
    """Agentic conversation rows: calls, errors, task type, turns and score."""
    runs = toollog.run_counts(tool_log(spark, sf_dir), extra_chars="props")
    key = F.col("conv_id")
    runs = (runs
            .withColumn("task_type", weighted_choice(draw(SEED, "task", key), TASK_WEIGHTS))
            .withColumn("num_turns", F.lit(2) + F.pmod(draw(SEED, "turns", key), F.lit(14)))
            .withColumn("num_messages", F.col("num_turns") * 2 + 1)
            .withColumn("base_score", F.lit(0.7) + F.lit(0.3) * unit(draw(SEED, "base", key))))
    return toollog.with_success(runs)


# SQL twins ---------------------------------------------------------------

def sql_draw(salt: str, *cols: str) -> str:
    parts = ", ".join(cols)
    return f"(('0x' || substr(md5(concat_ws('|', '{SEED}', {parts}, '{salt}')), 1, 8))::BIGINT)"


def sql_unit(salt: str, *cols: str) -> str:
    return f"({sql_draw(salt, *cols)}::DOUBLE / 4294967296.0::DOUBLE)"


def sql_choice(unit_sql: str, weights: dict[str, float]) -> str:
    steps = cumulative(weights)
    cases = " ".join(f"WHEN {unit_sql} < {bound!r}::DOUBLE THEN '{name}'"
                     for name, bound in steps[:-1])
    return f"(CASE {cases} ELSE '{steps[-1][0]}' END)"


TYPE_SQL = sql_choice(sql_unit("type", "conv_id"), SOURCE_WEIGHTS)
TOPIC_SQL = sql_choice(sql_unit("topic", "conv_id"), TOPIC_WEIGHTS)

SCAN_CTE = """scan AS (
  SELECT conv_id, turn, role, text, length(text) AS n_chars,
         sum(length(text)) OVER w AS cum_chars,
         row_number() OVER w AS position,
         sum(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) OVER w AS reply_no,
         count(*) OVER (PARTITION BY conv_id) AS num_messages
  FROM conversations
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING))"""

CONV_CTE = SCAN_CTE + f""",
conv0 AS (
  SELECT conv_id, count(*) AS num_messages,
         count(*) FILTER (role = 'assistant') AS num_turns,
         sum(n_chars)::BIGINT AS total_characters,
         count(*) FILTER (role = 'assistant') AS num_entries,
         (min(cum_chars) FILTER (role = 'assistant'))::BIGINT AS first_chars,
         (max(cum_chars) FILTER (role = 'assistant'))::BIGINT AS last_chars
  FROM scan GROUP BY conv_id),
conv AS (
  SELECT *, (total_characters // 4)::BIGINT AS estimated_tokens,
         CASE WHEN num_entries >= 2 THEN
              CASE WHEN first_chars > 0 THEN last_chars::DOUBLE / first_chars ELSE 0.0 END
         END AS growth_ratio,
         {TYPE_SQL} AS dataset_type, {TOPIC_SQL} AS topic,
         CASE WHEN {TYPE_SQL} = 'agentic' THEN {sql_draw('calls', 'conv_id')} % 4 ELSE 0
         END::BIGINT AS num_tool_calls
  FROM conv0)"""

LOG_CTE = f"""log AS (
  SELECT concat_ws('-', user_id, strftime(ts, '%Y%m%d')) AS conv_id, event_id AS seq,
         event_type AS tool, props,
         CASE WHEN {sql_draw('st', 'event_id')} % 100 < 15 THEN 'error' ELSE 'success' END AS status
  FROM events)"""

RUN_CTE = LOG_CTE + f""",
runs0 AS (
  SELECT conv_id, count(*) AS num_tool_calls,
         count(*) FILTER (status = 'error') AS num_errors,
         sum(length(props))::BIGINT AS total_characters
  FROM log GROUP BY conv_id),
runs1 AS (
  SELECT *, {sql_choice(sql_unit('task', 'conv_id'), TASK_WEIGHTS)} AS task_type,
         2 + {sql_draw('turns', 'conv_id')} % 14 AS num_turns,
         5 + 2 * ({sql_draw('turns', 'conv_id')} % 14) AS num_messages,
         total_characters // 4 AS estimated_tokens,
         0.7::DOUBLE + 0.3::DOUBLE * {sql_unit('base', 'conv_id')} AS base_score
  FROM runs0),
runs AS (
  SELECT *, greatest(0.0::DOUBLE, least(1.0::DOUBLE,
       base_score * CASE WHEN num_errors > 0 THEN 1.0::DOUBLE - 0.1::DOUBLE * num_errors
                         ELSE 1.0::DOUBLE END
       * CASE WHEN num_turns < 3 THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END)) AS success_score,
       CASE task_type WHEN 'data_processing' THEN 'data_integrity_score'
            WHEN 'api_integration' THEN 'integration_completeness_score'
            WHEN 'system_troubleshooting' THEN 'resolution_success_score'
            WHEN 'code_generation' THEN 'test_pass_rate'
            WHEN 'research_synthesis' THEN 'coverage_completeness_score'
            WHEN 'planning_execution' THEN 'objective_completion_score'
            ELSE 'completion_score' END AS success_metric
  FROM runs1)"""
