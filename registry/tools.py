"""Tool-call log analytics."""

from pyspark.sql import functions as F

from palaver.operators import distribution as d
from palaver.operators import toollog as t
from palaver.plans import profile as plans
from registry.base import LOG_CTE, RUN_CTE, query, r6, task_runs, tool_log


@query("tool_usage", f"""WITH {LOG_CTE}
SELECT coalesce(tool, 'TOTAL') AS tool, count(*) AS count,
       count(*) FILTER (status = 'success') AS success,
       count(*) FILTER (status <> 'success') AS failure,
       100.0::DOUBLE * (count(*) FILTER (status = 'success')) / count(*) AS rate
FROM log GROUP BY ROLLUP (tool)""")
def tool_usage(spark, sf_dir):
    return t.tool_usage(tool_log(spark, sf_dir)).orderBy("tool")


@query("run_counts", f"""WITH {RUN_CTE}
SELECT conv_id, num_tool_calls, num_errors FROM runs""")
def run_counts(spark, sf_dir):
    return t.run_counts(tool_log(spark, sf_dir))


@query("run_tools", f"WITH {LOG_CTE} SELECT conv_id, tool, count(*) AS count FROM log GROUP BY ALL")
def run_tools(spark, sf_dir):
    return t.run_tools(tool_log(spark, sf_dir))


@query("run_success", f"""WITH {RUN_CTE}
SELECT conv_id, num_tool_calls, num_errors,
       CASE WHEN num_tool_calls > 0
            THEN (1.0::DOUBLE - num_errors / num_tool_calls::DOUBLE) * 100 ELSE 100.0 END
         AS success_rate FROM runs""")
def run_success(spark, sf_dir):
    return t.run_success_rate(t.run_counts(tool_log(spark, sf_dir)))


@query("first_calls", f"""WITH {LOG_CTE},
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY seq) AS call_no FROM log)
SELECT conv_id, seq, tool, status, substr(props, 1, 60) AS detail, call_no::INTEGER AS call_no
FROM n WHERE call_no <= 3""")
def first_calls(spark, sf_dir):
    return t.first_calls(tool_log(spark, sf_dir))


def _stored_calls(spark, sf_dir):
    """Runs with their calls as one JSON text; failed calls have an error besides the result."""
    bad = F.col("status") == "error"
    result = F.struct("status", F.when(bad, F.concat(F.lit("failed: "), "props")).alias("error"),
                      F.col("props").alias("result"))
    call = F.struct("seq", "tool", F.struct(F.col("seq").alias("event")).alias("call"),
                    result.alias("result"))
    calls = F.transform(F.array_sort(F.collect_list(call)),
                        lambda c: F.struct(c["tool"].alias("tool"), c["call"].alias("call"),
                                           c["result"].alias("result")))
    return tool_log(spark, sf_dir).groupBy(F.col("conv_id").alias("conversation_id")).agg(
        F.to_json(calls).alias("tool_calls"))


@query("tool_usage_stored", f"""WITH {LOG_CTE}
SELECT coalesce(tool, 'TOTAL') AS tool, count(*) AS count,
       count(*) FILTER (status = 'success') AS success,
       count(*) FILTER (status <> 'success') AS failure,
       100.0::DOUBLE * (count(*) FILTER (status = 'success')) / count(*) AS rate
FROM log GROUP BY ROLLUP (tool)""")
def tool_usage_stored(spark, sf_dir):
    return t.tool_usage(t.explode_tool_calls(_stored_calls(spark, sf_dir)))


@query("run_tools_stored", f"""WITH {LOG_CTE}
SELECT conv_id, tool, count(*) AS count FROM log GROUP BY ALL""")
def run_tools_stored(spark, sf_dir):
    return t.run_tools(t.explode_tool_calls(_stored_calls(spark, sf_dir)))


@query("first_calls_stored", f"""WITH {LOG_CTE},
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY seq) AS call_no FROM log)
SELECT conv_id, call_no - 1 AS seq, tool, status, call_no::INTEGER AS call_no,
       CASE WHEN status = 'error' THEN 'failed: ' || props ELSE substr(props, 1, 60) END AS detail
FROM n WHERE call_no <= 3""")
def first_calls_stored(spark, sf_dir):
    calls = t.explode_tool_calls(_stored_calls(spark, sf_dir))
    return t.first_calls(calls, detail="detail", width=1_000_000)


@query("success_score", f"""WITH {RUN_CTE}
SELECT conv_id, task_type, num_turns, num_errors, success_metric,
       round(success_score, 9) AS success_score FROM runs""")
def success_score(spark, sf_dir):
    return task_runs(spark, sf_dir).select(
        "conv_id", "task_type", "num_turns", "num_errors", "success_metric",
        F.round("success_score", 9).alias("success_score"))


_PERF = """count(*) AS conversations, avg(num_turns) AS turns_mean, min(num_turns) AS turns_min,
 max(num_turns) AS turns_max, avg(num_tool_calls) AS tools_mean,
 sum(num_tool_calls)::BIGINT AS tools_sum, avg(num_errors) AS errors_mean,
 sum(num_errors)::BIGINT AS errors_sum, avg(success_score) AS score_mean,
 min(success_score) AS score_min, max(success_score) AS score_max,
 avg(estimated_tokens) AS tokens_mean, sum(estimated_tokens)::BIGINT AS tokens_sum,
 100.0::DOUBLE * sum(num_errors) / sum(num_tool_calls) AS error_rate"""
_PERF_ROUND = ("turns_mean", "tools_mean", "errors_mean", "score_mean", "score_min", "score_max",
               "tokens_mean", "error_rate")
_PERF_KEEP = ("conversations", "turns_min", "turns_max", "tools_sum", "errors_sum", "tokens_sum")


@query("task_perf", f"""WITH {RUN_CTE}, a AS (SELECT task_type, {_PERF} FROM runs GROUP BY task_type)
SELECT task_type, {', '.join(_PERF_KEEP)},
       {', '.join(f'round({c}, 6) AS {c}' for c in _PERF_ROUND)} FROM a""")
def task_perf(spark, sf_dir):
    out = t.task_performance(task_runs(spark, sf_dir))
    return out.select("task_type", *_PERF_KEEP, *[r6(c).alias(c) for c in _PERF_ROUND])


def _bands_sql(close: str) -> str:
    return f"""WITH {RUN_CTE},
b(range_no, lo, hi, range) AS (VALUES (0, 0.0, 0.2, '0.0-0.2 (Very Poor)'),
  (1, 0.2, 0.4, '0.2-0.4 (Poor)'), (2, 0.4, 0.6, '0.4-0.6 (Fair)'),
  (3, 0.6, 0.8, '0.6-0.8 (Good)'), (4, 0.8, 1.0, '0.8-1.0 (Excellent)')),
t AS (SELECT count(*) AS n FROM runs)
SELECT range_no::BIGINT AS range_no, range, count(r.conv_id) AS count,
       100.0::DOUBLE * count(r.conv_id) / (SELECT n FROM t) AS percentage
FROM b LEFT JOIN runs r ON r.success_score >= lo::DOUBLE
  AND (r.success_score < hi::DOUBLE {close})
GROUP BY range_no, range"""


@query("score_ranges", _bands_sql("OR (range_no = 4 AND r.success_score <= 1.0)"))
def score_ranges(spark, sf_dir):
    return t.score_bands(task_runs(spark, sf_dir))


@query("score_ranges_half_open", _bands_sql(""))
def score_ranges_half_open(spark, sf_dir):
    return t.score_bands(task_runs(spark, sf_dir), close_last=False)


@query("metric_by_task", f"""WITH {RUN_CTE}
SELECT task_type, min(success_metric) AS metric, round(avg(success_score), 6) AS score_mean,
       round(min(success_score), 6) AS score_min, round(max(success_score), 6) AS score_max
FROM runs GROUP BY task_type""")
def metric_by_task(spark, sf_dir):
    out = t.metric_by_task(task_runs(spark, sf_dir))
    return out.select("task_type", "metric", *[r6(c).alias(c) for c in out.columns[2:]])


@query("error_buckets", f"""WITH {RUN_CTE},
b(range_no, range) AS (VALUES (0, 'none'), (1, '1-2'), (2, '3-5'), (3, '6+')),
c AS (SELECT CASE WHEN num_errors = 0 THEN 0 WHEN num_errors <= 2 THEN 1
             WHEN num_errors <= 5 THEN 2 ELSE 3 END AS range_no FROM runs)
SELECT b.range_no::BIGINT AS range_no, range, count(c.range_no) AS count,
       100.0::DOUBLE * count(c.range_no) / (SELECT count(*) FROM runs) AS percentage
FROM b LEFT JOIN c USING (range_no) GROUP BY b.range_no, range""")
def error_buckets(spark, sf_dir):
    return t.error_bands(t.run_counts(tool_log(spark, sf_dir)))


@query("error_rates", f"""WITH {RUN_CTE}
SELECT task_type, sum(num_tool_calls)::BIGINT AS tool_calls, sum(num_errors)::BIGINT AS errors,
       round(avg(num_errors), 6) AS errors_mean,
       100.0::DOUBLE * sum(num_errors) / sum(num_tool_calls) AS error_rate
FROM runs GROUP BY ROLLUP (task_type)""")
def error_rates(spark, sf_dir):
    return t.error_rates(task_runs(spark, sf_dir)).withColumn("errors_mean", r6("errors_mean"))


@query("agentic_profile", f"""WITH {RUN_CTE}
SELECT task_type, round(min(success_score), 6) AS score_min,
       round(max(success_score), 6) AS score_max, round(avg(success_score), 6) AS score_mean,
       round(median(success_score), 6) AS score_median,
       sum(num_tool_calls)::BIGINT AS tool_calls, round(avg(num_tool_calls), 6) AS tools_mean,
       max(num_tool_calls) AS tools_max, sum(num_errors)::BIGINT AS errors,
       round(100.0::DOUBLE * sum(num_errors) / sum(num_tool_calls), 6) AS error_rate
FROM runs GROUP BY task_type""")
def agentic_profile(spark, sf_dir):
    out = plans.agentic_profile(task_runs(spark, sf_dir), ["task_type"])
    rounded = ("score_min", "score_max", "score_mean", "score_median", "tools_mean", "error_rate")
    return out.select("task_type", "tool_calls", "tools_max", "errors",
                      *[r6(c).alias(c) for c in rounded])


@query("score_histogram", f"""WITH {RUN_CTE},
b AS (SELECT min(success_score) AS lo, max(success_score) AS hi FROM runs),
e AS (SELECT *, (hi - lo) / 5 AS w, unnest(range(5)) AS bin FROM b)
SELECT bin, round(lo + bin * w, 6) AS edge_lo, round(lo + (bin + 1) * w, 6) AS edge_hi,
       (SELECT count(*) FROM runs WHERE success_score >= lo + bin * w
         AND (success_score < lo + (bin + 1) * w OR bin = 4)) AS count
FROM e""")
def score_histogram(spark, sf_dir):
    counts = d.value_counts(task_runs(spark, sf_dir), [], ["success_score"])
    return d.histogram(counts, ["metric"], 5).select(
        "bin", r6("edge_lo").alias("edge_lo"), r6("edge_hi").alias("edge_hi"), "count")


@query("overview_report", f"""WITH {RUN_CTE},
s AS (SELECT count(*)::DOUBLE AS conversations, sum(num_turns)::DOUBLE AS turns,
       sum(num_tool_calls)::DOUBLE AS tool_calls, sum(num_errors)::DOUBLE AS errors,
       sum(estimated_tokens)::DOUBLE AS tokens, avg(success_score) AS score_mean,
       min(success_score) AS score_min, max(success_score) AS score_max FROM runs),
u AS (UNPIVOT s ON COLUMNS(*) INTO NAME metric VALUE value)
SELECT CASE WHEN metric LIKE 'score%' THEN 'score' ELSE 'overview' END AS section, metric,
       round(value, 6) AS value FROM u
UNION ALL SELECT 'task', task_type, count(*)::DOUBLE FROM runs GROUP BY task_type""")
def overview_report(spark, sf_dir):
    return t.overview(task_runs(spark, sf_dir)).withColumn("value", r6("value"))


@query("row_compare", f"""WITH {RUN_CTE},
two AS (SELECT CASE WHEN conv_id = (SELECT min(conv_id) FROM log) THEN 'left' ELSE 'right' END
          AS side, task_type, num_turns::VARCHAR AS num_turns,
          num_messages::VARCHAR AS num_messages,
          num_tool_calls::VARCHAR AS num_tool_calls, num_errors::VARCHAR AS num_errors,
          round(success_score, 6)::VARCHAR AS success_score,
          estimated_tokens::VARCHAR AS estimated_tokens,
          total_characters::VARCHAR AS total_characters
        FROM runs WHERE conv_id IN (SELECT min(conv_id) FROM log UNION SELECT max(conv_id) FROM log)),
u AS (UNPIVOT two ON task_type, num_turns, num_messages, num_tool_calls, num_errors, success_score,
      estimated_tokens, total_characters INTO NAME metric VALUE value)
SELECT metric, max(value) FILTER (side = 'left') AS left_value,
       max(value) FILTER (side = 'right') AS right_value FROM u GROUP BY metric""")
def row_compare(spark, sf_dir):
    log = tool_log(spark, sf_dir)
    runs = task_runs(spark, sf_dir).withColumn("success_score", r6("success_score"))
    return t.compare_runs(runs, log.agg(F.min("conv_id")), log.agg(F.max("conv_id")))
