"""Tool-call log analytics.

The log is long: ``conv_id, seq, tool, status``.  Conversation rows derived
from it carry ``num_tool_calls, num_errors, task_type, num_turns,
success_score``.  All group-bys are combinable, so a hot tool or run is
reduced before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from palaver.functions.content import json_list_length
from palaver.functions.text import chars, share, tokens
from palaver.operators.distribution import ranges

KEY = "conv_id"

# Success metric per task type, score bands, error bands.
SUCCESS_METRICS = {
    "data_processing": "data_integrity_score",
    "api_integration": "integration_completeness_score",
    "system_troubleshooting": "resolution_success_score",
    "code_generation": "test_pass_rate",
    "research_synthesis": "coverage_completeness_score",
    "planning_execution": "objective_completion_score",
}
DEFAULT_METRIC = "completion_score"
SCORE_BANDS = (
    (0.0, 0.2, "0.0-0.2 (Very Poor)"),
    (0.2, 0.4, "0.2-0.4 (Poor)"),
    (0.4, 0.6, "0.4-0.6 (Fair)"),
    (0.6, 0.8, "0.6-0.8 (Good)"),
    (0.8, 1.0, "0.8-1.0 (Excellent)"),
)


def failed() -> Column:
    return F.col("status") == "error"


def explode_tool_calls(stored: DataFrame, column: str = "tool_calls",
                       key: str = "conversation_id", detail: int = 60) -> DataFrame:
    """The log of stored calls: ``conv_id, seq, tool, status, call, result, detail``.

    The column is a JSON list of ``{tool, call, result}``; call and result stay JSON
    text, as their fields differ from call to call.  ``detail`` is the error of a
    result that has one, else the first characters of what it gave (``N/A`` if
    nothing).  Rows without a valid list of calls have no row here.
    """
    calls = F.from_json(F.when(json_list_length(F.col(column)).isNotNull(), F.col(column)),
                        "array<struct<tool:string,call:string,result:string>>")
    rows = stored.select(F.col(key).alias(KEY), F.posexplode(calls).alias("_at", "_call")).select(
        KEY, F.col("_at").cast("bigint").alias("seq"), "_call.*")
    given = F.coalesce(F.get_json_object("result", "$.result"), F.lit("N/A"))
    return rows.select(
        KEY, "seq", "tool", F.get_json_object("result", "$.status").alias("status"), "call",
        "result", F.coalesce(F.get_json_object("result", "$.error"), F.substring(given, 1, detail))
        .alias("detail"))


def run_counts(log: DataFrame, extra_chars: str | None = None) -> DataFrame:
    """Tool calls and errors per conversation."""
    extra = []
    if extra_chars:
        extra = [F.sum(chars(F.col(extra_chars))).alias("total_characters")]
    out = log.groupBy(KEY).agg(F.count(F.lit(1)).alias("num_tool_calls"),
                               F.count_if(failed()).alias("num_errors"), *extra)
    if extra_chars:
        out = out.withColumn("estimated_tokens", tokens(F.col("total_characters")))
    return out


def with_success(runs: DataFrame, base: str = "base_score") -> DataFrame:
    """Success score and the name of its metric.

    The base is reduced by a tenth per error, then by a fifth for fewer than
    three turns, and clamped to [0, 1].
    """
    penalty = F.when(F.col("num_errors") > 0,
                     F.lit(1.0) - F.lit(0.1) * F.col("num_errors")).otherwise(F.lit(1.0))
    short = F.when(F.col("num_turns") < 3, F.lit(0.8)).otherwise(F.lit(1.0))
    raw = F.col(base) * penalty * short
    names = F.create_map(*[F.lit(x) for kv in SUCCESS_METRICS.items() for x in kv])
    return (runs.withColumn("success_score",
                            F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw)))
            .withColumn("success_metric",
                        F.coalesce(F.try_element_at(names, F.col("task_type")),
                                   F.lit(DEFAULT_METRIC))))


def tool_usage(log: DataFrame, total_row: bool = True) -> DataFrame:
    """Calls, successes, failures and rate per tool, with a TOTAL row.

    Anything that is not a success counts as a failure.
    """
    grouped = log.rollup("tool") if total_row else log.groupBy("tool")
    name = (F.when(F.grouping("tool") == 1, F.lit("TOTAL")).otherwise(F.col("tool"))
            if total_row else F.col("tool"))
    good = F.count_if(F.col("status") == "success")
    return (grouped.agg(name.alias("name"), F.count(F.lit(1)).alias("count"),
                        good.alias("success"))
            .select(F.col("name").alias("tool"), "count", "success",
                    (F.col("count") - F.col("success")).alias("failure"),
                    share(F.col("success"), F.col("count")).alias("rate")))


def run_tools(log: DataFrame) -> DataFrame:
    """Calls per conversation and tool."""
    return log.groupBy(KEY, "tool").agg(F.count(F.lit(1)).alias("count"))


def run_success_rate(runs: DataFrame) -> DataFrame:
    """Percentage of good calls per conversation, 100 when there are none."""
    rate = F.when(F.col("num_tool_calls") > 0,
                  (F.lit(1.0) - F.col("num_errors") / F.col("num_tool_calls")) * 100)
    return runs.select(KEY, "num_tool_calls", "num_errors",
                       rate.otherwise(F.lit(100.0)).alias("success_rate"))


def first_calls(log: DataFrame, n: int = 3, width: int = 60, detail: str = "props") -> DataFrame:
    """The first ``n`` calls of every conversation with a cut detail text."""
    order = Window.partitionBy(KEY).orderBy("seq")
    lean = log.select(KEY, "seq", "tool", "status",
                      F.substring(F.col(detail), 1, width).alias("detail"))
    return lean.withColumn("call_no", F.row_number().over(order)).filter(F.col("call_no") <= n)


def task_performance(runs: DataFrame) -> DataFrame:
    """Per task type: turns, tools, errors, score and tokens in one aggregate."""
    return runs.groupBy("task_type").agg(
        F.count(F.lit(1)).alias("conversations"),
        F.avg("num_turns").alias("turns_mean"), F.min("num_turns").alias("turns_min"),
        F.max("num_turns").alias("turns_max"),
        F.avg("num_tool_calls").alias("tools_mean"), F.sum("num_tool_calls").alias("tools_sum"),
        F.avg("num_errors").alias("errors_mean"), F.sum("num_errors").alias("errors_sum"),
        F.avg("success_score").alias("score_mean"), F.min("success_score").alias("score_min"),
        F.max("success_score").alias("score_max"),
        F.avg("estimated_tokens").alias("tokens_mean"),
        F.sum("estimated_tokens").alias("tokens_sum"),
    ).withColumn("error_rate", share(F.col("errors_sum"), F.col("tools_sum")))


def score_bands(runs: DataFrame, close_last: bool = True) -> DataFrame:
    """Conversations per score band, zero bands kept.

    With ``close_last=False`` the last band is half open, so a score of exactly
    1.0 belongs to none.
    """
    score = F.col("success_score")
    tests = []
    for i, (low, high, label) in enumerate(SCORE_BANDS):
        upper = score <= high if close_last and i == len(SCORE_BANDS) - 1 else score < high
        tests.append((label, (score >= low) & upper))
    return ranges(runs, [], tests)


def metric_by_task(runs: DataFrame) -> DataFrame:
    return runs.groupBy("task_type").agg(
        F.min("success_metric").alias("metric"), F.avg("success_score").alias("score_mean"),
        F.min("success_score").alias("score_min"), F.max("success_score").alias("score_max"))


def error_bands(runs: DataFrame) -> DataFrame:
    errors = F.col("num_errors")
    return ranges(runs, [], [
        ("none", errors == 0), ("1-2", (errors > 0) & (errors <= 2)),
        ("3-5", (errors > 2) & (errors <= 5)), ("6+", errors > 5)])


def error_rates(runs: DataFrame) -> DataFrame:
    """Error rate and mean errors per task type, plus the overall row (NULL type)."""
    return (runs.rollup("task_type").agg(
        F.sum("num_tool_calls").alias("tool_calls"), F.sum("num_errors").alias("errors"),
        F.avg("num_errors").alias("errors_mean"))
        .withColumn("error_rate", F.coalesce(share(F.col("errors"), F.col("tool_calls")),
                                             F.lit(0.0))))


def overview(runs: DataFrame) -> DataFrame:
    """Totals of the run table as ``(section, metric, value)`` rows.

    Task counts and overall figures come from one rollup over the runs.
    """
    totals = {
        "conversations": F.count(F.lit(1)), "turns": F.sum("num_turns"),
        "tool_calls": F.sum("num_tool_calls"), "errors": F.sum("num_errors"),
        "tokens": F.sum("estimated_tokens"), "score_mean": F.avg("success_score"),
        "score_min": F.min("success_score"), "score_max": F.max("success_score")}
    rolled = runs.rollup("task_type").agg(
        F.grouping("task_type").alias("_whole"), *[c.alias(n) for n, c in totals.items()])

    def row(section: Column, metric: Column, value: Column) -> Column:
        return F.struct(section.alias("section"), metric.alias("metric"),
                        value.cast("double").alias("value"))

    overall = F.array(*[row(F.lit("score" if n.startswith("score") else "overview"), F.lit(n),
                            F.col(n)) for n in totals])
    task = F.array(row(F.lit("task"), F.col("task_type"), F.col("conversations")))
    return rolled.select(F.inline(F.when(F.col("_whole") == 1, overall).otherwise(task)))


def compare_runs(runs: DataFrame, left: DataFrame | str, right: DataFrame | str) -> DataFrame:
    """Two conversations side by side: ``(metric, left_value, right_value)``.

    ``left`` and ``right`` are keys, or one-row one-column frames yielding them.
    """
    def key(k):
        return k.scalar() if isinstance(k, DataFrame) else F.lit(k)

    shown = ["task_type", "num_turns", "num_messages", "num_tool_calls", "num_errors",
             "success_score", "estimated_tokens", "total_characters"]
    two = runs.select(
        F.when(F.col(KEY) == key(left), F.lit("left"))
         .when(F.col(KEY) == key(right), F.lit("right")).alias("side"), *shown
    ).filter(F.col("side").isNotNull())
    long = two.select("side", F.inline(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("string").alias("value"))
        for c in shown])))
    return (long.groupBy("metric").pivot("side", ["left", "right"]).agg(F.first("value"))
            .select("metric", F.col("left").alias("left_value"),
                    F.col("right").alias("right_value")))
