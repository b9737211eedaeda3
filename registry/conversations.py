"""Conversation metrics: sizes, cumulative context and growth."""

from pyspark.sql import functions as F

from palaver.operators import metrics as m
from registry.base import CONV_CTE, SCAN_CTE, messages, query, r6, typed_conversations


@query("conv_metrics", f"""WITH {CONV_CTE}
SELECT c.conv_id, c.num_messages, c.num_turns, c.total_characters, c.estimated_tokens,
       c.num_entries, c.first_chars, c.last_chars, c.growth_ratio,
       coalesce((SELECT min_by(s.text, s.turn) FROM scan s
                 WHERE s.conv_id = c.conv_id AND s.role = 'system'), '') AS system_prompt
FROM conv c""")
def conv_metrics(spark, sf_dir):
    return m.conversation_metrics(messages(spark, sf_dir), system_prompt=True)


@query("conv_sizes", """
SELECT conv_id, count(*) AS num_messages, count(*) FILTER (role = 'assistant') AS num_turns,
       sum(length(text))::BIGINT AS total_characters,
       (sum(length(text)) // 4)::BIGINT AS estimated_tokens
FROM conversations GROUP BY conv_id""")
def conv_sizes(spark, sf_dir):
    return m.basic_metrics(messages(spark, sf_dir))


@query("cum_chars", f"""WITH {SCAN_CTE}
SELECT conv_id, turn, reply_no::BIGINT AS entry, cum_chars::BIGINT AS cum_chars
FROM scan WHERE role = 'assistant'""")
def cum_chars(spark, sf_dir):
    return m.cumulative_per_turn(messages(spark, sf_dir))


@query("msg_cum", f"""WITH {SCAN_CTE}
SELECT conv_id, turn, position::BIGINT AS entry, cum_chars::BIGINT AS cum_chars FROM scan""")
def msg_cum(spark, sf_dir):
    return m.cumulative_per_turn(messages(spark, sf_dir), "message")


GROWTH_CTE = SCAN_CTE + """,
growth AS (
  SELECT conv_id, reply_no::BIGINT AS entry, cum_chars::BIGINT AS cum_chars,
         (cum_chars // 4)::BIGINT AS cum_tokens,
         (cum_chars - lag(cum_chars) OVER (PARTITION BY conv_id ORDER BY turn))::BIGINT
           AS growth_chars
  FROM scan WHERE role = 'assistant')"""


@query("turn_growth", f"WITH {GROWTH_CTE} SELECT * FROM growth")
def turn_growth(spark, sf_dir):
    return m.turn_growth(messages(spark, sf_dir))


@query("prefix_growth", f"""WITH {GROWTH_CTE}
SELECT conv_id, count(*) AS entries, round(avg(growth_chars), 6) AS mean_growth,
       max(growth_chars) AS max_growth FROM growth GROUP BY conv_id""")
def prefix_growth(spark, sf_dir):
    return m.prefix_growth(messages(spark, sf_dir)).withColumn("mean_growth", r6("mean_growth"))


@query("conv_roles", "SELECT conv_id, role, count(*) AS count FROM conversations GROUP BY ALL")
def conv_roles(spark, sf_dir):
    return m.role_counts(messages(spark, sf_dir))


@query("role_dist", """
SELECT role, count(*) AS count, 100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS percentage
FROM conversations GROUP BY role""")
def role_dist(spark, sf_dir):
    return m.role_distribution(messages(spark, sf_dir))


@query("msg_len", """
SELECT conv_id, min(length(text)) AS min_chars, max(length(text)) AS max_chars,
       round(avg(length(text)), 6) AS mean_chars FROM conversations GROUP BY conv_id""")
def msg_len(spark, sf_dir):
    return m.message_lengths(messages(spark, sf_dir)).withColumn("mean_chars", r6("mean_chars"))


@query("turn_counts", f"""WITH {CONV_CTE}
SELECT num_turns, count(*) AS count,
       100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS percentage
FROM conv GROUP BY num_turns""")
def turn_counts(spark, sf_dir):
    return m.count_distribution(m.basic_metrics(messages(spark, sf_dir)), "num_turns")


@query("msg_counts_top10", f"""WITH {CONV_CTE}
SELECT num_messages, count(*) AS count,
       100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS percentage
FROM conv GROUP BY num_messages ORDER BY num_messages LIMIT 10""")
def msg_counts_top10(spark, sf_dir):
    return m.count_distribution(m.basic_metrics(messages(spark, sf_dir)), "num_messages", 10)


@query("opening_messages", """
SELECT conv_id, turn, role, substr(text, 1, 80) AS preview FROM conversations WHERE turn < 5""")
def opening_messages(spark, sf_dir):
    return m.opening_messages(messages(spark, sf_dir))


@query("first_last", """
SELECT conv_id, min_by(role, turn) AS first_role, min_by(substr(text, 1, 100), turn) AS first_text,
       max_by(role, turn) AS last_role, max_by(substr(text, 1, 100), turn) AS last_text
FROM conversations GROUP BY conv_id""")
def first_last(spark, sf_dir):
    return m.first_and_last(messages(spark, sf_dir))


@query("by_role", """
SELECT conv_id, turn, length(text) AS n_chars FROM conversations WHERE role = 'user'""")
def by_role(spark, sf_dir):
    return m.message_sizes(messages(spark, sf_dir).filter(m.is_role("user"))).drop("role")


FILTER_SQL = f"""WITH {CONV_CTE}
SELECT conv_id, topic, num_turns, estimated_tokens FROM conv WHERE """


def _filterable(spark, sf_dir):
    from registry.base import topic_of
    conv = m.basic_metrics(messages(spark, sf_dir)).withColumn("topic", topic_of(F.col("conv_id")))
    return conv.select("conv_id", "topic", "num_turns", "estimated_tokens")


@query("filter_category", FILTER_SQL + "topic = 'coding_help'")
def filter_category(spark, sf_dir):
    return _filterable(spark, sf_dir).filter(F.col("topic") == "coding_help")


@query("filter_turns", FILTER_SQL + "num_turns BETWEEN 2 AND 3")
def filter_turns(spark, sf_dir):
    return _filterable(spark, sf_dir).filter(F.col("num_turns").between(2, 3))


@query("filter_threshold", FILTER_SQL + "estimated_tokens > 500")
def filter_threshold(spark, sf_dir):
    return _filterable(spark, sf_dir).filter(F.col("estimated_tokens") > 500)


@query("filter_all", FILTER_SQL + """topic IN ('coding_help', 'tutoring')
  AND num_turns >= 2 AND estimated_tokens > 200""")
def filter_all(spark, sf_dir):
    return _filterable(spark, sf_dir).filter(
        F.col("topic").isin("coding_help", "tutoring") & (F.col("num_turns") >= 2)
        & (F.col("estimated_tokens") > 200))


@query("sample_rows", f"""WITH {CONV_CTE},
ends AS (SELECT conv_id, min_by(role, turn) AS first_role, min_by(substr(text, 1, 100), turn) AS first_text,
         max_by(role, turn) AS last_role, max_by(substr(text, 1, 100), turn) AS last_text
         FROM conversations GROUP BY conv_id)
SELECT conv_id, dataset_type AS family, CASE WHEN dataset_type IN ('text', 'reasoning')
         THEN '{{"topic":"' || topic || '"}}' WHEN dataset_type = 'agentic'
         THEN '{{"num_tool_calls":' || num_tool_calls || '}}' END AS fields,
       num_turns, num_messages, total_characters, estimated_tokens, first_role, first_text, last_role,
       last_text FROM conv JOIN ends USING (conv_id)""")
def sample_rows(spark, sf_dir):
    rows = typed_conversations(spark, sf_dir)
    return m.sample_rows(rows, messages(spark, sf_dir), F.col("dataset_type"))
