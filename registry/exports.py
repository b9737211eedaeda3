"""Session, trace and replay exports.

Nested results are compared through their JSON text (MD5) or their sizes.
"""

from pyspark.sql import functions as F

from palaver.functions.content import media_content
from palaver.operators import assemble as a
from palaver.operators import export as e
from registry.base import CONV_CTE, SCAN_CTE, TYPE_SQL, messages, query, type_of


def _digest(column: str):
    return F.md5(F.to_json(F.col(column)))


@query("sessions", """
SELECT conv_id AS session_id, count(*) AS n_turns,
       md5(to_json(list({'text': text} ORDER BY turn))::VARCHAR) AS turns_md5
FROM conversations WHERE role = 'user' GROUP BY conv_id""")
def sessions(spark, sf_dir):
    out = e.sessions(messages(spark, sf_dir))
    return out.select("session_id", F.size("turns").cast("bigint").alias("n_turns"),
                      _digest("turns").alias("turns_md5"))


@query("sessions_keep_empty", """
SELECT conv_id AS session_id, count(*) FILTER (role = 'user') AS n_turns,
       md5(coalesce(to_json(list({'text': text} ORDER BY turn) FILTER (role = 'user'))::VARCHAR,
                    '[]')) AS turns_md5
FROM conversations GROUP BY conv_id""")
def sessions_keep_empty(spark, sf_dir):
    out = e.sessions(messages(spark, sf_dir), keep_empty=True)
    return out.select("session_id", F.size("turns").cast("bigint").alias("n_turns"),
                      _digest("turns").alias("turns_md5"))


@query("session_lines", """
SELECT to_json({'session_id': conv_id, 'turns': list({'text': text} ORDER BY turn)})::VARCHAR AS line
FROM conversations WHERE role = 'user' GROUP BY conv_id""")
def session_lines(spark, sf_dir):
    out = e.sessions(messages(spark, sf_dir))
    return out.select(F.to_json(F.struct("session_id", "turns")).alias("line"))


@query("nested_messages", """
SELECT conv_id, count(*) AS n_messages,
       md5(to_json(list({'role': role, 'content': text} ORDER BY turn))::VARCHAR) AS messages_md5
FROM conversations GROUP BY conv_id""")
def nested_messages(spark, sf_dir):
    out = e.nested_messages(messages(spark, sf_dir))
    return out.select("conv_id", F.size("messages").cast("bigint").alias("n_messages"),
                      _digest("messages").alias("messages_md5"))


@query("fine_tuning", """
SELECT to_json({'messages': list({'role': role, 'content': text} ORDER BY turn)})::VARCHAR AS line
FROM conversations GROUP BY conv_id""")
def fine_tuning(spark, sf_dir):
    return e.fine_tuning(messages(spark, sf_dir)).select(
        F.to_json(F.struct("messages")).alias("line"))


PREFIX_CTE = SCAN_CTE + """,
pre AS (
  SELECT *, list({'role': role, 'content': text})
         OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS prefix
  FROM scan)"""


@query("trace", f"""WITH {PREFIX_CTE}
SELECT conv_id AS session_id, turn,
       md5(to_json(prefix)::VARCHAR) AS messages_md5,
       greatest(1, n_chars // 4)::BIGINT AS output_length,
       CASE WHEN reply_no > 1 THEN 0 END::BIGINT AS delay
FROM pre WHERE role = 'assistant'""")
def trace(spark, sf_dir):
    out = e.trace(messages(spark, sf_dir))
    return out.select("session_id", "turn",
                      _digest("messages").alias("messages_md5"), "output_length", "delay")


@query("trace_index", f"""WITH {SCAN_CTE}
SELECT conv_id AS session_id, turn AS upto_turn, position::BIGINT AS context_messages,
       cum_chars::BIGINT AS context_chars, greatest(1, n_chars // 4)::BIGINT AS output_length,
       CASE WHEN reply_no > 1 THEN 0 END::BIGINT AS delay
FROM scan WHERE role = 'assistant'""")
def trace_index(spark, sf_dir):
    return e.trace_index(messages(spark, sf_dir))


@query("word_trace", rf"""WITH {PREFIX_CTE}
SELECT conv_id AS session_id, turn,
       md5(to_json(prefix)::VARCHAR) AS messages_md5,
       len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''))::BIGINT
         AS output_length
FROM pre WHERE position >= 3 AND position % 2 = 1""")
def word_trace(spark, sf_dir):
    out = e.word_trace(messages(spark, sf_dir))
    return out.select("session_id", "turn",
                      _digest("messages").alias("messages_md5"), "output_length")


_MIXED_SQL = """
whole AS (SELECT conv_id, list({'role': role, 'content': text} ORDER BY turn) AS all_m
          FROM conversations GROUP BY conv_id)
SELECT s.conv_id AS session_id, s.NO::BIGINT AS entry,
       md5(to_json(list_slice(all_m, 1, 2 * s.NO + 1))::VARCHAR) AS messages_md5,
       s.cum_chars::BIGINT AS output_length
FROM scan s JOIN whole USING (conv_id)"""


@query("mixed_trace", f"WITH {SCAN_CTE}," + _MIXED_SQL.replace("NO", "reply_no")
       + " WHERE s.role = 'assistant'")
def mixed_trace(spark, sf_dir):
    out = e.mixed_trace(messages(spark, sf_dir))
    return out.select("session_id", "entry",
                      _digest("messages").alias("messages_md5"), "output_length")


@query("mixed_trace_by_message", f"WITH {SCAN_CTE}," + _MIXED_SQL.replace("NO", "position"))
def mixed_trace_by_message(spark, sf_dir):
    out = e.mixed_trace(messages(spark, sf_dir), "message")
    return out.select("session_id", "entry",
                      _digest("messages").alias("messages_md5"), "output_length")


@query("replay_trace", f"""WITH {PREFIX_CTE},
nxt AS (SELECT *, lead(role) OVER w AS next_role, lead(n_chars) OVER w AS next_chars FROM pre
        WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id AS session_id, turn,
       md5(to_json(prefix)::VARCHAR) AS messages_md5,
       CASE WHEN next_role = 'assistant' THEN next_chars ELSE 100 END::BIGINT AS output_length
FROM nxt""")
def replay_trace(spark, sf_dir):
    out = e.replay_trace(messages(spark, sf_dir))
    return out.select("session_id", "turn",
                      _digest("messages").alias("messages_md5"), "output_length")


_SPLIT = PREFIX_CTE + """,
nxt AS (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text FROM pre
        WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
cut AS (SELECT conv_id AS session_id, turn, role, next_role,
        (position - 1)::BIGINT AS prefix_messages,
        (cum_chars - n_chars)::BIGINT AS prefix_chars,
        md5(to_json(list_slice(prefix, 1, position - 1))::VARCHAR) AS prefix_md5,
        md5(to_json(CASE WHEN next_role IS NULL THEN [{'role': role, 'content': text}]
            ELSE [{'role': role, 'content': text}, {'role': next_role, 'content': next_text}]
            END)::VARCHAR) AS new_md5 FROM nxt)"""


def _split_digests(out):
    return out.withColumns({"prefix_md5": _digest("prefix"), "new_md5": _digest("new_turn")}).drop(
        "prefix", "new_turn")


@query("replay_split", f"""WITH {_SPLIT}
SELECT session_id, turn, prefix_messages, prefix_chars, prefix_md5, new_md5 FROM cut
WHERE role = 'user' AND next_role = 'assistant' AND prefix_messages > 0""")
def replay_split(spark, sf_dir):
    out = e.replay_split(messages(spark, sf_dir))
    return _split_digests(out)


@query("replay_split_by_position", f"""WITH {_SPLIT}
SELECT session_id, turn, prefix_messages, prefix_chars, prefix_md5, new_md5 FROM cut
WHERE prefix_messages >= 2 AND prefix_messages % 2 = 0""")
def replay_split_by_position(spark, sf_dir):
    out = e.replay_split(messages(spark, sf_dir), by_role=False)
    return _split_digests(out)


def _multimodal(spark, sf_dir):
    """Messages whose turn-0/1 user text of pdf and image conversations has a media part."""
    rows = messages(spark, sf_dir).withColumn("kind", type_of(F.col("conv_id")))
    url = F.concat(F.lit("https://media.example/"), F.col("conv_id"))
    first = (F.col("role") == "user") & (F.col("turn") < 2)
    content = (F.when(first & (F.col("kind") == "pdf"), media_content(F.col("text"), "file", url))
               .when(first & (F.col("kind") == "image"),
                     media_content(F.col("text"), "image_url", url)).otherwise(F.col("text")))
    return rows.withColumn("text", content)


def _multimodal_sql(pdf: str, image: str) -> str:
    return f"""
WITH k AS (SELECT *, {TYPE_SQL} AS kind, 'https://media.example/' || conv_id AS url
           FROM conversations WHERE role = 'user'),
t AS (SELECT conv_id, turn, CASE WHEN turn < 2 AND kind = 'pdf' THEN {pdf}
             WHEN turn < 2 AND kind = 'image' THEN {image} ELSE text END AS text FROM k)
SELECT conv_id AS session_id, count(*) AS n_turns,
       md5(to_json(list({{'text': text}} ORDER BY turn))::VARCHAR) AS turns_md5
FROM t GROUP BY conv_id"""


@query("multimodal_sessions", _multimodal_sql(
    r"text || E'\n\n[PDF: ' || url || ']'", r"text || E'\n\n[Image: ' || url || ']'"))
def multimodal_sessions(spark, sf_dir):
    out = e.sessions(_multimodal(spark, sf_dir), content="media")
    return out.select("session_id", F.size("turns").cast("bigint").alias("n_turns"),
                      _digest("turns").alias("turns_md5"))


@query("inline_sessions", _multimodal_sql(
    r"regexp_replace(text || '[FILE: ' || url || '] ', '^\s+|\s+$', '', 'g')",
    r"regexp_replace(text || '[IMAGE: ' || url || '] ', '^\s+|\s+$', '', 'g')"))
def inline_sessions(spark, sf_dir):
    out = e.sessions(_multimodal(spark, sf_dir), content="inline")
    return out.select("session_id", F.size("turns").cast("bigint").alias("n_turns"),
                      _digest("turns").alias("turns_md5"))


@query("stored_round_trip", "SELECT conv_id, turn, role, md5(text) AS text_md5 FROM conversations")
def stored_round_trip(spark, sf_dir):
    """Wide rows with JSON text columns, parsed back into messages."""
    stored = a.to_stored(a.conversation_rows(messages(spark, sf_dir)))
    return a.explode_messages(stored).select("conv_id", "turn", "role",
                                             F.md5("text").alias("text_md5"))


@query("stored_profile", f"""WITH {CONV_CTE}
SELECT conv_id AS conversation_id, num_turns, num_messages, total_characters, estimated_tokens,
       num_entries, first_chars, last_chars, growth_ratio FROM conv""")
def stored_profile(spark, sf_dir):
    """Metrics recovered from stored rows."""
    stored = a.to_stored(a.conversation_rows(messages(spark, sf_dir)))
    return a.profile_input(stored).select(
        "conversation_id", "num_turns", "num_messages", "total_characters", "estimated_tokens",
        "num_entries", "first_chars", "last_chars", "growth_ratio")



# Events as long conversations: runs of 1,500 events are one conversation each, so every
# conversation goes beyond one part.
_LONG_CTE = """
long AS (SELECT event_id // 1500 AS conv_id, event_id % 1500 AS turn,
                CASE WHEN event_id % 2 = 0 THEN 'user' ELSE 'assistant' END AS role,
                event_type AS text FROM events)"""


def _long_conversations(spark, sf_dir):
    number = F.col("event_id")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.floor(number / 1500).alias("conv_id"), (number % 1500).alias("turn"),
        F.when(number % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.col("event_type").alias("text"))


@query("long_trace", f"""WITH {_LONG_CTE},
pre AS (SELECT *, list({{'role': role, 'content': text}})
               OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS prefix FROM long)
SELECT conv_id AS session_id, turn, len(prefix)::BIGINT AS n_messages,
       md5(to_json(prefix)::VARCHAR) AS messages_md5,
       greatest(1, length(text) // 4)::BIGINT AS output_length
FROM pre WHERE role = 'assistant'""")
def long_trace(spark, sf_dir):
    """Whole contexts of conversations beyond one part."""
    out = e.trace(_long_conversations(spark, sf_dir))
    return out.select("session_id", "turn", F.size("messages").cast("bigint").alias("n_messages"),
                      _digest("messages").alias("messages_md5"), "output_length")


@query("long_fine_tuning", f"""WITH {_LONG_CTE}
SELECT md5(to_json({{'messages': list({{'role': role, 'content': text}} ORDER BY turn)}})::VARCHAR)
       AS line_md5 FROM long GROUP BY conv_id""")
def long_fine_tuning(spark, sf_dir):
    out = e.fine_tuning(_long_conversations(spark, sf_dir))
    return out.select(F.md5(F.to_json(F.struct("messages"))).alias("line_md5"))


@query("long_rows", f"""WITH {_LONG_CTE}
SELECT conv_id AS conversation_id, count(*) AS num_messages,
       count(*) FILTER (role = 'assistant') AS num_turns, sum(length(text))::BIGINT
       AS total_characters,
       md5(to_json(list({{'role': role, 'content': text}} ORDER BY turn))::VARCHAR) AS messages_md5
FROM long GROUP BY conv_id""")
def long_rows(spark, sf_dir):
    out = a.conversation_rows(_long_conversations(spark, sf_dir))
    return out.select("conversation_id", "num_messages", "num_turns", "total_characters",
                      _digest("messages").alias("messages_md5"))
