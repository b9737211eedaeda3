"""Sampling, allocation, mixing, schema alignment and payload balancing."""

from pyspark.sql import functions as F

from palaver.operators import metrics as m
from palaver.operators import mix as x
from palaver.operators import sampling as s
from palaver.operators.order import first_rows, row_at, rows_between
from palaver.plans import profile as plans
from registry.base import (CONV_CTE, SEED, SOURCE_WEIGHTS, TOPIC_SQL, TYPE_SQL, messages, query,
                           r6, sql_draw, table, topic_of, type_of, typed_conversations)
from registry.payloads import score_sql


def _sized(spark, sf_dir):
    return (m.basic_metrics(messages(spark, sf_dir))
            .withColumn("topic", topic_of(F.col("conv_id")))
            .withColumn("source_dataset", type_of(F.col("conv_id"))))


SIZED_CTE = f"""sized AS (
  SELECT conv_id, count(*) AS num_messages, count(*) FILTER (role = 'assistant') AS num_turns,
         sum(length(text))::BIGINT AS total_characters,
         (sum(length(text)) // 4)::BIGINT AS estimated_tokens,
         {TOPIC_SQL} AS topic, {TYPE_SQL} AS source_dataset
  FROM conversations GROUP BY conv_id)"""


@query("sample_n", f"""
SELECT event_id, user_id, event_type FROM events
ORDER BY {sql_draw('sample', 'event_id')}, event_id LIMIT 1500""")
def sample_n(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return s.exact_sample(events, 1500, ["event_id"], SEED)


@query("stratified", f"""
WITH r AS (SELECT doc_id, source, lang, row_number() OVER (PARTITION BY source
  ORDER BY {sql_draw('sample', 'doc_id')}, doc_id) AS rn FROM documents)
SELECT doc_id, source, lang FROM r WHERE rn <= 40""")
def stratified(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    return s.stratified_sample(docs, "source", ["doc_id"], SEED, k=40)


@query("null_group_stratified", f"""
WITH r AS (SELECT d.doc_id, l.quality, row_number() OVER (PARTITION BY l.quality
  ORDER BY {sql_draw('sample', 'd.doc_id')}, d.doc_id) AS rn
  FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT doc_id, quality FROM r WHERE rn <= 40""")
def null_group_stratified(spark, sf_dir):
    """Documents without a label are a stratum of their own."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return s.stratified_sample(docs.join(labels, "doc_id", "left"), "quality", ["doc_id"], SEED,
                               k=40)


@query("first_n", f"""WITH {SIZED_CTE}
SELECT conv_id, num_turns, estimated_tokens FROM sized ORDER BY conv_id LIMIT 50""")
def first_n(spark, sf_dir):
    return first_rows(_sized(spark, sf_dir).select("conv_id", "num_turns", "estimated_tokens"),
                      50, ["conv_id"])


@query("row_at", """
SELECT * FROM (SELECT event_id, ts, user_id, event_type FROM events ORDER BY ts, event_id LIMIT 1 OFFSET 4321)
UNION ALL
SELECT * FROM (SELECT event_id, ts, user_id, event_type FROM events ORDER BY event_type, user_id, event_id
               LIMIT 1 OFFSET 7000)""")
def row_at_position(spark, sf_dir):
    """Single rows by their position in an order of time and in one of strings."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return row_at(events, 4321, ["ts", "event_id"]).union(
        row_at(events, 7000, ["event_type", "user_id", "event_id"]))


@query("rows_between", """
SELECT doc_id, source, n_chars FROM documents ORDER BY source, n_chars, doc_id LIMIT 100 OFFSET 60""")
def positions(spark, sf_dir):
    """A slice of positions: the 100 rows after the first 60."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return rows_between(docs, 60, 160, ["source", "n_chars", "doc_id"])


@query("first_half", """
SELECT event_id, event_type FROM (SELECT *, row_number() OVER (ORDER BY event_type, ts, event_id) AS k,
  count(*) OVER () AS n FROM events) WHERE k <= 5000""")
def first_half(spark, sf_dir):
    """Many first rows of an order of strings and times, filtered where they lie."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    return first_rows(events, 5000, ["event_type", "ts", "event_id"]).drop("ts")


@query("shuffled", f"""
SELECT event_id, row_number() OVER (ORDER BY {sql_draw('order', 'event_id')}, event_id) AS place
FROM events""")
def shuffled(spark, sf_dir):
    from palaver.functions.draws import draw
    from palaver.operators.scan import hash_rank
    events = table(spark, sf_dir, "events").select("event_id")
    drawn = events.withColumn("_d", draw(SEED, "order", F.col("event_id")))
    return hash_rank(drawn, [], "_d", ["event_id"], "place").drop("_d")


ALLOC_CTE = """cfg(source_dataset, weight, position) AS (VALUES ('text', 0.25::DOUBLE, 0),
  ('pdf', 0.2::DOUBLE, 1), ('image', 0.2::DOUBLE, 2), ('reasoning', 0.2::DOUBLE, 3),
  ('agentic', 0.15::DOUBLE, 4), ('absent', 0.4::DOUBLE, 5)),
have AS (SELECT source_dataset, count(*) AS available FROM sized GROUP BY source_dataset),
src AS (SELECT * FROM cfg JOIN have USING (source_dataset)),
w AS (SELECT *, weight / sum(weight) OVER () AS share FROM src),
fl AS (SELECT *, floor(N * share)::BIGINT AS base FROM w),
al AS (SELECT source_dataset, share, available, (base + CASE WHEN source_dataset =
         (SELECT source_dataset FROM fl ORDER BY share DESC, position LIMIT 1)
         THEN N - (SELECT sum(base) FROM fl) ELSE 0 END)::BIGINT AS wanted FROM fl)"""

CFG = {**SOURCE_WEIGHTS, "absent": 0.4}


def _sources(spark, sf_dir):
    return x.with_available(x.source_table(spark, CFG), _sized(spark, sf_dir))


@query("alloc_weighted", f"WITH {SIZED_CTE}, " + ALLOC_CTE.replace("N *", "83 *").replace(
    "N -", "83 -") + """
SELECT source_dataset, round(share, 6) AS share, available, wanted,
       least(wanted, available) AS quota FROM al""")
def alloc_weighted(spark, sf_dir):
    out = x.allocate_weighted(_sources(spark, sf_dir), 83)
    return out.withColumn("share", r6("share"))


@query("alloc_equal", f"WITH {SIZED_CTE}, " + ALLOC_CTE.split("w AS (SELECT")[0].rstrip().rstrip(",")
       + """,
n AS (SELECT *, row_number() OVER (ORDER BY position) - 1 AS i, count(*) OVER () AS k FROM src)
SELECT source_dataset, available, (83 // k + CASE WHEN i < 83 % k THEN 1 ELSE 0 END)::BIGINT AS wanted,
       least(available, 83 // k + CASE WHEN i < 83 % k THEN 1 ELSE 0 END)::BIGINT AS quota FROM n""")
def alloc_equal(spark, sf_dir):
    return x.allocate_equal(_sources(spark, sf_dir), 83)


MIX_SQL = f"WITH {SIZED_CTE}, " + ALLOC_CTE.replace("N *", "60 *").replace("N -", "60 -") + f""",
r AS (SELECT *, row_number() OVER (PARTITION BY source_dataset
      ORDER BY {sql_draw('mix', 'conv_id')}, conv_id) AS rn FROM sized),
mixed AS (SELECT r.* FROM r JOIN al USING (source_dataset) WHERE rn <= al.wanted)
"""


@query("mix", MIX_SQL + "SELECT conv_id, source_dataset, num_turns, estimated_tokens FROM mixed")
def mix(spark, sf_dir):
    out = x.mix(_sized(spark, sf_dir), CFG, 60, SEED, key="conv_id", ordered=True)
    return out.select("conv_id", "source_dataset", "num_turns", "estimated_tokens")


@query("mix_summary", MIX_SQL + """
SELECT source_dataset, count(*) AS count, round(avg(num_turns), 6) AS avg_turns,
       round(avg(estimated_tokens), 6) AS avg_tokens,
       100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS percentage
FROM mixed GROUP BY source_dataset""")
def mix_summary(spark, sf_dir):
    out = plans.mixture_summary(x.mix(_sized(spark, sf_dir), CFG, 60, SEED, key="conv_id"))
    return out.withColumn("avg_turns", r6("avg_turns")).withColumn("avg_tokens", r6("avg_tokens"))


def _source_frames(spark, sf_dir):
    """Sources with different columns, as families have."""
    docs = table(spark, sf_dir, "documents")
    text = docs.select(
        F.col("doc_id").cast("string").alias("conversation_id"),
        F.length("text").cast("bigint").alias("total_characters"), F.col("source").alias("topic"),
        "lang")
    orders = table(spark, sf_dir, "orders")
    agentic = orders.select(
        F.col("o_orderkey").cast("string").alias("conversation_id"),
        F.col("o_orderpriority").alias("task_type"),
        F.col("o_totalprice").alias("success_score"))
    return {"text": text, "agentic": agentic}


@query("schema_union", """
SELECT doc_id::VARCHAR AS conversation_id, 0::BIGINT AS num_turns, '[]' AS messages,
       coalesce(length(text), 0)::BIGINT AS total_characters, 'text' AS source_dataset,
       coalesce(source, '') AS topic, '' AS task_type, 0.0::DOUBLE AS success_score,
       0::BIGINT AS num_errors, '' AS image_url, lang
FROM documents
UNION ALL
SELECT o_orderkey::VARCHAR, 0, '[]', 0, 'agentic', '', coalesce(o_orderpriority, ''),
       coalesce(o_totalprice, 0.0), 0, '', NULL FROM orders""")
def schema_union(spark, sf_dir):
    out = x.align_schema(x.concat_sources(_source_frames(spark, sf_dir)), "union")
    return out.select("conversation_id", "num_turns", "messages", "total_characters",
                      "source_dataset", "topic", "task_type", "success_score", "num_errors",
                      "image_url", "lang")


@query("schema_union_parity", """
SELECT doc_id::VARCHAR AS conversation_id, length(text)::BIGINT AS total_characters,
       'text' AS source_dataset, source AS topic, NULL AS task_type,
       NULL::DOUBLE AS success_score, 0::BIGINT AS num_errors
FROM documents
UNION ALL
SELECT o_orderkey::VARCHAR, NULL, 'agentic', NULL, o_orderpriority, o_totalprice, 0 FROM orders""")
def schema_union_parity(spark, sf_dir):
    out = x.align_schema(x.concat_sources(_source_frames(spark, sf_dir)), "union", parity=True)
    return out.select("conversation_id", "total_characters", "source_dataset", "topic",
                      "task_type", "success_score", "num_errors")


_STD = ("'' AS system_prompt, 0::BIGINT AS num_turns, 0::BIGINT AS num_messages, "
        "'[]' AS messages, '[]' AS cumulative_char_lengths, 0::BIGINT AS estimated_tokens")


@query("schema_inter", f"""
SELECT doc_id::VARCHAR AS conversation_id, coalesce(length(text), 0)::BIGINT AS total_characters,
       'text' AS source_dataset, {_STD} FROM documents
UNION ALL BY NAME
SELECT o_orderkey::VARCHAR AS conversation_id, 0::BIGINT AS total_characters,
       'agentic' AS source_dataset, {_STD} FROM orders""")
def schema_inter(spark, sf_dir):
    frames = _source_frames(spark, sf_dir)
    return x.align_schema(x.concat_sources(frames), "intersection", frames)


TARGET = 0.105

BALANCE_CTE = CONV_CTE + f""",
o AS (SELECT *, {sql_draw('balance', 'conv_id')} AS d FROM conv),
p AS (SELECT dataset_type, conv_id, d, count(*) OVER w AS n, sum(estimated_tokens) OVER w AS t,
        sum(total_characters) OVER w AS c, sum(num_turns) OVER w AS r,
        coalesce(avg(growth_ratio) OVER w, 0.0) AS g, sum(num_tool_calls) OVER w AS x,
        count(*) OVER (PARTITION BY dataset_type) AS rows
      FROM o WINDOW w AS (PARTITION BY dataset_type ORDER BY d, conv_id
                          ROWS UNBOUNDED PRECEDING)),
{score_sql('p')},
diffs AS (SELECT *, 0.5 * pre + 0.5 * dec AS score,
                 abs(0.5 * pre + 0.5 * dec - {TARGET}) AS difference
          FROM scored WHERE n >= least(10, rows)),
best AS (SELECT *, row_number() OVER (PARTITION BY dataset_type
           ORDER BY round(difference, 9), n) AS place FROM diffs)"""


@query("payload_balanced", f"""WITH {BALANCE_CTE}
SELECT dataset_type, n AS size, rows, round(score, 6) AS score,
       round(difference, 6) AS difference, difference <= 0.05 AS within_tolerance
FROM best WHERE place = 1""")
def payload_balanced(spark, sf_dir):
    out = s.balanced_sizes(typed_conversations(spark, sf_dir), TARGET, ["conv_id"], SEED)
    return out.select("dataset_type", "size", "rows", r6("score").alias("score"),
                      r6("difference").alias("difference"), "within_tolerance")


@query("payload_balanced_rows", f"""WITH {BALANCE_CTE}
SELECT p.dataset_type, p.conv_id FROM p JOIN best b
  ON b.dataset_type = p.dataset_type AND b.place = 1 AND p.n <= b.n""")
def payload_balanced_rows(spark, sf_dir):
    out = s.balanced_subset(typed_conversations(spark, sf_dir), TARGET, ["conv_id"], SEED)
    return out.select("dataset_type", "conv_id")
