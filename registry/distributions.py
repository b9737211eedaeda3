"""Distribution profiles of the conversation table, per dataset type."""

from pyspark.sql import functions as F

from palaver.operators import distribution as d
from palaver.operators import metrics as m
from registry.base import (CONV_CTE, TYPE_SQL, messages, query, r6, table, topic_of, type_of, typed_conversations,
                           typed_messages)

METRICS = ["num_turns", "num_messages", "estimated_tokens", "total_characters"]

LONG_CTE = CONV_CTE + """,
long AS (
""" + "\n UNION ALL ".join(
    f"SELECT dataset_type, '{c}' AS metric, {c}::DOUBLE AS value FROM conv" for c in METRICS) + ")"


def _sized(spark, sf_dir):
    """Sizes without the context scan: one combined aggregate."""
    return (m.basic_metrics(messages(spark, sf_dir))
            .withColumn("dataset_type", type_of(F.col("conv_id")))
            .withColumn("topic", topic_of(F.col("conv_id"))))


@query("num_summary", f"""WITH {LONG_CTE}
SELECT dataset_type, metric, count(*) AS n, sum(value) AS total, min(value) AS min,
       max(value) AS max, round(avg(value), 6) AS mean,
       round(coalesce(stddev_samp(value), 0.0), 6) AS stdev,
       round(quantile_cont(value, 0.5), 6) AS median
FROM long GROUP BY dataset_type, metric""")
def num_summary(spark, sf_dir):
    out = d.numeric_summary(_sized(spark, sf_dir), ["dataset_type"], METRICS)
    return out.select("dataset_type", "metric", "n", "total", "min", "max",
                      r6("mean").alias("mean"), r6("stdev").alias("stdev"),
                      r6("median").alias("median"))


_P = "[0.05, 0.25, 0.5, 0.75, 0.95, 0.99]"


@query("percentiles", f"""WITH {LONG_CTE},
q AS (SELECT dataset_type, metric, quantile_cont(value, {_P}::DOUBLE[]) AS qs FROM long
      GROUP BY dataset_type, metric)
SELECT dataset_type, metric, unnest({_P}::DOUBLE[]) AS p, round(unnest(qs), 6) AS value FROM q""")
def percentiles(spark, sf_dir):
    counts = d.value_counts(_sized(spark, sf_dir), ["dataset_type"], METRICS)
    out = d.quantiles(counts, ["dataset_type", "metric"], d.PERCENTILES)
    return out.withColumn("value", r6("value"))


@query("quantile_90", f"""WITH {CONV_CTE}
SELECT topic, round(quantile_cont(estimated_tokens, 0.9), 6) AS value FROM conv GROUP BY topic""")
def quantile_90(spark, sf_dir):
    counts = d.value_counts(_sized(spark, sf_dir), ["topic"], ["estimated_tokens"])
    return d.quantiles(counts, ["topic"], [0.9]).select("topic", r6("value").alias("value"))


def _hist_sql(where: str, bins: str) -> str:
    """Each bin compares every value with its edges."""
    return f"""WITH {LONG_CTE},
src AS (SELECT * FROM long WHERE {where}),
b AS (SELECT dataset_type, metric, min(value) AS lo, max(value) AS hi FROM src GROUP BY ALL),
k AS (SELECT *, CASE WHEN lo = hi THEN 1 ELSE {bins} END::BIGINT AS k FROM b),
e AS (SELECT *, (hi - lo) / k AS w, unnest(range(k)) AS bin FROM k)
SELECT e.dataset_type, e.metric, e.bin, e.lo + e.bin * e.w AS edge_lo,
       e.lo + (e.bin + 1) * e.w AS edge_hi,
       (SELECT count(*) FROM src s WHERE s.dataset_type = e.dataset_type AND s.metric = e.metric
          AND s.value >= e.lo + e.bin * e.w
          AND (s.value < e.lo + (e.bin + 1) * e.w OR e.bin = e.k - 1)) AS count
FROM e"""


@query("histogram", _hist_sql("metric IN ('estimated_tokens', 'total_characters')", "10"))
def histogram(spark, sf_dir):
    counts = d.value_counts(_sized(spark, sf_dir), ["dataset_type"],
                            ["estimated_tokens", "total_characters"])
    return d.histogram(counts, ["dataset_type", "metric"], 10)


@query("turn_histogram", _hist_sql("metric = 'num_turns'", "least(10, hi - lo + 1)"))
def turn_histogram(spark, sf_dir):
    counts = d.value_counts(_sized(spark, sf_dir), ["dataset_type"], ["num_turns"])
    return d.histogram(counts, ["dataset_type", "metric"],
                       F.least(F.lit(10.0), F.col("hi") - F.col("lo") + 1))


@query("turn_buckets", f"""WITH {CONV_CTE},
b(range_no, range, above, upto) AS (VALUES (0, 'short (1-5)', -1, 5), (1, 'medium (6-15)', 5, 15),
  (2, 'long (16-30)', 15, 30), (3, 'very_long (31+)', 30, 1000000000)),
t AS (SELECT dataset_type, count(*) AS n FROM conv GROUP BY dataset_type)
SELECT t.dataset_type, b.range_no::BIGINT AS range_no, b.range,
       count(c.conv_id) AS count, 100.0::DOUBLE * count(c.conv_id) / any_value(t.n) AS percentage
FROM t CROSS JOIN b LEFT JOIN conv c ON c.dataset_type = t.dataset_type
     AND c.num_turns > b.above AND c.num_turns <= b.upto
GROUP BY t.dataset_type, b.range_no, b.range""")
def turn_buckets(spark, sf_dir):
    return d.turn_buckets(_sized(spark, sf_dir), ["dataset_type"])


@query("context_growth", f"""WITH {CONV_CTE}
SELECT dataset_type, count(*) AS n, round(min(growth_ratio), 6) AS ratio_min,
       round(max(growth_ratio), 6) AS ratio_max, round(avg(growth_ratio), 6) AS ratio_mean,
       round(median(growth_ratio), 6) AS ratio_median,
       round(avg(first_chars), 6) AS first_mean, round(median(first_chars), 6) AS first_median,
       round(avg(last_chars), 6) AS last_mean, round(median(last_chars), 6) AS last_median
FROM conv WHERE growth_ratio IS NOT NULL GROUP BY dataset_type""")
def context_growth(spark, sf_dir):
    from palaver.plans.profile import context_growth_profile
    out = context_growth_profile(typed_conversations(spark, sf_dir), ["dataset_type"])
    return out.select("dataset_type", "n", *[r6(c).alias(c) for c in out.columns[2:]])


@query("category_freq", f"""WITH {CONV_CTE}
SELECT dataset_type, topic AS value, count(*) AS count,
       100.0::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY dataset_type) AS percentage
FROM conv GROUP BY dataset_type, topic""")
def category_freq(spark, sf_dir):
    rows = _sized(spark, sf_dir)
    return (d.frequency(rows, ["dataset_type"], "topic")
            .orderBy("dataset_type", F.desc("count"), "value"))


@query("dataset_compare", f"""WITH {CONV_CTE}
SELECT dataset_type, count(*) AS conversations, round(avg(num_turns), 6) AS avg_turns,
       round(avg(estimated_tokens), 6) AS avg_tokens,
       sum(estimated_tokens)::BIGINT AS total_tokens, max(estimated_tokens) AS max_tokens
FROM conv GROUP BY dataset_type""")
def dataset_compare(spark, sf_dir):
    from palaver.plans.profile import compare_datasets
    out = compare_datasets(_sized(spark, sf_dir), "dataset_type")
    return out.withColumn("avg_turns", r6("avg_turns")).withColumn("avg_tokens", r6("avg_tokens"))


@query("document_sizes", """
SELECT source, lang, count(*) AS n, sum(n_chars)::BIGINT AS total, min(n_chars) AS min,
       max(n_chars) AS max, round(avg(n_chars), 6) AS mean,
       round(coalesce(stddev_samp(n_chars), 0.0), 6) AS stdev,
       round(median(n_chars), 6) AS median
FROM documents GROUP BY source, lang""")
def document_sizes(spark, sf_dir):
    from registry.base import table
    docs = table(spark, sf_dir, "documents")
    out = d.numeric_summary(docs, ["source", "lang"], ["n_chars"])
    return out.select("source", "lang", "n", *[F.col(c).cast("bigint").alias(c)
                                               for c in ("total", "min", "max")],
                      *[r6(c).alias(c) for c in ("mean", "stdev", "median")])


@query("lineitem_percentiles", f"""
WITH long AS (
  SELECT l_returnflag, 'l_quantity' AS metric, l_quantity AS value FROM lineitem UNION ALL
  SELECT l_returnflag, 'l_extendedprice' AS metric, l_extendedprice AS value FROM lineitem),
q AS (SELECT l_returnflag, metric, quantile_cont(value, {_P}::DOUBLE[]) AS qs FROM long
      GROUP BY ALL)
SELECT l_returnflag, metric, unnest({_P}::DOUBLE[]) AS p, round(unnest(qs), 4) AS value FROM q""")
def lineitem_percentiles(spark, sf_dir):
    from registry.base import table
    out = d.row_quantiles(table(spark, sf_dir, "lineitem"), ["l_returnflag"],
                          ["l_quantity", "l_extendedprice"], d.PERCENTILES)
    return out.withColumn("value", F.round("value", 4))


@query("typed_roles", f"""
SELECT dataset_type, role AS value, count(*) AS count,
       100.0::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY dataset_type) AS percentage
FROM (SELECT *, {TYPE_SQL} AS dataset_type
      FROM conversations) GROUP BY dataset_type, role""")
def typed_roles(spark, sf_dir):
    return d.frequency(typed_messages(spark, sf_dir), ["dataset_type"], "role")


@query("family_stats", f"""WITH {LONG_CTE},
s AS (SELECT dataset_type, metric, min(value) AS min, max(value) AS max, avg(value) AS mean,
        quantile_cont(value, 0.5) AS median, coalesce(stddev_samp(value), 0.0) AS stdev,
        sum(value) AS total FROM long WHERE metric <> 'num_messages' GROUP BY ALL),
u AS (UNPIVOT s ON min, max, mean, median, stdev, total INTO NAME stat VALUE value)
SELECT dataset_type, 'numbers' AS section, metric, stat, round(value, 6) AS value FROM u
UNION ALL SELECT dataset_type, 'categories', topic, 'count', count(*)::DOUBLE FROM conv
GROUP BY dataset_type, topic""")
def family_stats(spark, sf_dir):
    from palaver.plans.profile import family_statistics
    out = family_statistics(_sized(spark, sf_dir), "dataset_type", "topic")
    return out.withColumn("value", r6("value"))


# Documents without a label have no quality and no toxic mark: their groups are NULL.
_LABELLED_CTE = """
labelled AS (SELECT d.doc_id, d.n_chars, d.lang, l.quality, l.toxic
             FROM documents d LEFT JOIN labels l USING (doc_id))"""


def labelled(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang")
    return docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")


@query("null_group_summary", f"""WITH {_LABELLED_CTE}
SELECT quality, toxic, count(*) AS n, sum(n_chars)::DOUBLE AS total, min(n_chars)::DOUBLE AS min,
       max(n_chars)::DOUBLE AS max, round(avg(n_chars), 6) AS mean,
       round(coalesce(stddev_samp(n_chars), 0.0), 6) AS stdev,
       round(quantile_cont(n_chars, 0.5), 6) AS median
FROM labelled GROUP BY quality, toxic""")
def null_group_summary(spark, sf_dir):
    out = d.numeric_summary(labelled(spark, sf_dir), ["quality", "toxic"], ["n_chars"])
    return out.select("quality", "toxic", "n", "total", "min", "max", r6("mean").alias("mean"),
                      r6("stdev").alias("stdev"), r6("median").alias("median"))


@query("null_group_percentiles", f"""WITH {_LABELLED_CTE},
q AS (SELECT quality, quantile_cont(n_chars, {_P}::DOUBLE[]) AS qs FROM labelled GROUP BY quality)
SELECT quality, unnest({_P}::DOUBLE[]) AS p, round(unnest(qs), 6) AS value FROM q""")
def null_group_percentiles(spark, sf_dir):
    counts = d.value_counts(labelled(spark, sf_dir), ["quality"], ["n_chars"])
    out = d.quantiles(counts, ["quality", "metric"], d.PERCENTILES)
    return out.select("quality", "p", r6("value").alias("value"))


@query("null_group_frequency", f"""WITH {_LABELLED_CTE}
SELECT quality, lang AS value, count(*) AS count,
       round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY quality), 6) AS percentage
FROM labelled GROUP BY quality, lang""")
def null_group_frequency(spark, sf_dir):
    out = d.frequency(labelled(spark, sf_dir), ["quality"], "lang")
    return out.withColumn("percentage", r6("percentage"))


@query("merged_profile", """
SELECT lang, count(*) AS n, sum(n_chars)::BIGINT AS total, min(n_chars) AS min, max(n_chars) AS max,
       round(avg(n_chars), 6) AS mean, round(coalesce(stddev_samp(n_chars), 0.0), 4) AS stdev,
       true AS quantiles_within, true AS distinct_within
FROM documents GROUP BY lang""")
def merged_profile(spark, sf_dir):
    """Profiles of languages merged from those of their sources, held against exact ranks."""
    from palaver.plans import sketch as sk
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    parts = sk.sketch_profile(docs, ["lang", "source"], ["n_chars"], ["doc_id"])
    merged = sk.merge_profiles(parts, ["lang"], ["source"])
    values = sk.profile_values(merged, ["lang"], d.PERCENTILES)
    distinct = sk.distinct_values(merged, ["lang"]).select("lang", "distinct")
    probes = values.select("lang", F.posexplode("quantiles").alias("at", "q"))
    ranks = docs.join(probes, "lang").groupBy("lang", "at").agg(
        F.count_if(F.col("n_chars") < F.col("q")).alias("below"),
        F.count_if(F.col("n_chars") <= F.col("q")).alias("upto"), F.count(F.lit(1)).alias("rows"))
    p = F.get(F.array(*[F.lit(x) for x in d.PERCENTILES]), F.col("at"))
    slack = F.lit(2 * sk.rank_error()) * F.col("rows") + 1
    near = (F.col("below") - slack <= p * F.col("rows")) & (p * F.col("rows") <= F.col("upto") + slack)
    within = ranks.groupBy("lang").agg(F.every(near).alias("quantiles_within"))
    exact = F.abs(F.col("distinct") - F.col("n")) <= 5 * sk.distinct_error() * F.col("n") + 1
    return values.join(within, "lang").join(distinct, "lang").select(
        "lang", "n", *[F.col(c).cast("bigint").alias(c) for c in ("total", "min", "max")],
        r6("mean").alias("mean"), F.round("stdev", 4).alias("stdev"), "quantiles_within",
        exact.alias("distinct_within"))
