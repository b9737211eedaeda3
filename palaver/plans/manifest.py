"""Dataset manifests: one nested row per dataset.

Everything in a manifest - statistics, histograms, categories, tags, payload
score - is derived from one table of value counts, so the conversations are
read and shuffled once however many sections there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from palaver.functions.text import share
from palaver.operators import distribution as d
from palaver.operators import payload as p
from palaver.operators import tags as tg

MANIFEST_VERSION = "1.0.0"

# The category column of every family.
CATEGORY_COLUMNS = {
    "text": "topic", "reasoning": "topic", "random": "topic", "repeat": "topic",
    "agentic": "task_type", "pdf": "conversation_type", "image": "conversation_type",
}
SIZE_METRICS = ("num_turns", "estimated_tokens", "total_characters", "num_messages")
GROWTH_METRICS = ("growth_ratio", "first_chars", "last_chars")
TASK_METRICS = ("success_score", "num_tool_calls", "num_errors")
PERCENTILE_NAMES = tuple(f"p{round(100 * x)}" for x in d.PERCENTILES)


def _r2(column: Column) -> Column:
    return F.round(column, 2)


def category_of(conversations: DataFrame, kind: Column) -> Column:
    """The family's category value; NULL for families without one."""
    out = F.lit(None).cast("string")
    for family, column in CATEGORY_COLUMNS.items():
        if column in conversations.columns:
            out = F.when(kind == family, F.col(column)).otherwise(out)
    return out


def profile_counts(conversations: DataFrame, key: str, kind: Column) -> DataFrame:
    """``(key, metric, label, value, n)``: counts of all numbers and labels."""
    columns = set(conversations.columns)
    no_label, no_value = F.lit(None).cast("string"), F.lit(None).cast("double")
    cells: list[Column] = []

    def number(name: str, value: Column) -> None:
        cells.append(F.struct(F.lit(name).alias("metric"), no_label.alias("label"),
                              value.cast("double").alias("value")))

    def label(name: str, value: Column) -> None:
        cells.append(F.struct(F.lit(name).alias("metric"), value.alias("label"),
                              no_value.alias("value")))

    for name in SIZE_METRICS:
        number(name, F.col(name))
    for name in GROWTH_METRICS:
        number(name, F.when(F.col("growth_ratio").isNotNull(), F.col(name)))
    for name in TASK_METRICS:
        if name in columns:
            number(name, F.when(kind == "agentic", F.col(name)))
    label("category", category_of(conversations, kind))
    for column, name, family in (("paper_arxiv_id", "paper", "pdf"), ("image_url", "image", "image"),
                                 ("image_topic", "image_topic", "image")):
        if column in columns:
            label(name, F.when(kind == family, F.col(column)))
    return (conversations.select(key, F.inline(F.array(*cells)))
            .filter(F.col("value").isNotNull() | F.col("label").isNotNull())
            .groupBy(key, "metric", "label", "value").agg(F.count(F.lit(1)).alias("n")))


def _range_label(integral: Column) -> Column:
    lo, hi = F.col("edge_lo"), F.col("edge_hi")
    single = F.when(integral, F.format_string("%d-%d", lo.cast("bigint"), hi.cast("bigint"))
                    ).otherwise(F.concat_ws("-", lo.cast("string"), hi.cast("string")))
    return F.when(lo == hi, single).otherwise(F.format_string("%.1f-%.1f", lo, hi))


def _number_sections(numbers: DataFrame, key: str) -> DataFrame:
    """One row per dataset with a struct per numeric metric."""
    by = [key, "metric"]
    metric = F.col("metric")
    quantiles = d.quantiles(numbers, by, d.PERCENTILES).groupBy(*by).agg(F.struct(*[
        F.max(F.when(F.col("p") == x, F.col("value"))).alias(name)
        for x, name in zip(d.PERCENTILES, PERCENTILE_NAMES)]).alias("q"))
    bins = (F.when(metric == "num_turns", F.least(F.lit(10.0), F.col("hi") - F.col("lo") + 1))
            .when(metric == "estimated_tokens", F.lit(10.0))
            .when(metric == "success_score", F.lit(5.0)).otherwise(F.lit(1.0)))
    # The list of a metric has at most ten bins.
    bars = d.histogram(numbers, by, bins).groupBy(*by).agg(F.transform(
        F.array_sort(F.collect_list(F.struct(
            "bin", _range_label(metric != "success_score").alias("range"), "count"))),
        lambda b: F.struct(b["range"].alias("range"), b["count"].alias("count"))
    ).alias("histogram"))
    facts = (d.moments(numbers, by).join(quantiles, by).join(bars, by))
    struct = F.struct("n", "total", "min", "max", "mean", "stdev", "q", "histogram")
    names = (*SIZE_METRICS, *GROWTH_METRICS, *TASK_METRICS)
    return facts.groupBy(key).agg(*[
        F.max_by(struct, F.when(metric == name, F.lit(1))).alias(name) for name in names])


def _label_sections(counts: DataFrame, key: str) -> DataFrame:
    """Category lists, distinct items and turn buckets per dataset.

    Only category labels are gathered into lists: a family has as many as its
    configuration names.  Papers and images are counted, never gathered.
    """
    labels = counts.groupBy(key, "metric", "label").agg(
        F.sum("n").alias("n"),
        *[F.sum(F.when((F.col("metric") == "num_turns") & test, F.col("n")).otherwise(0))
          .alias(f"_b{i}") for i, (_, test) in enumerate(d.turn_bucket_tests("value"))])

    def listed(metric: str) -> Column:
        return F.array_sort(F.collect_list(F.when(
            (F.col("metric") == metric) & F.col("label").isNotNull(),
            F.struct((-F.col("n")).alias("o"), F.col("label"), F.col("n")))))

    def distinct(metric: str) -> Column:
        return F.count(F.when(F.col("metric") == metric, F.col("label")))

    buckets = [F.struct(F.lit(label).alias("bucket"), F.sum(f"_b{i}").alias("count"))
               for i, (label, _) in enumerate(d.turn_bucket_tests("value"))]
    return labels.groupBy(key).agg(
        F.array(*buckets).alias("buckets"), listed("category").alias("categories"),
        listed("image_topic").alias("image_topics"),
        distinct("paper").alias("papers"), distinct("image").alias("images"))


def _shares(entries: Column) -> Column:
    whole = F.aggregate(entries, F.lit(0).cast("bigint"), lambda t, e: t + e["n"])
    return F.transform(entries, lambda e: F.struct(
        e["label"].alias("value"), e["n"].alias("count"),
        _r2(share(e["n"], whole)).alias("percentage")))


def _basic(metric: str, total: bool = False, spread: bool = True, bars: bool = False) -> Column:
    m = F.col(metric)
    fields = [m["total"].cast("bigint").alias("total")] if total else []
    fields += [m["min"].cast("bigint").alias("min"), m["max"].cast("bigint").alias("max"),
               _r2(m["mean"]).alias("mean"), _r2(m["q"]["p50"]).alias("median")]
    if spread:
        fields += [_r2(m["stdev"]).alias("stdev"), F.struct(*[
            _r2(m["q"][name]).alias(name) for name in PERCENTILE_NAMES]).alias("percentiles")]
    if bars:
        fields.append(m["histogram"].alias("histogram"))
    return F.struct(*fields)


def _profile_struct(kind: Column, tasks: bool, media: bool) -> Column:
    turns, growth = F.col("num_turns"), F.col("growth_ratio")
    bucket_rows = F.transform("buckets", lambda b: F.struct(
        b["bucket"].alias("bucket"), b["count"].alias("count"),
        _r2(share(b["count"], turns["n"])).alias("percentage")))
    turn_part = _basic("num_turns", bars=True).withField("bucket_distribution", bucket_rows)

    def centre(metric: str) -> Column:
        return F.struct(_r2(F.col(metric)["mean"]).alias("mean"),
                        _r2(F.col(metric)["q"]["p50"]).alias("median"))

    growth_part = F.when(growth.isNotNull(), F.struct(
        F.struct(_r2(growth["min"]).alias("min"), _r2(growth["max"]).alias("max"),
                 _r2(growth["mean"]).alias("mean"), _r2(growth["q"]["p50"]).alias("median"))
        .alias("growth_ratio"), centre("first_chars").alias("first_turn_chars"),
        centre("last_chars").alias("last_turn_chars")))
    names = F.create_map(*[F.lit(x) for kv in CATEGORY_COLUMNS.items() for x in kv])
    category_part = F.when(F.size("categories") > 0, F.struct(
        F.try_element_at(names, kind).alias("column"),
        _shares(F.col("categories")).alias("distribution")))
    fields = [turn_part.alias("turn_distribution"),
              _basic("estimated_tokens", total=True, bars=True).alias("token_distribution"),
              _basic("total_characters", total=True).alias("character_distribution"),
              _basic("num_messages", spread=False).alias("message_count_distribution"),
              growth_part.alias("context_growth"), category_part.alias("category_distribution")]
    if tasks:
        score, calls, errors = (F.col(m) for m in TASK_METRICS)
        rate = F.coalesce(_r2(share(errors["total"], calls["total"])), F.lit(0.0))
        fields.append(F.when(kind == "agentic", F.struct(
            F.struct(*[F.round(c, 4).alias(n) for n, c in (
                ("min", score["min"]), ("max", score["max"]), ("mean", score["mean"]),
                ("median", score["q"]["p50"]))], score["histogram"].alias("histogram"))
            .alias("success_score"),
            F.struct(calls["total"].cast("bigint").alias("total"),
                     _r2(calls["mean"]).alias("mean_per_conversation"),
                     calls["max"].cast("bigint").alias("max_per_conversation")).alias("tool_calls"),
            F.struct(errors["total"].cast("bigint").alias("total"), rate.alias("error_rate"))
            .alias("errors"))).alias("agentic_metrics"))
    if media:
        fields.append(F.when(kind.isin("pdf", "image"), F.struct(
            F.when(kind == "pdf", F.col("papers")).alias("unique_papers"),
            F.when(kind == "image", F.col("images")).alias("unique_images"),
            F.when(kind == "image", _shares(F.col("image_topics")))
            .alias("image_topic_distribution"))).alias("multimodal_info"))
    return F.struct(*fields)


def dataset_facts(conversations: DataFrame, key: str, kind: Column) -> DataFrame:
    """One row per dataset with everything its manifest needs."""
    counts = profile_counts(conversations, key, kind)
    # Not a filter: it would be pushed below the counting and split the shared
    # exchange.  Labels collapse to one row per metric and are not looked at.
    numbers = counts.groupBy(key, "metric", "value").agg(F.sum("n").alias("n"))
    return _number_sections(numbers, key).join(_label_sections(counts, key), [key])


def _sections(conversations: DataFrame) -> tuple[bool, bool]:
    columns = set(conversations.columns)
    return set(TASK_METRICS) <= columns, bool({"paper_arxiv_id", "image_url"} & columns)


def distribution_profile(conversations: DataFrame, key: str = "dataset_type",
                         kind: Column | None = None) -> DataFrame:
    """``(key, conversations, distribution_profile)`` with rounded statistics.

    ``kind`` gives the family as an expression over ``key`` (default: the key).
    """
    kind = F.col(key) if kind is None else kind
    facts = dataset_facts(conversations, key, kind)
    return facts.select(key, F.col("num_turns.n").alias("conversations"),
                        _profile_struct(kind, *_sections(conversations))
                        .alias("distribution_profile"))


def _payload_struct(kind: Column, **options) -> Column:
    zero = F.lit(0.0)
    sums = {
        "n": F.col("num_turns.n"), "tokens": F.col("estimated_tokens.total"),
        "chars": F.col("total_characters.total"), "turns": F.col("num_turns.total"),
        "ratios": F.coalesce(F.col("growth_ratio.total"), zero),
        "ratio_n": F.coalesce(F.col("growth_ratio.n"), F.lit(0)),
        "tools": F.coalesce(F.col("num_tool_calls.total"), zero),
    }
    scores = p.score_columns(sums, kind, **options)
    prefill, decode = p.raw_factors(sums, kind)

    def breakdown(raw: Mapping[str, Column], maxima: Mapping[str, float]) -> Column:
        return F.struct(
            F.struct(*[p.normalise(c, maxima[n]).alias(n) for n, c in raw.items()])
            .alias("normalized"), F.struct(*[c.alias(n) for n, c in raw.items()]).alias("raw"))

    return F.struct(*[F.round(c, 4).alias(n) for n, c in scores.items()],
                    breakdown(prefill, p.PREFILL_MAX).alias("prefill_breakdown"),
                    breakdown(decode, p.DECODE_MAX).alias("decode_breakdown"))


def build_manifests(conversations: DataFrame, key: str = "dataset_type", seed: int = 42,
                    meta: Mapping[str, Mapping[str, str]] | None = None,
                    user_tags: Sequence[str] = (), extra_tags: Sequence[str] = (),
                    output_files: Column | None = None, day: Column | None = None,
                    include_scores: bool = True, suffix: str | None = None,
                    kind: Column | None = None, keep_key: bool = False,
                    **score_options) -> DataFrame:
    """One manifest row per dataset.

    ``conversations`` has the profile columns (see ``profile_input``) and a
    dataset key; ``kind`` is its family as an expression over the key.  ``meta``
    gives name, version, description and output file name per family.
    ``output_files`` is a map column expression over the key.  With ``keep_key``
    the key column stays beside the manifest.
    """
    meta = meta or {}
    kind = F.col(key) if kind is None else kind

    def described(field: str, default: Column) -> Column:
        out = default
        for family, values in meta.items():
            if field in values:
                out = F.when(kind == family, F.lit(values[field])).otherwise(out)
        return out

    rows = F.col("num_turns.n")
    version = described("version", F.lit("1.0.0"))
    base = described("output_filename", F.concat(F.lit("multi_turn_"), kind, F.lit("_chat.parquet")))
    name = tg.descriptive_name(base, rows, seed, version, day, suffix)
    user = F.array(*[F.lit(t) for t in user_tags]).cast("array<string>")
    extra = F.array(*[F.lit(t) for t in extra_tags]).cast("array<string>")
    auto = F.concat(tg.auto_tags(kind, rows, F.col("estimated_tokens.total"),
                                 F.col("num_turns.max")), extra)
    sections = [
        F.lit(MANIFEST_VERSION).alias("manifest_version"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("generated_at"),
        F.struct(described("name", F.concat(F.lit("multi-turn-"), kind, F.lit("-chat")))
                 .alias("name"), name.alias("descriptive_name"), kind.alias("type"),
                 version.alias("version"), described("description", F.lit("")).alias("description"),
                 rows.alias("num_conversations"), F.lit(seed).cast("bigint").alias("seed"))
        .alias("dataset"),
        F.struct(user.alias("user_tags"), auto.alias("auto_tags"),
                 tg.merge_tags(user, auto).alias("all_tags")).alias("tags"),
        (output_files if output_files is not None
         else F.create_map().cast("map<string,string>")).alias("output_files"),
        _profile_struct(kind, *_sections(conversations)).alias("distribution_profile")]
    if include_scores:
        sections.append(_payload_struct(kind, **score_options).alias("payload_scores"))
    return dataset_facts(conversations, key, kind).select(*([key] if keep_key else []), *sections)
