"""Sinks.  Every export is written in parallel by Spark's own writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from palaver.operators import export
from palaver.operators.assemble import to_stored


def write_dataset(rows: DataFrame, path: str, mode: str = "errorifexists",
                  partition_by: str | None = None) -> None:
    """Stored conversations with JSON text for nested columns."""
    writer = to_stored(rows).write.mode(mode)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def write_sessions(messages: DataFrame, path: str, mode: str = "errorifexists", **options) -> None:
    """Session lines, one for each conversation."""
    export.sessions(messages, **options).write.mode(mode).json(path)


def write_traces(messages: DataFrame, path: str, mode: str = "errorifexists",
                 records_per_file: int = 10_000, variant: str = "reply", **options) -> None:
    """Trace lines; file size is bounded because contexts repeat.

    The variant is ``reply``, ``words``, ``mixed`` (with its ``granularity``) or
    ``replay``.
    """
    build = {"reply": export.trace, "words": export.word_trace, "mixed": export.mixed_trace,
             "replay": export.replay_trace}[variant]
    out = build(messages, **options)
    keep = [c for c in ("session_id", "messages", "output_length", "delay") if c in out.columns]
    out.select(*keep).write.mode(mode).option("maxRecordsPerFile", records_per_file).json(path)


def write_fine_tuning(messages: DataFrame, path: str, mode: str = "errorifexists") -> None:
    export.fine_tuning(messages).write.mode(mode).json(path)


def write_rows(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Whole rows as JSON lines."""
    rows.write.mode(mode).json(path)


def write_csv(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    to_stored(rows).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_manifests(manifests: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Indented JSON documents, a file for each dataset."""
    key = "dataset_file" if "dataset_file" in manifests.columns else "dataset.type"
    text = F.to_json(F.struct(*[c for c in manifests.columns if c != "dataset_file"]),
                     {"pretty": "true"})
    (manifests.select(F.col(key).alias("dataset_key"), text.alias("value"))
     .write.mode(mode).option("maxRecordsPerFile", 1).partitionBy("dataset_key").text(path))


def write_json_array(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON array over all rows.

    The rows are written as lines in parallel, beside ``path``; a single document needs
    a single writer, which only puts these lines together.
    """
    spark, lines = rows.sparkSession, path.rstrip("/") + "_lines"
    rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).write.mode("overwrite").text(lines)
    stored = spark.read.schema("value string").text(lines).coalesce(1)
    comma = F.when(F.monotonically_increasing_id() == 0, F.lit("")).otherwise(F.lit(","))
    ends = [spark.range(1).select(F.lit(mark).alias("value")) for mark in "[]"]
    (ends[0].union(stored.select(F.concat(comma, "value").alias("value"))).union(ends[1]).coalesce(1)
     .write.mode(mode).text(path))
    folder = spark._jvm.org.apache.hadoop.fs.Path(lines)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def subset_name(base: str, kind: str, *parts: object) -> str:
    """File names of subsets: ``base_subset_100``, ``base_filtered_2_5``, ``balanced_x_payload``."""
    if kind == "balanced":
        return f"balanced_{base}_payload"
    return "_".join([base, kind, *map(str, parts)])
