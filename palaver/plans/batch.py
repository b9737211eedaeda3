"""Re-profile every stored dataset below a folder in one job."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from palaver.operators.assemble import profile_input
from palaver.plans.manifest import build_manifests
from palaver.sources.readers import find_datasets, list_files, read_all_datasets

FAMILIES = ("text", "reasoning", "random", "repeat", "pdf", "image", "agentic", "mixed")


def dataset_family(key: Column, families: Mapping[str, str] | None = None) -> Column:
    """Family of a dataset: as given, else its folder, else a word of its file name."""
    folders = F.slice(F.split(key, "/"), F.lit(1), F.size(F.split(key, "/")) - 1)
    names = F.split(F.regexp_extract(key, r"([^/]+)\.parquet$", 1), "_")
    out = F.lit("mixed")
    for place in (names, folders):
        for family in reversed(FAMILIES):
            out = F.when(F.array_contains(place, family), family).otherwise(out)
    for name, family in (families or {}).items():
        out = F.when(key == name, family).otherwise(out)
    return out


def exports_of(files: DataFrame, datasets: DataFrame) -> DataFrame:
    """``dataset_file, output_files``: each dataset and what lies beside it, by kind.

    Beside a dataset are files and directories of its folder whose names begin with
    its name; the rest of the name is the kind.  ``files`` has ``below``, the paths of all
    files.
    """
    parts = F.split("below", "/")
    # A directory is an export as a whole, so every leading part of a path counts.
    leading = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.struct(
        F.array_join(F.slice(parts, F.lit(1), k - 1), "/").alias("folder"),
        F.element_at(parts, k).alias("other")))
    beside = files.select(F.inline(leading)).distinct()
    name = F.element_at(F.split("dataset_file", "/"), -1)
    named = datasets.select(
        "dataset_file", name.alias("name"),
        F.array_join(F.slice(F.split("dataset_file", "/"), F.lit(1), F.size(F.split("dataset_file", "/")) - 1),
                     "/").alias("folder"),
        F.regexp_replace(name, r"\.parquet$", "").alias("stem"))
    found = (named.join(beside, "folder").filter(F.startswith("other", "stem"))
             .withColumn("kind", F.when(F.col("other") == F.col("name"), "parquet").otherwise(F.replace(
                 F.regexp_replace(F.substr("other", F.length("stem") + 1), r"^[_.]+|[_.]+$", ""),
                 F.lit("."), F.lit("_")))))
    return found.groupBy("dataset_file").agg(F.map_from_entries(F.array_sort(F.collect_set(
        F.struct("kind", "other")))).alias("output_files"))


def regenerate_manifests(spark: SparkSession, root: str, seed: int = 42,
                         families: Mapping[str, str] | None = None, **options
                         ) -> tuple[DataFrame, DataFrame]:
    """A manifest row for each dataset below ``root``, and the datasets left out.

    All datasets are read in one job and grouped by their path; one with an
    unreadable file is left out and named.  Datasets, exports and broken files are
    tables joined by the dataset, so the plan is the same for any number of them.
    """
    rows, broken = read_all_datasets(spark, root)
    manifests = build_manifests(profile_input(rows), "dataset_file", seed,
                                kind=dataset_family(F.col("dataset_file"), families),
                                keep_key=True, **options)
    base = root.rstrip("/").split(":", 1)[-1].lstrip("/") + "/"
    below = F.substr("path", F.instr("path", base) + F.lit(len(base)))
    files = list_files(spark, root).select(below.alias("below"))
    outputs = exports_of(files, find_datasets(spark, root).select("dataset_file").distinct())
    found = manifests.drop("output_files").join(outputs, "dataset_file", "left")
    return found.select(manifests.columns), broken
