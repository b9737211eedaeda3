"""Readers.  All are lazy; schemas are declared, never inferred from data."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from palaver.operators.assemble import profile_input
from palaver.operators.mix import SOURCE
from palaver.operators.order import first_rows
from palaver.operators.sampling import exact_sample
from palaver.plans.manifest import build_manifests
from palaver.sources import schemas

#: No Parquet file of conversations without rows is longer.
FOOTER_BYTES = 1 << 16

def read_dataset(spark: SparkSession, path: str, family: str, columns: Sequence[str] | None = None,
                 sample_size: int | None = None, seed: int = 42) -> DataFrame:
    """Stored conversations of one family, optionally pruned or sampled."""
    df = spark.read.schema(schemas.family_schema(family)).parquet(path)
    if sample_size is not None:
        df = exact_sample(df, sample_size, ["conversation_id"], seed)
    return df.select(*columns) if columns else df


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.SESSION).json(path)


def read_traces(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.TRACE).json(path)


def read_metadata(spark: SparkSession, path: str, schema: str, order: Sequence[str],
                  count: int | None = None) -> DataFrame:
    """Source metadata (a JSON array file), cut to the first ``count`` of a given order."""
    df = spark.read.schema(schema).option("multiLine", True).json(path)
    return first_rows(df, count, order) if count is not None else df


def read_sources(spark: SparkSession, sources: Sequence[Mapping[str, object]]) -> dict[str, DataFrame]:
    """Every available source by type, tagged with its name.

    A missing optional source is left out; a missing required one, or none at
    all, is an error.
    """
    found: dict[str, DataFrame] = {}
    for source in sources:
        kind, path = str(source["type"]), str(source["path"])
        try:
            df = spark.read.parquet(path)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            if source.get("required", False):
                raise FileNotFoundError(f"required source dataset not found: {path}") from error
            continue
        found[kind] = df.withColumn(SOURCE, F.lit(kind))
    if not found:
        raise ValueError("no source datasets could be loaded")
    return found


def manifest_schema(spark: SparkSession) -> StructType:
    """Schema of manifest files: that of a manifest over all known columns."""
    none = spark.createDataFrame([], schemas.family_schema("mixed"))
    return build_manifests(profile_input(none).withColumn("dataset_type", F.lit("mixed"))).schema


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """All manifest documents below ``path``, one row each."""
    return (spark.read.schema(manifest_schema(spark)).option("multiLine", True)
            .option("recursiveFileLookup", True).json(path))


def read_manifest(spark: SparkSession, manifest_path: str, dataset_path: str,
                  family: str) -> DataFrame:
    """A stored manifest, else one computed from the dataset itself."""
    try:
        return read_manifests(spark, manifest_path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
    rows = profile_input(read_dataset(spark, dataset_path, family))
    return build_manifests(rows.withColumn("dataset_type", F.lit(family)))


def dataset_key(path: Column, root: str) -> Column:
    """Path of a dataset below ``root``: up to its first ``.parquet`` file or directory."""
    below = F.regexp_extract(path, re.escape(root.rstrip("/").split(":", 1)[-1].lstrip("/"))
                             + "/(.*)$", 1)
    return F.regexp_extract(below, r"^((?:[^/]+/)*?[^/]+\.parquet)(?:/.*)?$", 1)


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """``path`` of every file below ``root``; contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", pattern).load(root).select("path"))


def find_datasets(spark: SparkSession, root: str, pattern: str = "*.parquet",
                  skip: str = "trace") -> DataFrame:
    """``dataset_file, path`` of every file of the datasets below ``root``.

    ``dataset_file`` is a dataset's path there; derived exports are left out.
    """
    files = list_files(spark, root, pattern).withColumn(
        "dataset_file", dataset_key(F.col("path"), root))
    return files.filter(_is_dataset(F.col("dataset_file"), skip)).select("dataset_file", "path")


def _is_dataset(key: Column, skip: str) -> Column:
    name = F.element_at(F.split(key, "/"), -1)
    return (key != "") & ~F.contains(name, F.lit(skip))


def _stored_rows(spark: SparkSession, root: str, pattern: str, skip: str) -> DataFrame:
    """Rows of all datasets with ``dataset_file`` and ``path``; what cannot be read is passed over."""
    reader = (spark.read.schema(schemas.family_schema("mixed")).option("recursiveFileLookup", True)
              .option("pathGlobFilter", pattern).option("ignoreCorruptFiles", True))
    path = F.col("_metadata.file_path")
    rows = reader.parquet(root).withColumns({"dataset_file": dataset_key(path, root), "path": path})
    return rows.filter(_is_dataset(F.col("dataset_file"), skip))


def _closed_files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """``path`` of small files with both marks of a Parquet file: those without rows are such.

    The bound on the length reaches the listing, so no larger file is opened.
    """
    mark = F.lit("PAR1").cast("binary")
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", pattern).option("ignoreCorruptFiles", True).load(root)
            .filter(F.col("length") <= FOOTER_BYTES)
            .filter(F.startswith("content", mark) & F.endswith("content", mark)
                    & (F.col("length") > 12)).select("path", F.lit(True).alias("closed")))


def broken_datasets(spark: SparkSession, root: str, pattern: str = "*.parquet",
                    skip: str = "trace") -> DataFrame:
    """``dataset_file, broken_files`` of the datasets that cannot be read as a whole.

    A file is whole if it can be opened and as many rows can be decoded as its
    footer states: counting rows without columns reads footers only, counting them by
    a hash of all columns reads every page.  A file without rows needs its marks.  Each is
    one aggregate over all files, so the plan is the same for any number of datasets.
    """
    rows = _stored_rows(spark, root, pattern, skip)
    columns = [c for c in rows.columns if c not in ("dataset_file", "path")]
    stated = rows.groupBy("path").agg(F.count(F.lit(1)).alias("stated"))
    # The remainder is always below 2, which the optimizer does not know.
    read = F.pmod(F.xxhash64(*columns), F.lit(2)) < 2
    decoded = rows.groupBy("path").agg(F.count_if(read).alias("decoded"))
    whole = F.when(F.col("stated") > 0, F.col("stated") == F.coalesce("decoded", F.lit(0))
                   ).otherwise(F.col("closed"))
    return (find_datasets(spark, root, pattern, skip).join(stated, "path", "left")
            .join(decoded, "path", "left").join(_closed_files(spark, root, pattern), "path", "left")
            .filter(~F.coalesce(whole, F.lit(False))).groupBy("dataset_file")
            .agg(F.count(F.lit(1)).alias("broken_files")))


def read_all_datasets(spark: SparkSession, root: str, pattern: str = "*.parquet",
                      skip: str = "trace") -> tuple[DataFrame, DataFrame]:
    """Rows of all datasets below ``root``, and the datasets that cannot be read.

    ``dataset_file`` is the path of a row's dataset below ``root``.  A dataset with
    an unreadable file is left out as a whole, so no result counts a part of it.
    """
    broken = broken_datasets(spark, root, pattern, skip)
    rows = _stored_rows(spark, root, pattern, skip).drop("path")
    return rows.join(broken.select("dataset_file"), "dataset_file", "left_anti"), broken
