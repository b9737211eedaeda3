"""Curation of source metadata and checks of stored conversations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from palaver.functions.content import is_json, json_list_length
from palaver.functions.text import contains_any
from palaver.operators.scan import prefix_sums, turn_bucket

# What makes a media entry unusable.
SKIP_EXTENSIONS = (".svg", ".gif", ".tif")
SKIP_KEYWORDS = (
    "icon", "logo", "flag", "symbol", "button", "arrow", "commons-logo", "wiki", "edit-clear",
    "padlock", "ambox", "disambiguation", "stub", "question_book", "folder_hexagonal", "text-x",
    "increase2", "decrease2", "steady2",
)
SKIP_MIME = ("image/svg+xml", "image/gif")


def usable_media(title: Column, width: Column, height: Column, mime: Column,
                 min_width: int = 400, min_height: int = 300) -> Column:
    """Predicate for large enough raster images with a proper title."""
    return (~contains_any(title, SKIP_EXTENSIONS) & ~contains_any(title, SKIP_KEYWORDS)
            & (width >= min_width) & (height >= min_height)
            & F.startswith(mime, F.lit("image/")) & ~mime.isin(*SKIP_MIME))


def first_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row of every key in the given order.

    An aggregate, not a window: copies of a hot key collapse on the map side.
    """
    whole = F.struct(*df.columns)
    return (df.groupBy(key).agg(F.min_by(whole, F.struct(*order)).alias("_row"))
            .select("_row.*"))


def balanced_cap(df: DataFrame, category: str, category_order: str, position: str,
                 target: int, block: int = 1 << 16) -> DataFrame:
    """About ``target`` rows, spread over categories.

    Each category first gives ``target div categories`` rows in ``position``
    order; the shortfall is filled from what is left over, category by
    category in ``category_order``.  ``position`` is an integer unique within
    the category.  Rows without a category (NULL) are a category of their own.
    """
    # A struct is never NULL, so it can be a key of the scan and of the join.
    df = df.withColumn("_category", F.struct(category))
    counts = df.groupBy("_category", category_order).agg(F.count(F.lit(1)).alias("_n"))
    k = counts.agg(F.count(F.lit(1))).scalar()
    quota = F.call_function("div", F.lit(target).cast("bigint"), k)
    sized = counts.withColumn("_quota", quota).withColumn(
        "_over", F.greatest(F.lit(0).cast("bigint"), F.col("_n") - F.col("_quota")))
    # Windows over the category table only: one row per category.
    earlier = Window.orderBy(category_order).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(category_order).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = sized.select(
        "_category", "_quota", F.coalesce(F.sum("_over").over(earlier), F.lit(0)).alias("_skip"),
        (F.lit(target) - F.sum(F.least("_n", "_quota")).over(everything)).alias("_missing"))
    ranked = prefix_sums(df, ["_category"], turn_bucket(position, block), [position],
                         {"_rank": F.lit(1).cast("bigint")}).drop("_bkt")
    spare = F.col("_skip") + F.col("_rank") - F.col("_quota")
    return (ranked.join(offsets, ["_category"])
            .filter((F.col("_rank") <= F.col("_quota")) | (spare <= F.col("_missing")))
            .drop("_category", "_quota", "_skip", "_missing", "_rank"))


def invalid_messages(df: DataFrame, column: str = "messages") -> DataFrame:
    """Rows whose message JSON is broken or an empty list, with the reason."""
    size = json_list_length(F.col(column))
    reason = (F.when(~is_json(F.col(column)), "invalid")
              .when(size.isNull(), "not a list").when(size == 0, "empty"))
    return df.withColumn("problem", reason).filter(F.col("problem").isNotNull())
