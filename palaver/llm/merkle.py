"""Merkle manifest of a dataset by sibling-shift self-joins.

A row's leaf is the SHA-256 of its fields, each with its length.  The leaves of a
group (a source), in the order of a key, are the lowest level of a tree; every run
of ``ARITY`` neighbours has one parent.  A level is joined with itself on computed
sibling places (place shifted within its run, once for each other slot), which
gives every node its siblings; the rows of slot zero then emit the parents.  The
tops of the groups, ordered by group, are the leaves of a last tree, whose top is
the root.

Proofs come from the top down: a node's path is its own step before the path of
its parent, so a join with the next level hands it on, and all joins together move
about half as many paths as there are leaves.  Nothing but the root and the size of the
largest group reaches the driver; a join key has ``ARITY`` rows at most, however
many rows a group has.

NULL fields are marked and differ from empty ones.  A NULL group is a group of its own and
comes first, and so does a NULL key in its group; rows of one key stand in the
order of their leaves, so repeated rows are leaves of their own.  Texts are hashed whole.
An empty table has an empty result.  Only the named columns of the input are read, so
others may have any name; a field named like a column of the result is no
conflict.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palaver.functions.text import floor_div
from palaver.llm.common import written

ARITY = 3
_STEP = "struct<left string, right string>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of texts put together."""
    return F.sha2(F.concat(*parts), 256)


def leaf(fields: Sequence[Column]) -> Column:
    """Digest of the fields: ``-`` for NULL, else UTF-8 length, ``:`` and value."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.coalesce(
            F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return digest(*parts)


def _same(left: DataFrame, right: DataFrame, group: str, other: str) -> Column:
    return left[group].eqNullSafe(right[other])


def placed(rows: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with their place ``at`` (from 0) in their group and its size ``n``.

    Rows are dealt to tasks by ranges of (group, order) and numbered there; only a
    count for each task and group is added up.  No task holds a whole group.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [group, *order]
    rows = written(rows.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
                   .withColumn("line", F.monotonically_increasing_id()), name)
    task = F.shiftright("line", 33)
    counts = rows.groupBy(F.col(group).alias("g"), task.alias("task")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("line").alias("first"))
    whole = Window.partitionBy("g")
    counts = counts.select(
        "g", "task", "first", F.sum("rows").over(whole).alias("n"),
        (F.sum("rows").over(whole.orderBy("task")) - F.col("rows")).alias("before"))
    joined = rows.join(counts, _same(rows, counts, group, "g") & (task == counts["task"]))
    return joined.select(*rows.drop("line").columns,
                         (F.col("line") - F.col("first") + F.col("before")).alias("at"), "n")


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes ``tree, at, n, node`` with the digests ``left`` and ``right`` of them in their run."""
    slot = F.col("at") % arity
    steps, joined = range(1, arity), nodes
    for k in steps:
        sibling = nodes.select(F.col("tree").alias(f"tree{k}"), F.col("at").alias(f"at{k}"),
                               F.col("node").alias(f"node{k}"))
        shifted = F.col("at") - slot + (slot + k) % arity
        joined = joined.join(
            sibling, F.col("tree").eqNullSafe(F.col(f"tree{k}")) & (shifted == F.col(f"at{k}")),
            "left")

    def side(before: bool) -> Column:
        return F.concat(*(
            F.when((slot + k >= arity) == F.lit(before), F.coalesce(f"node{k}", F.lit("")))
            .otherwise("") for k in steps))

    return joined.select("tree", "at", "n", "node", side(True).alias("left"),
                         side(False).alias("right"))


def levels(nodes: DataFrame, arity: int) -> list[DataFrame]:
    """Every level of all trees, from the leaves up; a tree ends at the level where ``n`` is 1."""
    largest = nodes.agg(F.max("n")).first()[0]
    found = []
    while largest:
        level = written(with_siblings(nodes, arity), "merkle-level")
        found.append(level)
        if largest == 1:
            break
        nodes = level.where((F.col("at") % arity == 0) & (F.col("n") > 1)).select(
            "tree", floor_div(F.col("at"), arity).alias("at"),
            floor_div(F.col("n") + (arity - 1), arity).alias("n"),
            digest(F.col("node"), F.col("right")).alias("node"))
        largest = -(-largest // arity)
    return found


def tops(found: list[DataFrame]) -> DataFrame:
    """The last node of every tree."""
    return reduce(DataFrame.union, [level.where("n = 1").select("tree", "node") for level in found])


def _down(found: list[DataFrame], top_paths: DataFrame | None, arity: int) -> DataFrame:
    """``tree, at, node, subroot, path`` of every node of the lowest level.

    ``top_paths`` has ``t, subroot, path`` for the top of every tree; without it the
    tops are where paths end.
    """
    paths = None
    for level in reversed(found):
        here = level.where("n = 1")
        if top_paths is None:
            here = here.withColumns({"subroot": F.col("node"),
                                     "path": F.array().cast(f"array<{_STEP}>")})
        else:
            here = here.join(top_paths, _same(here, top_paths, "tree", "t"))
        here = here.select("tree", "at", "node", "subroot", "path")
        if paths is not None:
            above = paths.select(F.col("tree").alias("t"), F.col("at").alias("above"), "subroot",
                                 F.col("path").alias("rest"))
            inner = level.where("n > 1")
            inner = inner.join(above, _same(inner, above, "tree", "t")
                               & (floor_div(F.col("at"), arity) == F.col("above")))
            here = here.union(inner.select(
                "tree", "at", "node", "subroot",
                F.concat(F.array(F.struct("left", "right")), "rest").alias("path")))
        paths = here
    return paths


def manifest(docs: DataFrame, key: str, group: str, fields: Sequence[str],
             carried: Mapping[str, Column] | None = None, arity: int = ARITY) -> DataFrame:
    """``key, leaf, subroot, root, path`` and the columns ``carried`` of every row.

    ``path`` lists, from the leaf up to the root, the digests left and right of the
    node in its run.  ``carried`` columns are computed from ``docs`` and kept
    beside the leaf; they take part in no order.
    """
    carried = dict(carried or {})
    rows = docs.select(
        F.col(f"`{group}`").alias("tree"), F.col(f"`{key}`").alias("key"),
        leaf([F.col(f"`{f}`") for f in fields]).alias("node"),
        *(c.alias(f"carried_{name}") for name, c in carried.items()))
    ordered = written(placed(rows, "tree", ["key", "node"], "merkle-rows"), "merkle-leaves")
    nodes = ordered.select("tree", "at", "n", "node")
    found = levels(nodes, arity)
    kept = [F.col(f"carried_{name}").alias(name) for name in carried]
    if not found:
        return ordered.select(
            F.col("key").alias(key), F.col("node").alias("leaf"), F.lit("").alias("subroot"),
            F.lit("").alias("root"), F.array().cast(f"array<{_STEP}>").alias("path"), *kept)
    forest = tops(found).select(F.lit("").alias("tree"), F.col("tree").alias("source"), "node")
    forest = written(placed(forest, "tree", ["source"], "merkle-tops"), "merkle-forest")
    upper = levels(forest.select("tree", "at", "n", "node"), arity)
    root = tops(upper).first()["node"]
    above = _down(upper, None, arity).select(F.col("at").alias("place"), "path")
    top_paths = forest.join(above, F.col("at") == F.col("place")).select(
        F.col("source").alias("t"), F.col("node").alias("subroot"), "path")
    paths = _down(found, top_paths, arity).select(
        F.col("tree").alias("t"), F.col("at").alias("place"), "subroot", "path")
    return (ordered.join(paths, _same(ordered, paths, "tree", "t") & (F.col("at") == F.col("place")))
            .select(F.col("key").alias(key), F.col("node").alias("leaf"), "subroot",
                    F.lit(root).alias("root"), "path", *kept))


def proof(path: str = "path") -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(start: Column, path: str = "path") -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, start, lambda node, s: digest(s["left"], node, s["right"]))
