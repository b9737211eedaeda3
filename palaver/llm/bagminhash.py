"""Near duplicates by BagMinHash over multisets of word shingles.

The weight axis of every shingle is cut into dyadic levels, (0, 1], (1, 2], (2, 4] and
so on.  Each level of a shingle is a Poisson process, with a rate of the level's
width, whose points come in ascending order; a point names a register and a place
within the level, by halving it until the place is a whole weight, and counts if
the text has the shingle that often.  A register keeps the smallest point that
reached it, so two texts agree in a register with the probability of their
weighted Jaccard similarity.  Points beyond a text's limit are never made; the
limit is raised for texts with an empty register.

Texts with equal multisets form a copy class first, and one representative stands
for it.  Signatures are cut into bands.  Every representative is compared with the
smallest one that shares a bucket with it, exactly, by multiset overlap.  What
these links connect needs no more comparison.  Representatives of a bucket that are
still apart are compared by a byte of each register; pairs that agree in ``LIKELY`` of
them or more (four standard deviations below what a similarity of 0.8 gives) are
verified in the same task, likeliest first.  A pair that other links have
joined meanwhile needs no verification, and a link is given only where it joins two
groups, so a task gives fewer links than it has members, however many pairs it goes
through.  Sketches travel to the blocks first, and shingles only of members that have a
likely partner there.  A bucket of more than ``BLOCK`` bytes is cut into blocks, and any two of its
blocks are compared by themselves, so no task needs a whole bucket and no pair of a
bucket is left out.  Blocks of one connected group are not compared with each other.

Words are parted by ASCII white space.  A text of one to four words is one shingle;
an empty or NULL text has none and is a class of its own.  Rows of one id are one
document.  Rows with a NULL id have no class and are always kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palaver.llm.common import ODD, Words, grams, mix, sifted, slices, utf8, written
from palaver.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 30, 7
REGISTERS = BANDS * ROWS
LIKELY = 0.69
BLOCK = 8 << 20
_LEVEL = np.uint64(0xD6E8FEB86659FD93)
_POINT = np.uint64(0xA0761D6478BD642F)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, hash and multiplicity of the distinct shingles of a slice, in order."""
    words = Words(data, offsets)
    at, h = grams(words, SHINGLE)
    doc = words.doc[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
    if len(short):
        whole = [mix(np.bitwise_xor.reduce(words.hashes[a:b] * ODD ** np.arange(
            1, b - a + 1, dtype=np.uint64), keepdims=True))[0]
            for a, b in zip(words.bounds[short], words.bounds[short + 1])]
        doc, h = np.append(doc, short), np.append(h, np.array(whole, np.uint64))
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    return doc[first], h[first], np.diff(np.append(first, len(h)))


def _points(doc, h, low, width, weight, limit, least) -> None:
    """Run the processes of the given levels and keep each register's least point."""
    x = np.zeros(len(h))
    salt = np.zeros(1, np.uint64)
    while len(h):
        draw = mix(h + salt)
        x = x - np.log(((draw >> np.uint64(11)) + 0.5) / (1 << 53)) / width
        live = x <= limit[doc]
        doc, h, low, width, weight, x, draw = (
            v[live] for v in (doc, h, low, width, weight, x, draw))
        draw = mix(draw + _LEVEL)
        register = ((draw >> np.uint64(32)) * np.uint64(REGISTERS)) >> np.uint64(32)
        # The low bits halve the level again and again: its width is a power of two.
        place = low + 1 + (draw & (width - 1).astype(np.uint64)).astype(np.int64)
        fits = place <= weight
        np.minimum.at(least, doc[fits] * REGISTERS + register[fits].astype(np.int64), x[fits])
        salt += _POINT


def signatures(doc: np.ndarray, h: np.ndarray, weight: np.ndarray, size: int) -> np.ndarray:
    """Registers of ``size`` texts; texts without a shingle keep infinite ones."""
    total = np.bincount(doc, weight, size)
    depth = np.ceil(np.log2(weight)).astype(np.int64) + 1
    row = np.repeat(np.arange(len(h)), depth)
    level = np.arange(len(row)) - np.repeat(np.cumsum(depth) - depth, depth)
    width = np.where(level == 0, 1, 1 << np.maximum(level - 1, 0))
    low = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    seed = mix(h[row] + (level.astype(np.uint64) + np.uint64(1)) * _LEVEL)
    doc, weight = doc[row], weight[row]
    least = np.full(size * REGISTERS, np.inf)
    factor, open_ = np.log(REGISTERS) + 5, total > 0
    while open_.any():
        use = open_[doc]
        limit = factor * REGISTERS / np.maximum(total, 1)
        _points(doc[use], seed[use], low[use], width[use], weight[use], limit, least)
        open_ &= np.isinf(least.reshape(size, REGISTERS)).any(1)
        factor *= 2
    return least.reshape(size, REGISTERS)


def bands(least: np.ndarray) -> np.ndarray:
    """A hash for each band of each signature."""
    values = least.view(np.uint64).reshape(len(least), BANDS, ROWS)
    h = np.zeros((len(least), BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    for row in range(ROWS):
        h = mix(h * ODD + values[:, :, row])
    return h


def signed(rows: DataFrame) -> DataFrame:
    """``id, k1, k2, n, bands, sketch`` of the columns ``id`` and ``text`` (bytes).

    ``k1`` and ``k2`` hash the multiset of shingles, ``n`` is its size; the sketch has
    a byte of each register.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in slices(batch.column(1), 1 << 20):
                size = end - row
                doc, h, weight = shingles(data, offsets)
                least = signatures(doc, h, weight, size)
                found = bands(least)
                sketch = mix(least.view(np.uint64)).astype(np.uint8)
                keys = []
                for salt in (_LEVEL, _POINT):
                    key = np.zeros(size, np.uint64)
                    np.add.at(key, doc, mix((h ^ salt) * ODD + weight.astype(np.uint64)))
                    keys.append(pa.array(key.view(np.int64)))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(size + 1) * BANDS, pa.int32()),
                    pa.array(found.view(np.int64).ravel()))
                n = np.bincount(doc, weight, size).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, size), *keys, pa.array(n), lists,
                     pa.array([x.tobytes() for x in sketch], pa.binary())],
                    names=["id", "k1", "k2", "n", "bands", "sketch"])

    return rows.select("id", "text").mapInArrow(
        run, "id long, k1 long, k2 long, n long, bands array<long>, sketch binary")


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets (sorted hashes, counts)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = np.minimum(a[1][i], b[1][j]).sum()
    return common / max(a[1].sum() + b[1].sum() - common, 1)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def bag(text: bytes):
        return shingles(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[1:]

    known, known_bag = None, None
    for batch in batches:
        found = []
        for a, b, left, right in zip(*(c.to_pylist() for c in batch)):
            if left != known:
                known, known_bag = left, bag(left)
            s = overlap(known_bag, bag(right))
            if s >= SIMILARITY:
                found.append((a, b, s))
        columns = list(zip(*found)) if found else [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
             pa.array(columns[2], pa.float64())], names=["a", "b", "similarity"])


def verified(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of at least ``SIMILARITY``, by their whole texts."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    texts = written(sifted(rows, ids).join(ids, "id", "left_semi"), "candidate-texts")
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("right"))
    # The last join sorts by ``a``, so a text with many partners is cut up once.
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right")
    return written(joined.mapInArrow(_verify, "a long, b long, similarity double"), "verified")


def bags(rows: DataFrame) -> DataFrame:
    """``id, bag`` of the columns ``id`` and ``text`` (bytes): sorted hashes, then counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in slices(batch.column(1), 1 << 20):
                doc, h, weight = shingles(data, offsets)
                at = np.searchsorted(doc, np.arange(end - row + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), pa.array(
                        [h[x:y].tobytes() + weight[x:y].astype(np.uint32).tobytes()
                         for x, y in zip(at, at[1:])], pa.binary())], names=["id", "bag"])

    return rows.select("id", "text").mapInArrow(run, "id long, bag binary")


def _opened(bag: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(bag) // 12
    return np.frombuffer(bag, np.uint64, n), np.frombuffer(bag, np.uint32, n, 8 * n).astype(np.int64)


class _Groups:
    """Groups of places that links have joined; a group's name is a place of it."""

    def __init__(self, component: np.ndarray):
        _, first, group = np.unique(component, return_index=True, return_inverse=True)
        self.above = first[group]

    def name(self, place: int) -> int:
        while self.above[place] != place:
            self.above[place] = place = self.above[self.above[place]]
        return place

    def join(self, x: int, y: int) -> None:
        self.above[max(x, y)] = min(x, y)

    def names(self) -> np.ndarray:
        while (self.above != self.above[self.above]).any():
            self.above = self.above[self.above]
        return self.above


class _Block:
    """Members of a block, or of two, with the likely pairs of those that are apart.

    Blocks are ids, components, sketches, bands and bags.  A pair that meets in several
    buckets is looked at in that of its first common band.
    """

    def __init__(self, bucket: int, left: list, right: list | None):
        self.bucket, self.inside, self.n = bucket, right is None, len(left[0])
        self.left, self.right = left, left if right is None else right
        whole = [left] if right is None else [left, right]
        self.ids = np.concatenate([side[0] for side in whole])
        self.bags = sum((side[4] for side in whole), [])
        self.groups = _Groups(np.concatenate([side[1] for side in whole]))

    def likely(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Places of two members and the registers in which they agree, part by part."""
        (_, _, sketch, bands_, _), (_, _, sketch_2, bands_2, _) = self.left, self.right
        shift = 0 if self.inside else self.n
        step = max(1, (8 << 20) // max(sketch_2.size, 1))
        for low in range(0, self.n, step):
            part = slice(low, min(low + step, self.n))
            agree = (sketch[part, None] == sketch_2).sum(2, dtype=np.int16)
            names = self.groups.names()
            agree[names[part][:, None] == names[shift:shift + len(sketch_2)]] = 0
            row, other = np.nonzero(agree >= LIKELY * sketch.shape[1])
            if self.inside:
                row, other = row[low + row < other], other[low + row < other]
            if not len(row):
                continue
            own = bands_[part][row]
            first = own[np.arange(len(row)), (own == bands_2[other]).argmax(1)] == self.bucket
            row, other = row[first], other[first]
            yield low + row, shift + other, agree[row, other]

    def active(self) -> np.ndarray:
        """Places of members that have a likely partner."""
        found = np.zeros(len(self.ids), bool)
        for x, y, _ in self.likely():
            found[x] = found[y] = True
        return np.flatnonzero(found)

    def links(self) -> list[tuple[int, int, float]]:
        """Links ``a, b, similarity`` that join what is apart, likeliest pairs first."""
        opened, found = {}, []

        def look(place: int) -> tuple[np.ndarray, np.ndarray]:
            if place not in opened:
                opened[place] = _opened(self.bags[place])
            return opened[place]

        for x, y, agree in self.likely():
            for k in np.argsort(-agree, kind="stable").tolist():
                gx, gy = self.groups.name(int(x[k])), self.groups.name(int(y[k]))
                if gx == gy:
                    continue
                s = overlap(look(int(x[k])), look(int(y[k])))
                if s >= SIMILARITY:
                    self.groups.join(gx, gy)
                    a, b = self.ids[x[k]], self.ids[y[k]]
                    found.append((min(a, b), max(a, b), s))
        return found


def _dealt(placed: DataFrame) -> DataFrame:
    """``bucket, i, j, side, id, component``: blocks ``i`` and ``j`` of buckets with several groups.

    ``placed`` has ``bucket, id, component, weight``.  ``side`` is 1 for a member of block
    ``j`` where that is another block than ``i``.  A component that weighs ``BLOCK`` or
    more has blocks of its own, which are not compared with each other; others share
    blocks.
    """
    parts = placed.groupBy("bucket", "component").agg(F.sum("weight").alias("n"))
    large = F.col("n") >= BLOCK
    sizes = parts.groupBy("bucket").agg(
        F.count("*").alias("groups"),
        F.ceil(F.sum(F.when(large, 0).otherwise(F.col("n"))) / BLOCK).alias("shared"),
        F.sum(F.when(large, F.ceil(F.col("n") / BLOCK)).otherwise(0)).alias("owned"))
    sizes = sizes.where("groups > 1")
    before = Window.partitionBy("bucket").orderBy("component").rowsBetween(
        Window.unboundedPreceding, -1)
    owned = (parts.where(large).withColumn("many", F.ceil(F.col("n") / BLOCK))
             .withColumn("start", F.coalesce(F.sum("many").over(before), F.lit(0)))
             .select("bucket", "component", "many", "start"))
    known = placed.join(sizes, "bucket").join(owned, ["bucket", "component"], "left")
    # Blocks are numbered from 0: those that small components share, then the large ones' own.
    salt = F.xxhash64("id")
    start = F.col("shared") + F.col("start")
    own = F.when(F.col("many").isNull(), F.pmod(salt, "shared")).otherwise(
        start + F.pmod(salt, "many"))
    met = known.select(
        "bucket", "id", "component", own.alias("own"), start.alias("start"),
        (start + F.col("many")).alias("end"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("shared") + F.col("owned") - 1)).alias("other"))
    met = met.where("start is null or other < start or other >= end")
    return met.select("bucket", F.least("own", "other").alias("i"),
                      F.greatest("own", "other").alias("j"),
                      (F.col("own") > F.col("other")).cast("long").alias("side"), "id", "component")


def _map_blocks(rows: DataFrame, work, schema: str) -> DataFrame:
    """``work(block, key, sides)`` over ``bucket, i, j, side, id, component, sketch, bands, bag``.

    Blocks stream through the tasks, one or a pair of them at a time.  ``work`` gives
    columns in the order of ``schema``; ``sides`` are the sides of the members.
    """
    names = [part.split()[0] for part in schema.split(", ")]

    def members(rows: list) -> list:
        return [np.array([r[k] for r in rows], np.int64) for k in (1, 2)] + [
            np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(-1, REGISTERS),
            np.array([r[4] for r in rows], np.int64).reshape(-1, BANDS), [r[5] for r in rows]]

    def made(key: tuple, held: list) -> pa.RecordBatch | None:
        sides = [[r for r in held if r[0] == side] for side in (0, 1)]
        both = key[1] != key[2]
        if not sides[0] or both and not sides[1]:
            return None
        block = _Block(key[0], members(sides[0]), members(sides[1]) if both else None)
        return pa.RecordBatch.from_arrays(
            work(block, key, np.repeat([0, 1], [len(s) for s in sides])), names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                for row in zip(*(c.to_pylist() for c in batch.slice(k, 500).columns)):
                    if row[:3] != at:
                        found = made(at, held) if held else None
                        if found is not None:
                            yield found
                        held, at = [], row[:3]
                    held.append(row[3:])
        found = made(at, held) if held else None
        if found is not None:
            yield found

    keys = ["bucket", "i", "j"]
    rows = rows.select(*keys, "side", "id", "component", "sketch", "bands", "bag")
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def _active(dealt: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of ``dealt`` that have a likely partner in their block; only sketches are moved."""
    def work(block: _Block, key: tuple, sides: np.ndarray) -> list[pa.Array]:
        at = block.active()
        names = np.concatenate([block.left[1], block.right[1]])[at]
        return [pa.array(np.full(len(at), k, np.int64)) for k in key] + [
            pa.array(sides[at]), pa.array(block.ids[at]), pa.array(names)]

    rows = dealt.join(kept, "id").withColumn("bag", F.lit(b""))
    return _map_blocks(rows, work,
                       "bucket long, i long, j long, side long, id long, component long").distinct()


def _links_of_blocks(rows: DataFrame) -> DataFrame:
    """Links of all blocks of ``bucket, i, j, side, id, component, sketch, bands, bag``."""
    def work(block: _Block, key: tuple, sides: np.ndarray) -> list[pa.Array]:
        a, b, s = zip(*found) if (found := block.links()) else ([], [], [])
        return [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s, pa.float64())]

    return _map_blocks(rows, work, "a long, b long, similarity double")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, class_id, copy_id``: one row for each row of ``docs`` with an id.

    ``class_id`` is the smallest id among linked documents, ``copy_id`` the smallest
    among those with an equal multiset of shingles.
    """
    rows = docs.where(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).cast("long").alias("id"), utf8(text).alias("text"))
    signs = written(signed(rows), "signatures")
    copies = (signs.where("n > 0").groupBy("k1", "k2", "n")
              .agg(F.min("id").alias("copy_id"), F.min_by("bands", "id").alias("bands"),
                   F.min_by("sketch", "id").alias("sketch")))
    copies = written(copies, "copies")
    placed = copies.select(F.col("copy_id").alias("id"), F.explode("bands").alias("bucket"))
    led = placed.groupBy("bucket").agg(F.min("id").alias("lead"), F.max("id").alias("last"))
    led = led.where("lead < last").select("bucket", "lead")
    members = written(placed.join(led, "bucket"), "members")
    stars = written(members.where("id <> lead").groupBy(F.col("id").alias("b"))
                    .agg(F.min("lead").alias("a")).select("a", "b"), "stars")
    links = verified(stars, rows)
    groups = written(components(links), "groups")
    weight = F.col("n") * 12 + 8 * BANDS + REGISTERS
    kept = copies.select(F.col("copy_id").alias("id"), weight.alias("weight"), "sketch", "bands")
    grouped = members.select("bucket", "id").join(groups.withColumnRenamed("node", "id"), "id", "left")
    placed = grouped.join(kept.select("id", "weight"), "id").select(
        "bucket", "id", F.coalesce("component", "id").alias("component"), "weight")
    kept = kept.select("id", "sketch", "bands")
    dealt = written(_dealt(placed), "blocks")
    active = written(_active(dealt, sifted(kept, dealt.select("id"))), "active")
    ids = active.select("id").distinct()
    needed = sifted(rows, ids).join(ids, "id", "left_semi")
    # All by id, so bags are moved to it once; an id with several texts has each of them.
    full = active.join(bags(needed), "id").join(sifted(kept, ids), "id").dropDuplicates(
        ["bucket", "i", "j", "side", "id", "bag", "sketch"])
    links = links.union(written(_links_of_blocks(full), "block-links"))
    groups = written(components(links), "groups")

    by_copy = copies.join(groups.withColumnRenamed("node", "copy_id"), "copy_id", "left").select(
        "k1", "k2", "n", "copy_id", F.coalesce("component", "copy_id").alias("class_id"))
    return signs.select("id", "k1", "k2", "n").join(by_copy, ["k1", "k2", "n"], "left").select(
        F.col("id").alias(doc_id), F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("copy_id", "id").alias("copy_id"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The row of the smallest id of every class; of rows of one id the first text.

    Rows with a NULL id all stay.
    """
    # An id with several texts stays if one of them leads a class.
    chosen = written(classes(docs, doc_id, text).where(F.col(doc_id) == F.col("class_id"))
                     .select(F.col(doc_id).alias("id")).distinct(), "chosen")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("in"),
                       F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    first = Window.partitionBy("id").orderBy(F.col("text").asc_nulls_first())
    kept = rows.join(chosen, "id").withColumn("number", F.row_number().over(first)).where("number = 1")
    return kept.select("in.*").union(docs.where(F.col(f"`{doc_id}`").isNull()))
