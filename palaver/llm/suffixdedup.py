"""Removal of repeated byte strings with a sparse suffix array over all documents.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier: in a
smaller document, or earlier in the same one.

1. Anchors.  Of the places in every ``LENGTH`` bytes the one whose ``CORE`` bytes have
   the smallest hash is an anchor, so equal strings have their anchor at the same
   place, and one suffix in about forty has to be sorted.  Anchors are dealt by the
   hash of their core.  Occurrences whose whole surroundings (all strings around the
   anchor) equal those of an earlier one are covered at once; cores with one
   surrounding only are done.
2. Suffixes.  The other cores' surroundings are fetched from the texts.  The suffixes
   from each anchor, and the reversed prefixes before it, are sorted per core:
   multikey quicksort by eight bytes at a time to ``SHALLOW`` bytes beyond the core,
   then a blind trie orders each group that still has a common prefix.  Strings that
   begin j bytes before their anchors are equal just if the anchors lie in one
   longest-common-prefix interval of depth LENGTH - j among the suffixes and of depth
   j among the prefixes; all but the earliest of them are covered.
3. Cores with more than ``CHUNK`` surroundings are cut into chunks that are sorted
   apart; what is the earliest string of a chunk is compared across chunks by its
   hash (128 bits).

NULL is the empty text.  NULL ids come before all others; different texts of one id
are ordered by their checksum.  Of equal rows of one id the first stays and the
others are later copies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palaver.llm.common import ODD, mix, slices, utf8, written

LENGTH = 100
CORE = 24
BEFORE = LENGTH - CORE
SPAN = BEFORE + LENGTH
SHALLOW = 16
CHUNK = 1 << 15
HELD_ROWS = 1 << 20
_RANDOM = np.random.default_rng(20240229)
_COEFFICIENTS = _RANDOM.integers(1, 1 << 63, (2, SPAN + 2)).astype(np.uint64) * np.uint64(2) + \
    np.uint64(1)


# ---------------------------------------------------------------- anchors

def core_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``CORE`` = 16 + 8 bytes from each place."""
    h = data.astype(np.uint64)
    h += np.uint64(1)
    parts = []
    for size in (1, 2, 4, 8):
        power = np.uint64(pow(int(ODD), size, 1 << 64))
        h = h[:-size] * power + h[size:]
        if size >= 4:
            parts.append(h)
    eight, sixteen = parts
    sixteen = sixteen[:len(data) - CORE + 1]
    return mix(mix(sixteen.copy()) * ODD + eight[16:16 + len(sixteen)])


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of a slice of texts, and the hashes of their cores."""
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(data) < LENGTH:
        return none
    h = core_hashes(data)
    wide, least, size = BEFORE + 1, h, 1
    while 2 * size <= wide:
        least, size = np.minimum(least[:-size], least[size:]), 2 * size
    least = np.minimum(least[:len(least) - wide + size], least[wide - size:])
    long = np.flatnonzero(np.diff(offsets) >= LENGTH)
    if not len(long):
        return none
    counts = offsets[long + 1] - offsets[long] - LENGTH + 1
    skipped = np.cumsum(counts) - counts
    starts = np.arange(counts.sum()) + np.repeat(offsets[long] - skipped, counts)
    smallest = least[starts]
    # The leftmost smallest hash can only move where another value becomes the smallest
    # or where the place that left had it.
    moved = np.ones(len(starts), bool)
    moved[1:] = ((smallest[1:] != smallest[:-1]) | (starts[1:] != starts[:-1] + 1)
                 | (h[starts[1:] - 1] == smallest[1:]))
    found = np.zeros(len(h), bool)
    for part in np.array_split(starts[moved], moved.sum() // 20_000 + 1):
        found[part + h[part[:, None] + np.arange(wide)].argmin(1)] = True
    at = np.flatnonzero(found)
    return at, h[at]


def surroundings(data: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray
                 ) -> np.ndarray:
    """Bytes ``-BEFORE .. LENGTH`` around places; bytes outside ``low .. high`` are 0."""
    padded = np.concatenate((np.zeros(BEFORE, np.uint8), data, np.zeros(LENGTH, np.uint8)))
    around = padded[at[:, None] + np.arange(SPAN)]
    place = np.arange(-BEFORE, LENGTH)
    around[(place < -low[:, None]) | (place >= high[:, None])] = 0
    return around


def anchor_rows(rows: DataFrame) -> DataFrame:
    """``core, around, id, tie, place, low, high, done`` of every anchor of ``id, tie, text``.

    ``around`` hashes the surroundings, which reach from ``place - low`` to
    ``place + high``.  Anchors whose surroundings stand earlier in the same text are
    done; they get a core of their own, so that periodic texts are dealt evenly.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ties = (c.to_numpy() for c in batch.columns[:2])
            for row, _, data, offsets in slices(batch.column(2)):
                at, h = anchors(data, offsets)
                doc = np.searchsorted(offsets, at, "right") - 1
                low = np.minimum(at - offsets[doc], BEFORE)
                high = np.minimum(offsets[doc + 1] - at, LENGTH)
                around = np.zeros(len(at), np.uint64)
                for k in range(0, len(at), 8192):
                    part = slice(k, k + 8192)
                    around[part] = _digest(surroundings(data, at[part], low[part], high[part]),
                                           low[part], high[part], 0)
                order = np.lexsort((at, around, h, doc))
                done = np.zeros(len(at), bool)
                done[order[1:]] = np.all(
                    [v[order[1:]] == v[order[:-1]] for v in (doc, h, around)], axis=0)
                h = np.where(done, mix(h + at.astype(np.uint64) * ODD), h)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(around.view(np.int64)),
                     pa.array(ids[row + doc]), pa.array(ties[row + doc]),
                     pa.array((at - offsets[doc]).astype(np.int32)),
                     pa.array(low.astype(np.int16)), pa.array(high.astype(np.int16)),
                     pa.array(done)],
                    names=["core", "around", "id", "tie", "place", "low", "high", "done"])

    return rows.select("id", "tie", "text").mapInArrow(run, ANCHOR)


ANCHOR = ("core long, around long, id long, tie long, place int, low short, high short, "
          "done boolean")


def _digest(around: np.ndarray, low: np.ndarray, high: np.ndarray, which: int) -> np.ndarray:
    factors = _COEFFICIENTS[which]
    h = (around.astype(np.uint64) + np.uint64(1)) @ factors[:around.shape[1]]
    return mix(h + low.astype(np.uint64) * factors[-2] + high.astype(np.uint64) * factors[-1])


# ---------------------------------------------------------------- cores

def settle_cores(rows: DataFrame, chunk_size: int = CHUNK, held_rows: int = HELD_ROWS
                 ) -> DataFrame:
    """Anchors that are covered as a whole, and those whose suffixes must be sorted.

    ``rows`` come dealt by core and sorted.  ``chunk`` is -1 for covered ones, else
    the number of their chunk; ``hot`` marks cores of several chunks.  Columns stream
    through; no core is held as a whole.
    """
    names = ["core", "around", "id", "tie", "place", "low", "high", "done"]

    def settle(c: list[np.ndarray], last: tuple | None, hot: bool, number: int):
        core, around, id_, tie, place = c[:5]
        n = len(core)
        same_core, same = np.zeros(n, bool), np.zeros(n, bool)
        same_core[1:] = core[1:] == core[:-1]
        same[1:] = same_core[1:] & (around[1:] == around[:-1])
        again = np.zeros(n, bool)
        again[1:] = (same[1:] & (id_[1:] == id_[:-1]) & (tie[1:] == tie[:-1])
                     & (place[1:] == place[:-1]))
        if last is not None and hot:
            same[0] = around[0] == last[1]
            again[0] = same[0] and (id_[0], tie[0], place[0]) == last[2:]
        group = np.cumsum(~same_core) - 1
        first = ~same
        windows = np.bincount(group, first)
        rank = np.cumsum(first) - 1
        begin = np.flatnonzero(~same_core)
        rank -= (np.cumsum(first) - first)[begin][group]
        if hot:
            rank[group == 0] += number
        many = windows > chunk_size
        if hot:
            many[0] = True
        sort = first & ((windows[group] > 1) | many[group]) & ~c[7]
        cover = (same & ~again) | c[7]
        chunk = np.where(cover, -1, rank // chunk_size)
        pick = np.flatnonzero(sort | cover)
        arrays = [c[0][pick], *(v[pick] for v in c[2:7]), chunk[pick].astype(np.int64),
                  many[group][pick]]
        return arrays, (int(core[-1]), int(around[-1]), id_[-1], tie[-1], place[-1]), int(
            rank[-1]) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, last, hot, number = [], 0, None, False, 0

        def out(arrays):
            return pa.RecordBatch.from_arrays(
                [pa.array(a) for a in arrays],
                names=["core", "id", "tie", "place", "low", "high", "chunk", "hot"])

        for batch in batches:
            held.append([batch.column(n).to_numpy(zero_copy_only=False) for n in names])
            count += batch.num_rows
            if count < held_rows:
                continue
            c = [np.concatenate(v) for v in zip(*held)]
            cut = int(np.flatnonzero(c[0] == c[0][-1])[0])
            if cut == 0:
                # One core fills what may be held: it goes in parts.
                arrays, last, number = settle(c, last, hot, number)
                if not hot:
                    arrays[-1][:] = True
                hot, held, count = True, [], 0
                yield out(arrays)
                continue
            goes_on = hot and last[0] == c[0][0]
            arrays, _, _ = settle([v[:cut] for v in c], last, goes_on, number)
            yield out(arrays)
            held, count, hot, last, number = [[v[cut:] for v in c]], len(c[0]) - cut, False, None, 0
        if count:
            c = [np.concatenate(v) for v in zip(*held)]
            goes_on = hot and last[0] == c[0][0]
            yield out(settle(c, last, goes_on, number)[0])

    return rows.mapInArrow(run, "core long, id long, tie long, place int, low short, high short, "
                           "chunk long, hot boolean")


# ---------------------------------------------------------------- suffixes

class _Trie:
    """Blind trie: nodes know the place where strings part, not what they share."""

    def __init__(self, text: bytes, number: int):
        self.root = [text, [number]]

    @staticmethod
    def _leaf(node):
        while len(node) == 3:
            node = next(iter(node[1].values()))
        return node

    def add(self, text: bytes, number: int) -> None:
        # Go down blindly, then compare once with the leaf that was reached.
        node = self.root
        while len(node) == 3:
            node = node[1].get(text[node[0]]) or self._leaf(node)
        other = node[0]
        if other == text:
            node[1].append(number)
            return
        at = next(i for i, (a, b) in enumerate(zip(other, text)) if a != b)
        parent, node = None, self.root
        while len(node) == 3 and node[0] < at:
            parent, node = node, node[1][text[node[0]]]
        leaf = [text, [number]]
        if len(node) == 3 and node[0] == at:
            node[1][text[at]] = leaf
            return
        split = [at, {other[at]: node, text[at]: leaf}, None]
        if parent is None:
            self.root = split
        else:
            parent[1][text[parent[0]]] = split

    def order(self) -> list[int]:
        """Numbers of the strings in order."""
        found, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if len(node) == 3:
                stack += [node[1][c] for c in sorted(node[1], reverse=True)]
            else:
                found += node[1]
        return found


def multikey_quicksort(words: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Stable order of rows of ``words`` within their groups.

    All segments that are not in order yet are parted at once: by a word of theirs into
    those below, equal and above a pivot, the median of three.  Equal ones go on
    with the next word, the others with the same.
    """
    order = np.argsort(group, kind="stable")
    n, width = words.shape
    new = np.ones(n, bool)
    new[1:] = group[order[1:]] != group[order[:-1]]
    level = np.zeros(n, np.int64)
    while True:
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, n))
        open_ = (sizes > 1) & (level[starts] < width)
        if not open_.any():
            return order
        at = np.flatnonzero(np.repeat(open_, sizes))
        sizes = sizes[open_]
        first = np.cumsum(sizes) - sizes
        members = order[at]
        value = words[members, level[at]]
        low, middle, high = value[first], value[first + sizes // 2], value[first + sizes - 1]
        pivot = np.maximum(np.minimum(low, middle), np.minimum(np.maximum(low, middle), high))
        pivot = np.repeat(pivot, sizes)
        part = (value >= pivot).astype(np.int64) + (value > pivot)
        key = np.repeat(np.arange(len(sizes)) * 3, sizes) + part
        turn = np.argsort(key, kind="stable")
        order[at] = members[turn]
        key = key[turn]
        new[at[1:]] |= key[1:] != key[:-1]
        level[at] += part[turn] == 1


def deep_shallow(group: np.ndarray, strings: np.ndarray, skip: int) -> np.ndarray:
    """Order of equally long strings within groups, all alike in the first ``skip`` bytes."""
    n, width = strings.shape
    shallow = min(SHALLOW, width - skip) // 8 * 8
    words = np.ascontiguousarray(strings[:, skip:skip + shallow]).view(">u8").astype(np.uint64)
    order = multikey_quicksort(words, group)
    tied = np.zeros(n, bool)
    tied[1:] = (group[order[1:]] == group[order[:-1]]) & (
        words[order[1:]] == words[order[:-1]]).all(1)
    deep = skip + shallow
    starts = np.flatnonzero(~tied)
    ends = np.append(starts[1:], n)
    for low, high in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
        members = order[low:high]
        texts = [t.tobytes() for t in strings[members, deep:]]
        trie = _Trie(texts[0], 0)
        for number in range(1, len(texts)):
            trie.add(texts[number], number)
        order[low:high] = members[trie.order()]
    return order


def shared(group: np.ndarray, strings: np.ndarray, lengths: np.ndarray, order: np.ndarray
           ) -> np.ndarray:
    """Longest common prefix of each string in ``order`` with the one before it; -1 for none."""
    out = np.full(len(order), -1)
    a, b = order[:-1], order[1:]
    differ = strings[a] != strings[b]
    first = np.where(differ.any(1), differ.argmax(1), strings.shape[1])
    first = np.minimum(first, np.minimum(lengths[a], lengths[b]))
    out[1:] = np.where(group[a] == group[b], first, -1)
    return out


def repeated_around(group: np.ndarray, rank: np.ndarray, around: np.ndarray, low: np.ndarray,
                    high: np.ndarray, firsts: bool = False):
    """How far the covered bytes reach before and beyond each anchor (0, 0: none).

    ``rank`` orders occurrences.  With ``firsts`` also the (anchor, distance) pairs of
    strings that are the earliest here.
    """
    n = len(group)
    right = around[:, BEFORE:]
    left = around[:, :BEFORE][:, ::-1]
    # Bytes beyond the text are 0; a length ends each comparison there.
    by_right, by_left = deep_shallow(group, right, CORE), deep_shallow(group, left, 0)
    lcp_right = shared(group, right, high, by_right)
    lcp_left = shared(group, left, low, by_left)
    reach = np.zeros((2, n), np.int64)
    early = []
    interval = np.empty((2, n), np.int64)
    for j in range(BEFORE + 1):
        interval[0, by_right] = np.cumsum(lcp_right < LENGTH - j)
        interval[1, by_left] = np.cumsum(lcp_left < j)
        has = np.flatnonzero((low >= j) & (high >= LENGTH - j))
        if not len(has):
            continue
        key = interval[0, has] * (n + 1) + interval[1, has]
        order = np.lexsort((rank[has], key))
        key = key[order]
        later = np.zeros(len(has), bool)
        later[1:] = key[1:] == key[:-1]
        hit = has[order[later]]
        reach[0, hit] = j
        reach[1, hit] = np.maximum(reach[1, hit], LENGTH - j)
        if firsts:
            early.append(np.stack([has[order[~later]], np.full((~later).sum(), j)], 1))
    return reach, np.concatenate(early) if early else np.zeros((0, 2), np.int64)


def windows_of(wanted: DataFrame, rows: DataFrame) -> DataFrame:
    """The surroundings of anchors, cut from the texts."""
    per_text = wanted.groupBy("id", "tie").agg(F.collect_list(
        F.struct("core", "chunk", "hot", "place", "low", "high")).alias("anchors"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                text = np.frombuffer(batch.column(3)[k].as_py(), np.uint8)
                found = batch.column(2)[k].values.flatten()
                place, low, high = (found[i].to_numpy() for i in (3, 4, 5))
                for m in range(0, len(place), 8192):
                    part = slice(m, m + 8192)
                    around = surroundings(text, place[part], low[part], high[part])
                    size = len(around)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found[0].to_numpy()[part]), pa.array(found[1].to_numpy()[part]),
                         found[2].slice(m, 8192),
                         pa.repeat(batch.column(0)[k], size), pa.repeat(batch.column(1)[k], size),
                         pa.array(place[part]), pa.array(low[part]), pa.array(high[part]),
                         pa.array([a.tobytes() for a in around], pa.binary())],
                        names=["core", "chunk", "hot", "id", "tie", "place", "low", "high",
                               "around"])

    texts = rows.select("id", "tie", "text").dropDuplicates(["id", "tie"])
    return per_text.join(texts, ["id", "tie"]).select("id", "tie", "anchors", "text").mapInArrow(
        run, "core long, chunk long, hot boolean, id long, tie long, place int, low short, "
        "high short, around binary")


def sorted_suffixes(windows: DataFrame, chunk_size: int = CHUNK) -> DataFrame:
    """Covered spans ``id, tie, start, stop``, and with ``h1, h2`` the early strings of chunks."""
    def settle(c: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        core, chunk, hot, id_, tie, place, low, high, around = c
        new = np.ones(len(core), bool)
        new[1:] = (core[1:] != core[:-1]) | (chunk[1:] != chunk[:-1])
        group = np.cumsum(new)
        rank = np.empty(len(core), np.int64)
        rank[np.lexsort((place, tie, id_))] = np.arange(len(core))
        low, high, place = low.astype(np.int64), high.astype(np.int64), place.astype(np.int64)
        reach, early = repeated_around(group, rank, around, low, high, bool(hot.any()))
        hit = np.flatnonzero(reach[1])
        none = pa.nulls(len(hit), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(id_[hit]), pa.array(tie[hit]), pa.array(place[hit] - reach[0, hit]),
             pa.array(place[hit] + reach[1, hit]), none, none], names=SPAN_NAMES)
        early = early[hot[early[:, 0]]]
        for part in np.array_split(early, len(early) // 50_000 + 1):
            at, j = part.T
            text = around[at[:, None], (BEFORE - j)[:, None] + np.arange(LENGTH)]
            zero = np.zeros(len(at), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(id_[at]), pa.array(tie[at]), pa.array(place[at] - j),
                 pa.array(place[at] - j + LENGTH),
                 *(pa.array(_digest(text, zero, zero, k).view(np.int64)) for k in (0, 1))],
                names=SPAN_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            c = [col.to_numpy(zero_copy_only=False) for col in batch.columns[:8]]
            c.append(np.frombuffer(b"".join(batch.column(8).to_pylist()), np.uint8
                                   ).reshape(-1, SPAN))
            held.append(c)
            count += len(c[0])
            if count >= 2 * chunk_size:
                c = [np.concatenate(v) for v in zip(*held)]
                last = (c[0] == c[0][-1]) & (c[1] == c[1][-1])
                cut = int(np.flatnonzero(last)[0])
                if cut:
                    yield from settle([v[:cut] for v in c])
                held, count = [[v[cut:] for v in c]], len(c[0]) - cut
        if count:
            yield from settle([np.concatenate(v) for v in zip(*held)])

    dealt = windows.repartition("core", "chunk").sortWithinPartitions("core", "chunk")
    return dealt.mapInArrow(
        run, "id long, tie long, start long, stop long, h1 long, h2 long")


SPAN_NAMES = ["id", "tie", "start", "stop", "h1", "h2"]


# ---------------------------------------------------------------- documents

def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``docs`` with the order key ``id, tie`` and the bytes ``text``."""
    least = F.lit(-(1 << 63))
    body = utf8(text)
    return docs.select(*(F.col(f"`{c}`").alias(f"in_{c}") for c in docs.columns),
                       F.coalesce(F.col(doc_id).cast("long"), least).alias("id"),
                       F.xxhash64(body).alias("tie"), body.alias("text"))


def covered_spans(rows: DataFrame, chunk_size: int = CHUNK, held_rows: int = HELD_ROWS
                  ) -> DataFrame:
    """``id, tie, spans`` (start, stop pairs, unmerged) of texts with covered bytes."""
    dealt = anchor_rows(rows).repartition("core").sortWithinPartitions(
        "core", "around", "id", "tie", "place")
    settled = written(settle_cores(dealt, chunk_size, held_rows), "settled-anchors")
    whole = settled.where("chunk < 0").select(
        "id", "tie", (F.col("place") - F.col("low")).cast("long").alias("start"),
        (F.col("place") + F.col("high")).cast("long").alias("stop"))
    windows = windows_of(settled.where("chunk >= 0"), rows)
    found = written(sorted_suffixes(windows, chunk_size), "suffix-spans")
    place = F.struct("id", "tie", "start")
    early = found.where("h1 is not null")
    first = early.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    across = early.join(first.where("n > 1"), ["h1", "h2"]).where(place > F.col("first"))
    spans = whole.union(found.where("h1 is null").select("id", "tie", "start", "stop")).union(
        across.select("id", "tie", "start", "stop"))
    return spans.groupBy("id", "tie").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def merged(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of overlapping or touching spans."""
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > stops[:-1]
    return starts[new], np.append(stops[:-1][new[1:]], stops[-1:])


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 keep: list[str] | None = None,
                 outputs: tuple[str, ...] = ("kept", "spans", "n_bytes", "n_removed"),
                 **sizes: int) -> DataFrame:
    """Columns ``keep`` (default: all) with what is left of each text.

    Outputs: ``kept`` (bytes), ``kept_text`` (without characters that lost a byte),
    ``spans`` (removed runs), ``n_bytes``, ``n_removed``, ``n_spans``,
    ``kept_sha256``.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in outputs]
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                     T.StructField("stop", T.LongType())]))
    kinds = {"kept": T.BinaryType(), "kept_text": T.StringType(), "spans": span,
             "n_bytes": T.LongType(), "n_removed": T.LongType(), "n_spans": T.LongType(),
             "kept_sha256": T.StringType()}
    arrow = {"kept": pa.binary(), "kept_text": pa.string(), "kept_sha256": pa.string(),
             "spans": pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))}
    schema = T.StructType([docs.schema[c] for c in keep]
                          + [T.StructField(o, kinds[o]) for o in outputs])
    rows = keyed(docs, doc_id, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = len(keep)
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                values = {o: [] for o in outputs}
                for body, copy, spans in zip(part.column(at).to_pylist(),
                                             part.column(at + 1).to_pylist(), part.column(at + 2)):
                    starts, stops = np.zeros((2, 0), np.int64)
                    if copy > 1 and len(body) >= LENGTH:
                        starts, stops = np.array([0]), np.array([len(body)])
                    elif spans.is_valid:
                        starts, stops = merged(*(v.to_numpy() for v in spans.values.flatten()))
                    edges = [0, *np.stack([starts, stops], 1).ravel().tolist(), len(body)]
                    kept = b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2]))
                    made = {"kept": lambda: kept, "n_bytes": lambda: len(body),
                            "kept_text": lambda: kept.decode("utf-8", "ignore"),
                            "n_removed": lambda: len(body) - len(kept),
                            "n_spans": lambda: len(starts),
                            "kept_sha256": lambda: hashlib.sha256(kept).hexdigest(),
                            "spans": lambda: [{"start": a, "stop": b} for a, b in zip(
                                starts.tolist(), stops.tolist())]}
                    for o in outputs:
                        values[o].append(made[o]())
                yield pa.RecordBatch.from_arrays(
                    part.columns[:at] + [pa.array(values[o], arrow.get(o, pa.int64()))
                                         for o in outputs], names=schema.names)

    # A row is a copy only of a row with the same text; texts that are too short to have
    # a repeat need neither a number nor spans, however many there are.
    long = rows.where(F.octet_length("text") >= LENGTH)
    same = Window.partitionBy("id", "tie", F.sha2("text", 256)).orderBy("id", "tie")
    long = long.join(covered_spans(rows, **sizes), ["id", "tie"], "left").withColumn(
        "copy", F.row_number().over(same))
    short = rows.where(F.octet_length("text") < LENGTH).withColumns(
        {"copy": F.lit(1), "spans": F.lit(None).cast(long.schema["spans"].dataType)})
    wanted = [*(f"`in_{c}`" for c in keep), "text", "copy", "spans"]
    return long.select(*wanted).union(short.select(*wanted)).mapInArrow(run, schema)
