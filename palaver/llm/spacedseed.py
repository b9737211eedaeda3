"""Benchmark decontamination with spaced seeds.

A seed hashes some token places of a window and ignores the others, by fixed
masks, so a substituted token between the places does no harm.  Seeds of all
benchmark items set bits of a filter of ``FILTER_BITS`` bits (its size does not
depend on any table); training seeds that find no bit are dropped where they
arise, the others are joined with the benchmark's seeds.  A hit puts an item
beside a text at one shift.  There the tokens are compared one by one: the
longest stretch of which ``min_share`` agree is the overlap, and it counts as a
leak if it has at least ``min_tokens`` tokens.  A stretch goes from one agreeing
token to another, so a shorter passage is not filled up with its surroundings.

Tokens are lower-cased runs of letters and digits.  Items of fewer tokens than
the shortest mask have no seed and leak nothing.  NULL and empty texts have no
token.  Rows are told apart by the id: repeated ids give one row each for the
pairs, and texts of one id are searched separately.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.common import ALNUM, LOWER, ODD, Words, mix, slices, utf8, written

#: Places that a seed reads.  Every stretch of at least ``MIN_TOKENS`` tokens of which ``MIN_SHARE``
#: agree keeps one of them whole: of 26 tokens or more, a half is such a stretch, and the lengths
#: from 13 to 25 were gone through.  Lower limits than these two have no such guarantee.
MASKS = ((0, 1, 2, 3, 4, 5), (0, 1, 2, 4, 6, 7, 8), (0, 1, 3, 4, 7, 9, 10), (0, 2, 3, 5, 8, 9, 11),
         (0, 1, 5, 6, 8, 9, 10), (0, 1, 4, 6, 9, 11, 12))
FILTER_BITS = 1 << 23
MIN_TOKENS = 13
MIN_SHARE = 0.8


def seeds(words: Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Mask number, first tokens and hashes of all seeds of a slice."""
    total = len(words.hashes)
    for number, mask in enumerate(MASKS):
        size = total - mask[-1]
        if size <= 0:
            continue
        at = np.flatnonzero(words.doc[:size] == words.doc[mask[-1]:])
        h = np.full(size, number + 1, np.uint64)
        for place in mask:
            h *= ODD
            h += words.hashes[place:place + size]
        yield number, at, mix(h[at])


def seed_rows(rows: DataFrame, bits: np.ndarray | None = None) -> DataFrame:
    """``id, seed, place`` of the column ``id`` and the bytes ``text``.

    With ``bits``, only seeds whose bit is set.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for row, _, data, offsets in slices(batch.column(1)):
                words = Words(data, offsets, ALNUM, LOWER)
                for _, at, h in seeds(words):
                    if bits is not None:
                        bit = h & np.uint64(FILTER_BITS - 1)
                        set_ = bits[(bit >> np.uint64(3)).astype(np.int64)] >> (
                            bit & np.uint64(7)).astype(np.uint8) & 1
                        at, h = at[set_ > 0], h[set_ > 0]
                    doc = words.doc[at]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[row + doc], pa.int64()), pa.array(h.view(np.int64)),
                         pa.array((at - words.bounds[doc]).astype(np.int32))],
                        names=["id", "seed", "place"])

    return rows.select("id", "text").mapInArrow(run, "id long, seed long, place int")


def filter_bits(seeds_of_items: DataFrame) -> np.ndarray:
    """The filter's bytes: one row per byte that is not 0, at most ``FILTER_BITS / 8``."""
    bit = F.pmod("seed", F.lit(FILTER_BITS))
    parts = (seeds_of_items.groupBy(F.shiftright(bit, 3).alias("byte"))
             .agg(F.bit_or(F.expr("shiftleft(1, cast(pmod(seed, 8) as int))")).alias("bits")))
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for part in parts.toLocalIterator():
        out[part.byte] = part.bits
    return out


def longest_stretch(same: np.ndarray, min_share: float) -> tuple[int, int, int]:
    """Start, end and matches of the longest stretch between matches with ``min_share`` of them.

    Of equally long ones, the first with most matches.
    """
    ends = np.flatnonzero(same) + 1
    if not len(ends):
        return 0, 0, 0
    share = Fraction(min_share).limit_denominator(10 ** 6)
    matches = np.concatenate(([0], np.cumsum(same, dtype=np.int64)))
    running = share.denominator * matches - share.numerator * np.arange(len(matches))
    # The first start of an end is where the least sum so far is not above the end's.
    least = np.minimum.accumulate(np.where(same, running[:-1], np.iinfo(np.int64).max))
    starts = np.searchsorted(-least, -running[ends])
    size = ends - starts
    longest = np.flatnonzero(size == size.max())
    k = longest[(matches[ends[longest]] - matches[starts[longest]]).argmax()]
    return int(starts[k]), int(ends[k]), int(matches[ends[k]] - matches[starts[k]])


def _tokens(text: bytes) -> np.ndarray:
    return Words(np.frombuffer(text, np.uint8), np.array([0, len(text)]), ALNUM, LOWER).hashes


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id",
          text: str = "text", min_tokens: int = MIN_TOKENS, min_share: float = MIN_SHARE
          ) -> DataFrame:
    """Pairs ``(doc_id, item_id)`` with the longest overlap.

    ``place`` is the overlap's first token in the document, ``item_place`` in the
    item; ``overlap`` and ``matches`` count its tokens and those that agree.  Ids
    are integers; rows with a NULL id are left out.
    """
    rows = docs.where(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).cast("long").alias("id"), utf8(text).alias("text"))
    wanted = items.where(F.col(item_id).isNotNull()).select(
        F.col(item_id).cast("long").alias("id"), utf8(text).alias("text"))
    known = written(seed_rows(wanted).distinct(), "benchmark-seeds")
    bits = filter_bits(known)
    hits = written(
        seed_rows(rows, bits)
        .join(known.select(F.col("id").alias("item"), "seed", F.col("place").alias("at")), "seed")
        .select("id", "item", (F.col("place") - F.col("at")).alias("shift")).distinct(),
        "benchmark-hits")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            last_text, last_tokens, seen = None, None, {}
            for id_, item, shifts, doc_text, item_text in zip(*(c.to_pylist() for c in batch)):
                if doc_text != last_text:
                    last_text, last_tokens = doc_text, _tokens(doc_text)
                if item_text not in seen:
                    if len(seen) >= 1000:
                        seen = {}
                    seen[item_text] = _tokens(item_text)
                item_tokens = seen[item_text]
                best = None
                for shift in shifts:
                    low, high = max(0, -shift), min(len(item_tokens), len(last_tokens) - shift)
                    if high <= low:
                        continue
                    same = last_tokens[low + shift:high + shift] == item_tokens[low:high]
                    start, end, matches = longest_stretch(same, min_share)
                    if end - start >= min_tokens:
                        best = max(best or (0,), (end - start, matches, -(low + start + shift),
                                                  low + start))
                if best:
                    found.append((id_, item, -best[2], best[3], best[0], best[1]))
            columns = list(zip(*found)) if found else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                             names=LEAK.replace(" long", "").split(", "))

    by_pair = (hits.groupBy("id", "item").agg(F.array_sort(F.collect_list("shift")).alias("shifts"))
               .join(rows.withColumnRenamed("text", "doc_text"), "id")
               .join(wanted.select(F.col("id").alias("item"), F.col("text").alias("item_text")),
                     "item")
               .select("id", "item", "shifts", "doc_text", "item_text"))
    order = F.struct("overlap", "matches", -F.col("place"))
    pairs = (by_pair.mapInArrow(verify, LEAK).groupBy("id", "item")
             .agg(F.max_by(F.struct("place", "item_place", "overlap", "matches"), order)
                  .alias("best")))
    return pairs.select(F.col("id").alias(doc_id), F.col("item").alias(item_id), "best.*")


LEAK = "id long, item long, place long, item_place long, overlap long, matches long"


def clean(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` without a leak; rows with a NULL id stay."""
    dirty = written(leaks(docs, items, doc_id, **options).select(doc_id).distinct(), "dirty")
    return docs.join(dirty, doc_id, "left_anti").select(docs.columns)
