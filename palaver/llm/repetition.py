"""Quality rules with a suffix array of each text's words.

Words are what ASCII white space parts.  Suffixes (by words) of a text that share
their first ``MIN_REPEAT`` words with another suffix of it are sorted by prefix
doubling; neighbours in that order give the longest common prefixes.  Every
longest-common-prefix interval of at least that depth is a maximal repeat, and
the longest one starting at a word is the larger of the two neighbours' prefixes.
The union of the repeats' spans gives the covered fraction of a text's characters.

A text is kept if it passes the base rules (at least ``min_words`` words, at most
``max_repeat_percent`` of the words in repeated 5-word windows), at most
``max_covered`` of its characters lie in repeats, and no repeat is longer than
``max_longest`` words.  NULL is the empty text, which fails.  Repeated rows are
judged alike, each by itself; other columns are passed through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from palaver.llm.common import Words, byte_class, grams, map_slices

MIN_REPEAT = 5
SYMBOLS = b"#*$%&|<>"
FIELDS = [T.StructField(n, t) for n, t in (
    ("n_words", T.LongType()), ("word_chars", T.LongType()), ("n_symbols", T.LongType()),
    ("n_dup_lines", T.LongType()), ("n_repeat_words", T.LongType()),
    ("longest_repeat", T.LongType()), ("covered", T.DoubleType()),
    ("base_failed", T.BooleanType()), ("kept", T.BooleanType()))]
_LINES = byte_class(b"\n")
_SYMBOL = ~byte_class(SYMBOLS)


@dataclass(frozen=True)
class Limits:
    """What a text may be like."""

    min_words: int = 10
    max_repeat_percent: int = 20
    max_covered: float = 0.3
    max_longest: int = 100


def repeat_lengths(words: Words, depth: int = MIN_REPEAT) -> tuple[np.ndarray, np.ndarray]:
    """Word places where a repeat of ``depth`` words or more starts, and its length."""
    at, h = grams(words, depth)
    order = np.lexsort((h, words.doc[at]))
    at, h = at[order], h[order]
    doc = words.doc[at]
    new = np.ones(len(at), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    group = np.cumsum(new) - 1
    shared = np.bincount(group, minlength=1)[group] > 1
    suffixes, rank = at[shared], group[shared]
    if not len(suffixes):
        return suffixes, suffixes
    total = len(words.hashes)
    levels = []
    step, open_groups = depth, True
    while open_groups:
        known = np.full(total + 1, -1)
        known[suffixes] = rank
        levels.append((step, known))
        after = known[np.minimum(suffixes + step, total)]
        after[words.doc[suffixes] != words.doc[np.minimum(suffixes + step, total - 1)]] = -1
        # Suffixes without a shared continuation part here, within less than ``depth`` words.
        order = np.lexsort((*_next_words(words, suffixes, step, after < 0, depth), after, rank))
        suffixes, rank, after = suffixes[order], rank[order], after[order]
        new = np.ones(len(suffixes), bool)
        new[1:] = (rank[1:] != rank[:-1]) | (after[1:] != after[:-1]) | (after[1:] < 0)
        rank = np.cumsum(new) - 1
        open_groups = rank[-1] + 1 < len(rank)
        step *= 2
    lcp = common_prefix(words, levels, suffixes[:-1], suffixes[1:])
    longest = np.zeros(len(suffixes), np.int64)
    longest[:-1] = lcp
    np.maximum(longest[1:], lcp, out=longest[1:])
    return suffixes, longest


def _next_words(words: Words, suffixes: np.ndarray, step: int, wanted: np.ndarray, depth: int
                ) -> list[np.ndarray]:
    """Sort keys: the ``depth - 1`` words from ``step`` on, last first; 0 beyond the text."""
    at, end = suffixes + step, words.bounds[1:][words.doc[suffixes]]
    keys = []
    for k in reversed(range(depth - 1)):
        inside = wanted & (at + k < end)
        keys.append(np.where(inside, words.hashes[np.where(inside, at + k, 0)], np.uint64(0)))
    return keys


def common_prefix(words: Words, levels: list[tuple[int, np.ndarray]], left: np.ndarray,
                  right: np.ndarray) -> np.ndarray:
    """Words that the suffixes at ``left`` and ``right`` share, by descending levels."""
    total = len(words.hashes)
    same_doc = words.doc[left] == words.doc[right]
    shared = np.zeros(len(left), np.int64)
    for step, known in reversed(levels):
        a = known[np.minimum(left + shared, total)]
        b = known[np.minimum(right + shared, total)]
        shared += np.where((a == b) & (a >= 0) & same_doc, step, 0)
    end = words.bounds[1:][words.doc[np.maximum(left, right)]]
    for _ in range(levels[0][0] - 1):
        i, j = left + shared, right + shared
        inside = same_doc & (np.maximum(i, j) < end)
        i, j = np.where(inside, i, 0), np.where(inside, j, 0)
        more = inside & (words.hashes[i] == words.hashes[j])
        if not more.any():
            break
        shared += more
    return shared


def _covered(total: int, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    change = np.zeros(total + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change[:total]) > 0


def _sums(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``mask`` between neighbouring bounds."""
    running = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
    return np.diff(running[bounds])


def measure(data: np.ndarray, offsets: np.ndarray, limits: Limits) -> list[np.ndarray]:
    """The columns ``FIELDS`` of a slice of texts."""
    words, lines = Words(data, offsets), Words(data, offsets, _LINES)
    n_words = words.counts
    points = words.inside & ((data & 0xC0) != 0x80)
    chars = _sums(points, offsets)
    symbols = _sums(_SYMBOL[data], offsets)

    with_word = (np.searchsorted(words.starts, lines.starts)
                 < np.searchsorted(words.starts, lines.ends))
    line_doc, line_hash = lines.doc[with_word], lines.hashes[with_word]
    order = np.lexsort((line_hash, line_doc))
    line_doc, line_hash = line_doc[order], line_hash[order]
    again = (line_doc[1:] == line_doc[:-1]) & (line_hash[1:] == line_hash[:-1])
    dup_lines = np.bincount(line_doc[1:][again], minlength=len(n_words))

    starts, lengths = repeat_lengths(words)
    total = len(words.hashes)
    # Repeats of five words and more cover just the words of repeated 5-word windows.
    hit = _covered(total, starts, lengths)
    repeat_words = _sums(hit, words.bounds)
    longest = np.zeros(len(n_words), np.int64)
    np.maximum.at(longest, words.doc[starts], lengths)
    running = np.concatenate(([0], np.cumsum(points, dtype=np.int64)))
    word_chars = running[words.ends] - running[words.starts]
    covered = _sums(np.where(hit, word_chars, 0), words.bounds) / np.maximum(chars, 1)

    failed = ((n_words < limits.min_words)
              | (100 * repeat_words > limits.max_repeat_percent * n_words))
    kept = ~failed & (covered <= limits.max_covered) & (longest <= limits.max_longest)
    return [n_words, chars, symbols, dup_lines, repeat_words, longest, covered, failed, kept]


def judge(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
          limits: Limits = Limits()) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the measures and verdict of each text."""
    return map_slices(docs, text, docs.columns if keep is None else keep, FIELDS,
                      lambda data, offsets: measure(data, offsets, limits))
