"""BPE encoding and decoding with a queue of merge ranks over linked symbols.

A piece of text starts as a doubly linked list of symbols.  A priority queue
holds the rank and place of every adjacent pair that has a merge; the lowest
rank (leftmost first) is taken, entries whose symbols have changed since are
skipped, and the two new neighbour pairs are queued.  Decoding concatenates
vocabulary strings, with a blank between tokens where the file names no decoder.

Normalising and cutting into pieces follow the tokenizer file, by the public
library's own components.  Where the cutting drops white space, texts are first
split on it and equal chunks of a slice are encoded once.  A worker remembers the ids of
pieces in two generations of about ``MEMO_BYTES`` each, which only saves time.

NULL is the empty text: no token, and the digests of nothing.  Repeated rows give
repeated rows; other columns are passed through only by :func:`with_tokens`.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from itertools import chain
from sys import getsizeof

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palaver.llm.common import SPACED, slices, utf8

MEMO_BYTES = 40 << 20
BLOCK_BYTES = 4 << 20
MARKS = tuple("!#$%&*,.:;?")
PLAIN_CHUNK = re.compile(b"([A-Za-z]+)([!#$%&*,.:;?]*)")
OUTPUTS = {
    "n_tokens": T.LongType(), "ids": T.ArrayType(T.IntegerType()), "decoded": T.StringType(),
    "ids_sha256": T.StringType(), "decoded_sha256": T.StringType(),
}
#: What a dict needs for an entry besides key and value.
ENTRY_BYTES = 104
_loaded: dict[str, "Bpe"] = {}


class _Memo(dict):
    """A dict that computes what it lacks and forgets what was not asked for lately.

    When its entries weigh ``limit`` bytes they become the older generation, of
    which those that are asked for again come back.
    """

    def __init__(self, compute, limit: int = MEMO_BYTES):
        super().__init__()
        self.compute, self.limit, self.weight = compute, limit, 0
        self.older: dict = {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        self.weight += getsizeof(key) + getsizeof(value) + ENTRY_BYTES
        if self.weight > self.limit:
            self.older, self.weight = dict(self), 0
            self.clear()
        self[key] = value
        return value


class Bpe:
    """Merges and vocabulary of one tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or spec.get("decoder"):
            raise ValueError("a BPE file without a decoder is expected")
        if model.get("byte_fallback") or model.get("continuing_subword_prefix"):
            raise ValueError("byte fallback and subword prefixes are not supported")
        library = Tokenizer.from_file(path)
        self.normalizer, self.cutter = library.normalizer, library.pre_tokenizer
        self.suffix = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.unknown = self.vocab.get(model.get("unk_token"))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        longest = sorted(self.special, key=len, reverse=True)
        self.at_special = re.compile("(" + "|".join(map(re.escape, longest)) + ")")
        self.strings = {i: s.encode() for s, i in {**self.vocab, **self.special}.items()}
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b = self.vocab[left], self.vocab[right]
            self.merges[a << 32 | b] = rank, self.vocab[left + right]
        self.by_chunk = self._pieces("a b") == self._pieces("a") + self._pieces("b")
        #: chunks of letters and closing marks need no library call if it folds them so
        self.plain = all(self._pieces(f"Ab{m}") == ["ab", m] for m in MARKS + ("!!", ".,"))
        self.pieces = _Memo(self._encode_piece)
        #: strings of all ids, each before a blank, and where they begin
        words = [self.strings.get(i, b"") + b" " for i in range(max(self.strings) + 1)]
        self.spelled = pa.array(words, pa.large_binary())

    def _pieces(self, text: str) -> list[str]:
        if self.normalizer:
            text = self.normalizer.normalize_str(text)
        return [p for p, _ in self.cutter.pre_tokenize_str(text)] if self.cutter else [text]

    def _encode_piece(self, piece: str) -> tuple[int, ...]:
        whole = self.vocab.get(piece + self.suffix)
        if len(piece) == 1 and whole is not None:
            return (whole,)
        found = [self.vocab.get(c, self.unknown) for c in piece]
        if piece:
            found[-1] = self.vocab.get(piece[-1] + self.suffix, self.unknown)
        return tuple(self.merge([s for s in found if s is not None]))

    def merge(self, symbols: list[int]) -> list[int]:
        """Apply the merges to a list of symbol ids."""
        n = len(symbols)
        if n < 2:
            return symbols
        merges = self.merges
        heap = []
        for i in range(n - 1):
            known = merges.get(symbols[i] << 32 | symbols[i + 1])
            if known:
                heap.append(known[0] << 32 | i)
        heapq.heapify(heap)
        following = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        while heap:
            entry = heapq.heappop(heap)
            i = entry & 0xFFFFFFFF
            left = symbols[i]
            j = following[i]
            if left < 0 or j >= n:
                continue
            known = merges.get(left << 32 | symbols[j])
            if known is None or known[0] != entry >> 32:
                continue
            made = symbols[i] = known[1]
            symbols[j] = -1
            k = following[i] = following[j]
            if k < n:
                before[k] = i
                known = merges.get(made << 32 | symbols[k])
                if known:
                    heapq.heappush(heap, known[0] << 32 | i)
            h = before[i]
            if h >= 0:
                known = merges.get(symbols[h] << 32 | made)
                if known:
                    heapq.heappush(heap, known[0] << 32 | h)
        return [s for s in symbols if s >= 0]

    def _ids(self, text: str) -> list[int]:
        ids: list[int] = []
        for part in self.at_special.split(text) if self.special else [text]:
            if part in self.special:
                ids.append(self.special[part])
            elif part:
                for piece in self._pieces(part):
                    ids += self.pieces[piece]
        return ids

    def decode(self, ids: Iterable[int]) -> bytes:
        """Vocabulary strings of ``ids``, a blank between them."""
        return b" ".join(map(self.strings.__getitem__, ids))

    def _encode_chunk(self, chunk: bytes) -> tuple[int, ...] | list[int]:
        plain = self.plain and PLAIN_CHUNK.fullmatch(chunk)
        if plain:
            ids = self.pieces[plain[1].lower().decode()]
            return ids + self.pieces[plain[2].decode()] if plain[2] else ids
        return self._ids(chunk.decode("utf-8", "replace"))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a slice of texts, one after the other, and where those of each begin and end."""
        if not self.by_chunk:
            lists = [self._encode_chunk(data[x:y].tobytes()) for x, y in zip(offsets, offsets[1:])]
            return (np.fromiter(chain.from_iterable(lists), "<u4"),
                    np.concatenate([[0], np.cumsum([len(i) for i in lists], dtype=np.int64)]))
        inside = SPACED[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        borders = offsets[:-1][offsets[:-1] < len(data)]
        first[borders] = inside[borders]
        starts = np.flatnonzero(first)
        # Chunks follow each other once the white space is gone.
        places = np.concatenate([[0], np.cumsum(inside)])
        cuts = np.append(places[starts], places[-1]).astype(np.int64)
        chunks = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(data[inside])])
        coded = chunks.dictionary_encode()
        lists = [self._encode_chunk(c) for c in coded.dictionary.to_pylist()]
        sizes = np.array([len(i) for i in lists], np.int64)
        flat = np.fromiter(chain.from_iterable(lists), "<u4", int(sizes.sum()))
        code = coded.indices.to_numpy()
        from_, size = (np.cumsum(sizes) - sizes)[code], sizes[code]
        end = np.cumsum(size)
        ids = flat[np.repeat(from_ - (end - size), size) + np.arange(end[-1] if len(end) else 0)]
        return ids, np.concatenate([[0], end])[np.searchsorted(starts, offsets)]

    def spell(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Vocabulary strings of all ids, each before a blank, and where each begins."""
        found = self.spelled.take(pa.array(ids.astype(np.int64)))
        if not len(found):
            return b"", np.zeros(1, np.int64)
        return memoryview(found.buffers()[2]), np.frombuffer(found.buffers()[1], np.int64)[:len(found) + 1]


def load(path: str) -> Bpe:
    """The file's merges, loaded once per worker."""
    if path not in _loaded:
        _loaded[path] = Bpe(path)
    return _loaded[path]


def _values(name: str, ids: np.ndarray, at: np.ndarray, spelled: tuple) -> pa.Array:
    """A column for texts whose ids lie between places ``at``."""
    if name == "n_tokens":
        return pa.array(np.diff(at))
    if name == "ids":
        return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32)))
    if name == "ids_sha256":
        data, borders = memoryview(ids.astype("<u4")).cast("B") if len(ids) else b"", 4 * at
        ends = borders[1:]
    else:
        data, place = spelled
        borders = place[at]
        # No blank after the last token of a text.
        ends = np.maximum(borders[1:] - 1, borders[:-1])
    parts = (data[x:y] for x, y in zip(borders[:-1].tolist(), ends.tolist()))
    if name == "decoded":
        return pa.array([bytes(p).decode() for p in parts], pa.string())
    return pa.array([hashlib.sha256(p).hexdigest() for p in parts], pa.string())


def with_tokens(docs: DataFrame, path: str, text: str = "text",
                outputs: tuple[str, ...] = ("n_tokens", "ids", "decoded"),
                keep: tuple[str, ...] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) with those of ``OUTPUTS`` that are asked for.

    A column of ``docs`` with the name of an output is replaced by it.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in outputs]
    schema = T.StructType([docs.schema[c] for c in keep]
                          + [T.StructField(o, OUTPUTS[o]) for o in outputs])
    spells = {"decoded", "decoded_sha256"} & set(outputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            for row, end, data, offsets in slices(batch.column(len(keep)), BLOCK_BYTES):
                ids, at = bpe.encode(data, offsets)
                spelled = bpe.spell(ids) if spells else None
                made = [_values(o, ids, at, spelled) for o in outputs]
                rest = [c.slice(row, end - row) for c in batch.columns[:len(keep)]]
                yield pa.RecordBatch.from_arrays(rest + made, names=schema.names)

    rows = docs.select(*(F.col(f"`{c}`") for c in keep), utf8(text).alias("__bytes"))
    return rows.mapInArrow(run, schema)
