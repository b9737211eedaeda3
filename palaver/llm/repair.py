"""Token ids in binary shards, compressed by Re-Pair grammars.

Documents are dealt by ranges of their id and sorted, so that shards, taken in
order, hold all documents in ascending order.  A task encodes its texts by the
tokenizers library and closes a shard at about ``SHARD_IDS`` ids.  Within a shard,
rounds of Re-Pair replace id pairs that occur at least ``MIN_COUNT`` times by new
symbols, the most frequent first where pairs overlap; no pair spans two documents.
A shard stores the rules, the length each rule expands to, the symbols and each
document's extent, which is enough to decode any document or any range of ids by
itself.

File: the length of a JSON header as 8 bytes, the header, then the arrays it names,
little-endian, symbols in ``width`` bytes each.

A NULL text is empty and holds the end id only.  NULL ids sort first; texts of one
id sort by the text.  Files of lost tasks are in no manifest and never read.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palaver.llm.common import LOWER, Words, byte_class, coded, shared_folder, slices, spread, utf8, written

END_ID = 1
SHARD_IDS = 2_000_000
MIN_COUNT = 32
SLOT_BITS = 18
MAX_ROUNDS = 20
MIN_GAIN = 0.02
MEMO = 700_000
#: Closing marks; and the bytes of letters among the first 256 code points, which
#: normalise to one letter each.
MARKS = b"!#$%&*,.:;?"
LETTERS = bytes([*range(65, 91), *range(97, 123), 0xC3,
                 *(b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7))])
_MARK, _LETTER = ~byte_class(MARKS), ~byte_class(LETTERS)


# ---------------------------------------------------------------- tokens

class Encoder:
    """Ids of texts by the tokenizers library, equal chunks encoded once.

    The file must drop white space, so that texts can be split on it.  Chunks of
    letters with closing marks are put together from their parts if the file cuts
    there.  The memo holds two generations of at most ``MEMO`` chunks each and only
    saves time.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        if self._ids("a b") != self._ids("a") + self._ids("b"):
            raise ValueError("the tokenizer file keeps white space")
        with open(path, encoding="utf-8") as f:
            suffix = json.load(f)["model"].get("end_of_word_suffix")
        vocab = self.library.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        if suffix:
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self.plain = suffix and all(
            self._ids(w + m) == self._ids(w.lower()) + self._ids(m)
            for w in ("Ab", "Éaß") for m in (*MARKS.decode(), "!!", ".,"))
        self.memo: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _by_offsets(self, chunks: list[bytes]) -> None:
        for first in range(0, len(chunks), 5000):
            part = [c.decode("utf-8", "replace") for c in chunks[first:first + 5000]]
            found = self.library.encode(" ".join(part), add_special_tokens=False)
            begun = np.array([o[0] for o in found.offsets], np.int64)
            self._cut(chunks[first:first + 5000], found.ids,
                      np.searchsorted(begun, np.cumsum([len(c) + 1 for c in part])))

    def _by_ends(self, words: list[bytes]) -> None:
        """Words of one piece each: a piece ends with the suffix."""
        for first in range(0, len(words), 1000):
            part = words[first:first + 1000]
            ids = self.library.encode_batch_fast([b" ".join(part).decode()],
                                                 add_special_tokens=False)[0].ids
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(part):
                self._cut(part, ids, cuts)
            else:
                self._by_offsets(part)

    def _cut(self, chunks: list[bytes], ids: list[int], cuts: np.ndarray) -> None:
        data, cuts = np.array(ids, "<u4").tobytes(), (4 * cuts).tolist()
        self.memo.update(zip(chunks, (data[a:b] for a, b in zip([0] + cuts, cuts))))

    def _recall(self, chunks: set[bytes]) -> set[bytes]:
        """Chunks that neither generation knows; what the older one knows is young again."""
        known = chunks & self.older.keys()
        self.memo.update((c, self.older[c]) for c in known)
        return chunks - known

    def _learn(self, chunks: set[bytes]) -> None:
        chunks = self._recall(chunks)
        words = {c for c in chunks if not c.translate(None, LETTERS)} if self.plain else set()
        self._by_ends(list(words))
        self._by_offsets(list(chunks - words))

    def _parts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Text and code of every chunk, and the distinct chunks by code.

        Letters in lower case and the marks that close them are chunks of their own.
        """
        found = Words(data, offsets, hashed=False)
        text, lengths, kept = found.doc, found.lengths, data[found.inside]
        if self.plain and len(lengths):
            ends = np.cumsum(lengths)
            begins = ends - lengths
            tails = np.maximum.accumulate(np.where(_MARK[kept], 0, np.arange(1, len(kept) + 1)))
            tails = np.maximum(tails[ends - 1], begins)
            strange = np.concatenate([[0], np.cumsum(~_LETTER[kept])])
            plain = (tails > begins) & (strange[tails] == strange[begins])
            kept = np.where(np.repeat(plain, lengths), LOWER[kept], kept)
            parted = plain & (tails < ends)
            number = np.repeat(np.arange(len(ends)), 1 + parted)
            starts = begins[number]
            second = np.flatnonzero(parted) + np.cumsum(parted)[parted]
            starts[second] = tails[parted]
            text, lengths = text[number], np.diff(starts, append=len(kept))
        code, chunks = coded(kept, lengths)
        return text, code, chunks.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        offsets = np.cumsum([0, *map(len, texts)])
        ids, at = self.encode_slice(np.frombuffer(b"".join(texts), np.uint8), offsets)
        return [ids[low:high] for low, high in zip(at, at[1:])]

    def encode_slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after the other, and where each text's begin, and the end.

        The memo is asked once for each distinct chunk of the slice.
        """
        text, code, chunks = self._parts(data, offsets)
        if len(self.memo) > MEMO:
            self.memo, self.older = {}, self.memo
        missing = set(chunks).difference(self.memo)
        if missing:
            self._learn(missing)
        found = [self.memo[c] for c in chunks]
        table = np.frombuffer(b"".join(found), "<u4")
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts, size = (np.cumsum(lengths) - lengths)[code], lengths[code]
        of_text = np.bincount(text, size, len(offsets) - 1).astype(np.int64)
        return table[_runs(starts, size)], np.concatenate([[0], np.cumsum(of_text)])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


# ---------------------------------------------------------------- grammar

def _slot(key: np.ndarray, turn: int) -> np.ndarray:
    return (key * (0x9E3779B97F4A7C1 + 2 * turn)) >> 20 & ((1 << SLOT_BITS) - 1)


def compress(ids: np.ndarray, end_id: int = END_ID, min_count: int = MIN_COUNT,
             rounds: int = MAX_ROUNDS, min_gain: float = MIN_GAIN) -> tuple[np.ndarray, np.ndarray, int]:
    """Symbols, rules (pairs) and the first symbol that stands for a rule."""
    symbols = ids.astype(np.int64)
    base = int(symbols.max(initial=0)) + 1
    rules = np.zeros((0, 2), np.int64)
    for turn in range(rounds):
        key = symbols[:-1] << 32 | symbols[1:]
        key[(symbols[:-1] == end_id) | (symbols[1:] == end_id)] = -1
        pairs, counts = np.unique(key, return_counts=True)
        often = (counts >= min_count) & (pairs >= 0)
        pairs, counts = pairs[often], counts[often]
        if not len(pairs):
            break
        # Rank by frequency; of pairs that share a slot of the table, the first is taken
        # now and the others in a later round, which uses other slots.
        order = np.argsort(-counts, kind="stable")
        none = len(pairs)
        by_rank, slots = pairs[order], np.full(1 << SLOT_BITS, none)
        place = _slot(by_rank, turn)
        slots[place[::-1]] = np.arange(none)[::-1]
        here = slots[_slot(key, turn)]
        here[np.append(by_rank, -2)[here] != key] = none
        # A pair gives way to a more frequent neighbour, and to itself further left.
        padded = np.concatenate(([none], here, [none]))
        taken = (here < none) & (here < padded[:-2]) & (here <= padded[2:])
        taken[_alternate(here, none, padded, taken)] = True
        at = np.flatnonzero(taken)
        used, named = np.unique(here[at], return_inverse=True)
        symbols[at] = base + len(rules) + named
        left = np.ones(len(symbols), bool)
        left[at + 1] = False
        before, symbols = len(symbols), symbols[left]
        chosen = by_rank[used]
        rules = np.concatenate((rules, np.stack([chosen >> 32, chosen & 0xFFFFFFFF], 1)))
        if len(symbols) > (1 - min_gain) * before:
            break
    return symbols, rules, base


def _alternate(here: np.ndarray, none: int, padded: np.ndarray, taken: np.ndarray) -> np.ndarray:
    """Places of further pairs of runs of one symbol: every second one after a taken one."""
    run = np.flatnonzero((here == padded[:-2]) & (here < none))
    new = np.ones(len(run), bool)
    new[1:] = run[1:] != run[:-1] + 1
    start = run[new][np.cumsum(new) - 1] - 1
    return run[taken[start] & ((run - start) % 2 == 0) & (here[run] <= padded[2:][run])]


def expand(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids that symbols stand for."""
    lengths = expansions(rules, base)
    # One table of what every rule stands for; the sides of a rule come before it.
    table, starts = np.zeros(int(lengths.sum()), np.int64), np.cumsum(lengths) - lengths
    depth = np.zeros(len(rules), np.int64)
    while True:
        deeper = np.where(rules >= base, depth[np.maximum(rules - base, 0)] + 1, 0).max(1, initial=0)
        if (deeper == depth).all():
            break
        depth = deeper
    for level in range(int(depth.max(initial=-1)) + 1):
        now = np.flatnonzero(depth == level)
        table[_runs(starts[now], lengths[now])] = _filled(
            rules[now].ravel(), base, table, starts, lengths)
    return _filled(symbols.astype(np.int64), base, table, starts, lengths)


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.arange(int(lengths.sum())) + np.repeat(starts - np.cumsum(lengths) + lengths, lengths)


def _filled(symbols, base, table, starts, lengths) -> np.ndarray:
    named = np.flatnonzero(symbols >= base)
    if not len(named):
        return symbols
    rule = symbols[named] - base
    size = np.ones(len(symbols), np.int64)
    size[named] = lengths[rule]
    at = np.cumsum(size) - size
    out = np.empty(int(size.sum()), np.int64)
    out[at] = symbols
    out[_runs(at[named], lengths[rule])] = table[_runs(starts[rule], lengths[rule])]
    return out


def expansions(rules: np.ndarray, base: int) -> np.ndarray:
    """Number of ids that each rule stands for; rules name earlier rules only."""
    lengths = np.ones(len(rules), np.int64)
    while True:
        sides = np.where(rules >= base, lengths[np.maximum(rules - base, 0)], 1).sum(1)
        if (sides == lengths).all():
            return lengths
        lengths = sides


class Shard:
    """A compressed run of documents."""

    ARRAYS = (("doc_ids", "<i8"), ("known", "u1"), ("tokens", "<u4"), ("ends", "<u8"),
              ("rules", "<u4"), ("lengths", "<u4"))

    def __init__(self, doc_ids, known, tokens, ends, rules, lengths, symbols, base):
        self.doc_ids, self.known, self.tokens, self.ends = doc_ids, known, tokens, ends
        self.rules, self.lengths, self.symbols, self.base = rules, lengths, symbols, base

    @classmethod
    def of(cls, doc_ids: list[int | None], ids: list[np.ndarray], end_id: int = END_ID) -> "Shard":
        """Pack documents; each of ``ids`` ends with ``end_id``, which is nowhere else in it."""
        symbols, rules, base = compress(np.concatenate(ids), end_id)
        return cls(np.array([d or 0 for d in doc_ids], np.int64),
                   np.array([d is not None for d in doc_ids], np.uint8),
                   np.array([len(i) for i in ids]), np.flatnonzero(symbols == end_id) + 1,
                   rules.ravel(), expansions(rules, base), symbols, base)

    def dump(self) -> bytes:
        width = 2 if self.symbols.max(initial=0) < 1 << 16 else 3 if self.symbols.max(
            ) < 1 << 24 else 4
        head = {"base": self.base, "width": width, "symbols": len(self.symbols),
                **{n: len(getattr(self, n)) for n, _ in self.ARRAYS}}
        packed = self.symbols.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width]
        text = json.dumps(head).encode()
        return b"".join([len(text).to_bytes(8, "little"), text,
                         *(getattr(self, n).astype(t).tobytes() for n, t in self.ARRAYS),
                         packed.tobytes()])

    @classmethod
    def load(cls, data: bytes) -> "Shard":
        at = 8 + int.from_bytes(data[:8], "little")
        head = json.loads(data[8:at])
        arrays = []
        for name, kind in cls.ARRAYS:
            arrays.append(np.frombuffer(data, kind, head[name], at))
            at += arrays[-1].nbytes
        symbols = np.zeros((head["symbols"], 4), np.uint8)
        symbols[:, :head["width"]] = np.frombuffer(data, np.uint8, offset=at).reshape(
            -1, head["width"])
        return cls(*arrays, symbols.view("<u4").ravel(), head["base"])

    def _ids(self, low: int, high: int) -> np.ndarray:
        rules = np.asarray(self.rules, np.int64).reshape(-1, 2)
        return expand(self.symbols[low:high], rules, self.base).astype("<u4")

    def document(self, k: int) -> np.ndarray:
        """Ids of document ``k`` alone."""
        return self._ids(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard, from the symbols that cover them."""
        symbols = np.asarray(self.symbols, np.int64)
        size = np.ones(len(symbols), np.int64)
        named = symbols >= self.base
        size[named] = np.asarray(self.lengths)[symbols[named] - self.base]
        after = np.cumsum(size)
        low = int(np.searchsorted(after, start, "right"))
        high = int(np.searchsorted(after, stop)) + 1
        skip = start - int(after[low - 1] if low else 0)
        return self._ids(low, high)[skip:skip + stop - start]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Id, ids before it in the shard, and ids of each document."""
        everything, start = self._ids(0, len(self.symbols)), 0
        for doc, known, n in zip(self.doc_ids.tolist(), self.known.tolist(),
                                 self.tokens.tolist()):
            yield doc if known else None, start, everything[start:start + n]
            start += n


# ---------------------------------------------------------------- files

def write(docs: DataFrame, path: str, folder: str, doc_id: str = "doc_id", text: str = "text",
          end_id: int = END_ID) -> DataFrame:
    """Shards of all documents; ``part, number, path, start, n_docs, n_ids`` of each.

    ``start`` counts the ids of all documents before the shard.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, part, number = encoder(path), TaskContext.get().partitionId(), 0
        store, local = fs.FileSystem.from_uri(folder)
        store.create_dir(local, recursive=True)
        doc_ids, ids, held = [], [], 0

        def close():
            name = f"{uuid.uuid4().hex}.repair"
            with store.open_output_stream(f"{local}/{name}", compression=None) as out:
                out.write(Shard.of(doc_ids, ids, end_id).dump())
            return pa.RecordBatch.from_pylist([{
                "part": part, "number": number, "path": f"{folder}/{name}",
                "n_docs": len(ids), "n_ids": held}])

        for batch in batches:
            for row, end, data, offsets in slices(batch.column(1)):
                found, at = tokenizer.encode_slice(data, offsets)
                for k, doc in enumerate(batch.column(0).slice(row, end - row).to_pylist()):
                    doc_ids.append(doc)
                    ids.append(np.append(found[at[k]:at[k + 1]], np.uint32(end_id)))
                    held += len(ids[-1])
                    if held >= SHARD_IDS:
                        yield close()
                        doc_ids, ids, held, number = [], [], 0, number + 1
        if ids:
            yield close()

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), utf8(text).alias("text"))
    rows = rows.repartitionByRange("id").sortWithinPartitions("id", "text")
    shards = written(rows.mapInArrow(
        run, "part long, number long, path string, n_docs long, n_ids long"), "shards")
    # One row per task of the write; their order is that of the id ranges.
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n"))
                           .alias("before"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("number")) - F.col("n_ids")
    return shards.withColumn("inside", inside).join(before, "part").select(
        "part", "number", "path", (F.col("before") + F.col("inside")).alias("start"),
        "n_docs", "n_ids")


def read(shards: DataFrame, outputs: tuple[str, ...] = ("ids", "ids_crc32")) -> DataFrame:
    """``id, start, n_tokens`` and the outputs of every document, from the files."""
    kinds = {"ids": "array<int>", "ids_crc32": "long"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first in zip(*(c.to_pylist() for c in batch)):
                store, local = fs.FileSystem.from_uri(path)
                with store.open_input_file(local) as f:
                    shard = Shard.load(f.read())
                found = list(shard.documents())
                for k in range(0, len(found), 1000):
                    part = found[k:k + 1000]
                    made = {"ids": lambda: pa.array([i.astype(np.int32) for _, _, i in part],
                                                    pa.list_(pa.int32())),
                            "ids_crc32": lambda: pa.array([zlib.crc32(i.tobytes())
                                                           for _, _, i in part], pa.int64())}
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([d for d, _, _ in part], pa.int64()),
                         pa.array([first + s for _, s, _ in part], pa.int64()),
                         pa.array([len(i) for _, _, i in part], pa.int64()),
                         *(made[o]() for o in outputs)],
                        names=["id", "start", "n_tokens", *outputs])

    schema = "id long, start long, n_tokens long" + "".join(f", {o} {kinds[o]}" for o in outputs)
    return spread(shards.select("path", "start"), "path").mapInArrow(run, schema)


def stored(docs: DataFrame, path: str, **columns) -> DataFrame:
    """Write ``docs`` to new shards in the shared folder; their manifest."""
    folder = shared_folder(docs.sparkSession, "repair")
    return written(write(docs, path, folder, **columns), "manifest")
