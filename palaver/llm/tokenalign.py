"""Alignment of two tokenizers over the same bytes, as an Arrow pipeline.

Tokenizer A is byte-level BPE (a file of the tokenizers library), B is a piece model
with byte fallback (a file of sentencepiece).  Both encode a blank and the text.  Per
block of texts the lists of ids are flattened with their parent indices; token
lengths, summed up within each list, give the byte where every token ends; and a
hash join on (list, end) finds where tokens of both end.  Its inner part cuts the tokens into
groups.  Its outer part, in byte order, lists the smallest stretches between any two ends,
and each is the overlap of one A token with one B token: a link.  ``Table.group_by``
counts a block's id pairs, once for a document, and Spark adds the counts up.

Neither tokenizer has a token that goes on past a blank behind something that is not
white space (B's vocabulary is checked for it), so blocks are cut there and only a
block's distinct chunks are encoded, put together to longer strings.  Where the bytes of the
tokens are not those of a string, its chunks are encoded one by one.

What a pair's count is, tasks need twice: pairs with at least one ``FREQUENT``-th of
all counts, of which there cannot be more than ``FREQUENT``, are sent to the tasks; the others
are joined, as rows of (row, pair).

NULL and empty texts, and texts whose A or B tokens do not spell the blank and the text,
have no tokens: zeros and an empty digest.  Repeated rows count and are
returned as often as they occur, whatever their id; an empty table has an empty result.
Texts are encoded whole.  Only id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palaver.llm.common import slices, utf8, written

BLOCK_BYTES = 8 << 20
STRING_BYTES = 8 << 10
FREQUENT = 1 << 19
BLANK = "▁"
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_ROW = T.StructType([T.StructField("id", T.LongType())]
                    + [T.StructField(c, T.LongType()) for c in COUNTS]
                    + [T.StructField("groups_sha256", T.StringType()),
                       T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()),
                       T.StructField("rare", T.ArrayType(T.StructType([
                           T.StructField("pair", T.LongType()), T.StructField("times", T.LongType())])))])
_loaded: dict[tuple[str, str], "Pair"] = {}


# ---------------------------------------------------------------- tokenizers

def _byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(rest)}}


class Pair:
    """The two tokenizers, the bytes of their tokens and the decimal names of their ids."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        alphabet = _byte_alphabet()
        tokens = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        special = self.a.get_added_tokens_decoder()
        self.bytes_a = pa.array([b"" if i in special else bytes(alphabet[c] for c in t)
                                 for i, t in enumerate(tokens)], pa.large_binary())
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = pa.array([bytes([int(p[3:5], 16)]) if self.b.is_byte(i)
                                 else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)],
                                pa.large_binary())
        #: whether blocks may be cut before blanks
        self.by_chunk = not any(BLANK in p.lstrip(BLANK) for p in pieces)
        names = [[f"{i}{mark}" for i in range(n)]
                 for n, marks in ((len(tokens), ",|"), (len(pieces), ",;")) for mark in marks]
        self.names = pa.array(sum(names, []), pa.large_binary())
        #: where names of A's ids in and at the end of a group begin, then those of B
        self.name_at = np.cumsum([0] + [len(n) for n in names])

    def encode_a(self, strings: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch(strings, add_special_tokens=False)]

    def encode_b(self, strings: list[str]) -> list[list[int]]:
        """Ids of strings that begin with a blank, which the model adds itself."""
        return self.b.encode([s[1:] for s in strings], num_threads=1)


def load(path_a: str, path_b: str) -> Pair:
    """Both tokenizers, loaded once per worker."""
    key = path_a, path_b
    if key not in _loaded:
        _loaded[key] = Pair(*key)
    return _loaded[key]


# ---------------------------------------------------------------- chunks of a block

def _ends_in_word(data: np.ndarray) -> np.ndarray:
    """Whether a byte surely ends a character that is not white space.

    ASCII beyond the blank, and two-byte characters from U+00C0 on; a character of
    which this is not sure only makes a chunk longer.
    """
    sure = (data > 32) & (data < 127)
    lead = np.zeros(len(data), bool)
    lead[1:] = (data[:-1] >= 0xC3) & (data[:-1] <= 0xDF)
    return sure | (lead & (data >= 0x80))


def chunks(data: np.ndarray, offsets: np.ndarray, by_chunk: bool
           ) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Chunks of the texts, each text after a blank; the text of each; which may be followed by others.

    Empty texts have no chunk.
    """
    full = np.flatnonzero(np.diff(offsets))
    data = np.insert(data, offsets[full], 32)
    sizes = np.diff(offsets)[full] + 1
    ends = np.cumsum(sizes)
    first = np.zeros(len(data), bool)
    ended = _ends_in_word(data)
    if by_chunk:
        first[1:] = (data[1:] == 32) & ended[:-1]
        first[ends - 1] = False
    first[ends - sizes] = True
    starts = np.flatnonzero(first)
    borders = np.append(starts, len(data)).astype(np.int64)
    array = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(borders), pa.py_buffer(data)])
    text = full[np.searchsorted(ends, starts, "right")]
    return array, text, ended[borders[1:] - 1] if len(starts) else np.zeros(0, bool)


def _flat(lists: list[list[int]], token_bytes: pa.Array) -> tuple[pa.Table, pa.Array]:
    """Parent, end within it and id of every token, and the tokens' bytes."""
    nested = pa.array(lists, pa.list_(pa.int64()))
    ids, parent = nested.flatten(), pc.list_parent_indices(nested)
    spelled = token_bytes.take(ids)
    total = pc.cumulative_sum(pc.binary_length(spelled)).to_numpy()
    parents = parent.to_numpy()
    before = np.zeros(len(lists) + 1, np.int64)
    before[1:] = np.concatenate([[0], total])[np.searchsorted(parents, np.arange(len(lists)), "right")]
    ends = total - before[parents]
    return pa.table({"list": parent, "end": pa.array(ends), "id": ids}), spelled


def _joined(array: pa.Array) -> bytes:
    """All values of an array without NULLs, put together."""
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset:array.offset + len(array) + 1]
    return array.buffers()[2].to_pybytes()[offsets[0]:offsets[-1]] if len(array) else b""


def _spells(table: pa.Table, spelled: pa.Array, strings: list[bytes]) -> np.ndarray:
    """Whether the tokens of each list spell its string."""
    if len(strings) == 0 or _joined(spelled) == b"".join(strings):
        lengths = np.array([len(s) for s in strings], np.int64)
        sizes = np.zeros(len(strings), np.int64)
        np.add.at(sizes, table["list"].to_numpy(), pc.binary_length(spelled).to_numpy())
        if np.array_equal(lengths, sizes):
            return np.ones(len(strings), bool)
    tokens = np.searchsorted(table["list"].to_numpy(), np.arange(len(strings) + 1))
    return np.array([b"".join(spelled.slice(x, y - x).to_pylist()) == s
                     for x, y, s in zip(tokens, tokens[1:], strings)], bool)


@dataclass
class Aligned:
    """What the distinct chunks of a block have: counts, links and the names of their groups."""

    valid: np.ndarray
    counts: np.ndarray  # chunk x COUNTS
    link_at: np.ndarray  # first link of each chunk, and the end
    links: np.ndarray  # A id << 32 | B id
    groups: pa.Array  # ``a1,a2|b1;`` for all groups of a chunk


def _join(pair: Pair, a: pa.Table, b: pa.Table, base: np.ndarray, ends: np.ndarray) -> tuple:
    """Counts per chunk, links and group names of lists that spell their strings.

    ``base`` has the byte where each list begins, ``ends`` where each chunk ends.
    """
    both = a.rename_columns(["list", "end", "a"]).join(
        b.rename_columns(["list", "end", "b"]), ["list", "end"], join_type="full outer",
        use_threads=False)
    place = base[both["list"].to_numpy()] + both["end"].to_numpy()
    order = pa.array(np.argsort(place))
    place = place[order.to_numpy()]
    a_ids, b_ids = (both[c].take(order).combine_chunks() for c in ("a", "b"))
    ends_a, ends_b = (c.is_valid().to_numpy(zero_copy_only=False) for c in (a_ids, b_ids))
    links = (pc.fill_null_backward(a_ids).to_numpy() << 32) | pc.fill_null_backward(b_ids).to_numpy()
    common = ends_a & ends_b
    last = np.searchsorted(place, ends, "right")
    totals = np.stack([np.concatenate([[0], np.cumsum(x)])[np.append(0, last)]
                       for x in (ends_a, ends_b, common, np.ones(len(place), np.int64))], 1)
    # Names of A's ids, then of B's, group by group.
    group = np.cumsum(common) - common
    side_a, side_b = np.flatnonzero(ends_a), np.flatnonzero(ends_b)
    ids = np.concatenate([a_ids.drop_null().to_numpy(), b_ids.drop_null().to_numpy()])
    at_end = np.concatenate([common[side_a], common[side_b]])
    side = np.repeat([0, 2], [len(side_a), len(side_b)])
    turn = np.argsort(np.concatenate([group[side_a] * 2, group[side_b] * 2 + 1]), kind="stable")
    named = pair.names.take(pa.array((pair.name_at[side + at_end] + ids)[turn]))
    tokens = totals[:, 0] + totals[:, 1]
    offsets = np.frombuffer(named.buffers()[1], np.int64)[:len(named) + 1][tokens]
    groups = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), named.buffers()[2]])
    return np.diff(totals, axis=0), last, links, groups


def align(pair: Pair, distinct: pa.Array, joinable: np.ndarray) -> Aligned:
    """Align chunks; those that are ``joinable`` are encoded as parts of longer strings."""
    m = len(distinct)
    words = distinct.to_pylist()
    sizes = pc.binary_length(distinct).to_numpy()
    order = np.argsort(~joinable, kind="stable")
    n_joinable = int(joinable.sum())
    filled = np.cumsum(sizes[order[:n_joinable]]) // STRING_BYTES
    cuts = np.flatnonzero(np.diff(filled)) + 1
    runs = [r for r in np.split(order[:n_joinable], cuts) if len(r)] + [
        order[k:k + 1] for k in range(n_joinable, m)]

    def encoded(parts: list[np.ndarray]) -> tuple:
        strings = [b"".join([words[i] for i in r]) for r in parts]
        texts = [s.decode("utf-8", "replace") for s in strings]
        (a, spelled_a), (b, spelled_b) = (
            _flat(pair.encode_a(texts), pair.bytes_a), _flat(pair.encode_b(texts), pair.bytes_b))
        return a, b, _spells(a, spelled_a, strings) & _spells(b, spelled_b, strings)

    def kept(table: pa.Table, good: np.ndarray) -> pa.Table:
        lists = table["list"].to_numpy()
        table = table.filter(pa.array(good[lists]))
        number = np.cumsum(good) - 1
        return table.set_column(0, "list", pa.array(number[table["list"].to_numpy()]))

    valid = np.ones(m, bool)
    a, b, good = encoded(runs)
    single = [r[k:k + 1] for r, g in zip(runs, good) if not g for k in range(len(r))]
    parts = [(kept(a, good), kept(b, good), [r for r, g in zip(runs, good) if g])]
    if single:
        a, b, good = encoded(single)
        valid[np.concatenate(single)[~good]] = False
        parts.append((kept(a, good), kept(b, good), [r for r, g in zip(single, good) if g]))

    counts = np.zeros((m, len(COUNTS)), np.int64)
    spans, links, groups, places, before = np.zeros((m, 2), np.int64), [], [], [], 0
    for a, b, runs in parts:
        if not runs:
            continue
        chosen = np.concatenate(runs)
        ends = np.cumsum(sizes[chosen])
        run_ends = ends[np.cumsum([len(r) for r in runs]) - 1]
        found, last, linked, named = _join(pair, a, b, np.concatenate([[0], run_ends[:-1]]), ends)
        counts[chosen] = found
        spans[chosen, 1] = last + before
        spans[chosen, 0] = np.concatenate([[0], last[:-1]]) + before
        before += len(linked)
        links.append(linked)
        groups.append(named)
        places.append(chosen)
    lengths = spans[:, 1] - spans[:, 0]
    link_at = np.concatenate([[0], np.cumsum(lengths)])
    flat = np.concatenate(links) if links else np.zeros(0, np.int64)
    flat = flat[np.repeat(spans[:, 0] - link_at[:-1], lengths) + np.arange(link_at[-1])]
    row = np.full(m, -1)
    if places:
        chosen = np.concatenate(places)
        row[chosen] = np.arange(len(chosen))
    groups = pa.concat_arrays([*groups, pa.array([b""], pa.large_binary())])
    row[row < 0] = len(groups) - 1
    return Aligned(valid, counts, link_at, flat, groups.take(pa.array(row)))


# ---------------------------------------------------------------- blocks

@dataclass
class Block:
    """Counts and group digests of a block's texts, and how often each has every pair."""

    counts: np.ndarray
    digests: list[str]
    pairs: pa.Table  # text, pair, times


def block(pair: Pair, data: np.ndarray, offsets: np.ndarray, digests: bool) -> Block:
    size = len(offsets) - 1
    parts, text, followed = chunks(data, offsets, pair.by_chunk)
    coded = parts.dictionary_encode()
    code, distinct = coded.indices.to_numpy(), coded.dictionary
    joinable = np.zeros(len(distinct), bool)
    joinable[code] = followed
    found = align(pair, distinct, joinable & pair.by_chunk)
    wrong = np.zeros(size, bool)
    wrong[text[~found.valid[code]]] = True
    good = ~wrong[text]
    text, code = text[good], code[good]
    border = np.searchsorted(text, np.arange(size + 1))
    counts = np.concatenate([np.zeros((1, len(COUNTS)), np.int64), np.cumsum(found.counts[code], 0)])
    counts = counts[border[1:]] - counts[border[:-1]]
    names = [""] * size
    if digests:
        named = found.groups.take(pa.array(code))
        place = np.frombuffer(named.buffers()[1], np.int64)[:len(named) + 1] if len(named) else [0]
        view = memoryview(named.buffers()[2]) if len(named) else b""
        names = [hashlib.sha256(view[place[x]:place[y] - 1]).hexdigest() if y > x else ""
                 for x, y in zip(border, border[1:])]
    m = max(len(distinct), 1)
    once, times = np.unique(text * m + code, return_counts=True)
    of_text, word = once // m, once % m
    n_links = found.link_at[word + 1] - found.link_at[word]
    first = np.concatenate([[0], np.cumsum(n_links)])
    at = np.repeat(found.link_at[word] - first[:-1], n_links) + np.arange(first[-1])
    pairs = pa.table({"text": np.repeat(of_text, n_links), "pair": found.links[at],
                      "times": np.repeat(times, n_links)})
    pairs = pairs.group_by(["text", "pair"], use_threads=False).aggregate([("times", "sum")])
    return Block(counts, names, pairs.rename_columns(["text", "pair", "times"]))


def _blocks(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("id"), utf8(F.col(f"`{text}`")).alias("bytes"))


def pair_counts(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id",
                text: str = "text") -> DataFrame:
    """``pair, n, best``: documents with each linked pair of ids, and whether no pair of its A id has more.

    ``pair`` is the A id times 2**32 plus the B id.  Tasks count their blocks, Spark adds up.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = load(path_a, path_b)
        for batch in batches:
            for _, _, data, offsets in slices(batch.column(1), BLOCK_BYTES):
                counted = block(pair, data, offsets, digests=False).pairs.group_by(
                    "pair", use_threads=False).aggregate([("text", "count")])
                yield from counted.select(["pair", "text_count"]).rename_columns(
                    ["pair", "n"]).to_batches()

    counted = (_blocks(docs, doc_id, text).mapInArrow(run, "pair long, n long")
               .groupBy("pair").agg(F.sum("n").alias("n")))
    # As many rows for an A id as B has ids, at most.
    of_a = Window.partitionBy(F.shiftright("pair", 32))
    return counted.withColumn("best", F.col("n") == F.max("n").over(of_a))


def alignment(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id",
              text: str = "text") -> DataFrame:
    """Counts of tokens, groups and links, sums over links and the digest of the groups, per row."""
    pairs = written(pair_counts(docs, path_a, path_b, doc_id, text), "align-pairs")
    total = pairs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    frequent = F.col("n") * FREQUENT >= total
    # At most FREQUENT rows: each has a FREQUENT-th of the total.
    sent = pairs.where(frequent).toArrow().sort_by("pair")
    known, n, best = (sent[c].to_numpy() for c in ("pair", "n", "best"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = load(path_a, path_b)
        for batch in batches:
            for row, end, data, offsets in slices(batch.column(1), BLOCK_BYTES):
                found = block(pair, data, offsets, digests=True)
                of_text, pairs_, times = (found.pairs[c].to_numpy() for c in ("text", "pair", "times"))
                at = np.minimum(np.searchsorted(known, pairs_), max(len(known) - 1, 0))
                hit = known[at] == pairs_ if len(known) else np.zeros(len(pairs_), bool)
                sums = [np.zeros(end - row, np.int64) for _ in range(2)]
                for total_, value in zip(sums, (best, n)):
                    np.add.at(total_, of_text[hit], times[hit] * value[at[hit]])
                rest = np.flatnonzero(~hit)
                rest = rest[np.argsort(of_text[rest], kind="stable")]
                rare = pa.StructArray.from_arrays(
                    [pa.array(pairs_[rest]), pa.array(times[rest])], ["pair", "times"])
                borders = np.searchsorted(of_text[rest], np.arange(end - row + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row),
                     *(pa.array(c) for c in found.counts.T), pa.array(found.digests),
                     *(pa.array(s) for s in sums),
                     pa.ListArray.from_arrays(pa.array(borders, pa.int32()), rare)],
                    names=_ROW.names)

    rows = _blocks(docs, doc_id, text).mapInArrow(run, _ROW)
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "align-rows")
    rest = rows.select("row", F.explode("rare").alias("r")).select("row", "r.pair", "r.times")
    sums = (rest.join(pairs.where(~frequent), "pair").groupBy("row")
            .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("rare_best"),
                 F.sum(F.col("times") * F.col("n")).alias("rare_sum")))
    return rows.join(sums, "row", "left").select(
        F.col("id").alias(doc_id), *COUNTS,
        (F.col("n_best") + F.coalesce("rare_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("rare_sum", F.lit(0))).alias("count_sum"), "groups_sha256")
