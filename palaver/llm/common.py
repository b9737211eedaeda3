"""Shared folder, Arrow slices and vectorised word hashing."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

SLICE_BYTES = 2 << 20
ODD = np.uint64(0x9E3779B97F4A7C15)
WHITE_SPACE = b" \t\n\x0b\x0c\r"


# ---------------------------------------------------------------- session

def findable(spark: SparkSession) -> None:
    """Let Python workers look for this package where the driver found it.

    A cluster has the package installed or gets it with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment
    paths = [p for p in known.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([*paths, root])


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors see.

    Only in a local session without the setting (tests) a temporary folder of this
    machine takes its place; on a cluster its executors would not see one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^,]*(,[^,]*)?\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="palaver-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def _shuffle_cleanup(spark: SparkSession):
    """Shuffle files of a written table are of no use once it is written."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, lineage cut."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    with _shuffle_cleanup(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows that name files, dealt over as many tasks as shuffles have.

    The number is given, so that few small rows are not put into one task.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


#: Bits of the filter by :func:`sifted`; it weighs 2 MB.
SIFT_BITS = 1 << 24


def sifted(rows: DataFrame, ids: DataFrame, key: str = "id", bits: int = SIFT_BITS) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not in ``ids``; none that is in it goes.

    A filter of fixed size, whatever the number of ids, so that texts nobody asks for
    are not shuffled to a join.  When it is full it lets all rows pass.
    """
    place = F.pmod(F.xxhash64(key), F.lit(bits)) + 1
    # At most bits / 32768 rows of 4 kB.
    maps = ids.where(F.col(key).isNotNull()).groupBy(
        F.bitmap_bucket_number(place).alias("__part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("__bits"))
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substr("__bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    tested = rows.join(F.broadcast(maps), F.bitmap_bucket_number(place) == F.col("__part"))
    return tested.where(F.getbit(byte, (at % 8).cast("int")) == 1).select(rows.columns)


def utf8(column: str | Column) -> Column:
    """The UTF-8 bytes of a text, empty for NULL."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column, F.lit("")).cast("binary")


def crc_remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; NULL ids count as ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


# ---------------------------------------------------------------- Arrow slices

def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Data bytes and offsets (n + 1) of a binary column without NULLs."""
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def slices(column: pa.Array, limit: int = SLICE_BYTES
           ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``limit`` bytes: first row, end row, bytes, offsets."""
    data, offsets = buffers(column)
    row, n = 0, len(column)
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), n)
        part = offsets[row:end + 1]
        yield row, end, data[part[0]:part[-1]], part - part[0]
        row = end


# ---------------------------------------------------------------- words

def byte_class(excluded: bytes) -> np.ndarray:
    table = np.ones(256, bool)
    table[list(excluded)] = False
    return table


#: Bytes of words parted by ASCII white space.
SPACED = byte_class(WHITE_SPACE)
#: Digits, letters and everything beyond ASCII.
ALNUM = np.array([chr(b).isalnum() or b >= 0x80 for b in range(256)])
SAME = np.arange(256, dtype=np.uint8)
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (in place)."""
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 1024), ODD)
        steps[0] = 1
        _powers = np.cumprod(steps)
    return _powers


def run_hashes(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and 64-bit hashes of the runs of bytes that begin at ``starts``."""
    lengths = np.diff(np.append(starts, len(values)))
    if not len(starts):
        return lengths, np.zeros(0, np.uint64)
    inside = np.arange(len(values)) - np.repeat(starts, lengths)
    terms = powers(int(lengths.max()))[inside]
    terms *= values.astype(np.uint64) + np.uint64(1)
    return lengths, mix(np.add.reduceat(terms, starts) + lengths.astype(np.uint64) * ODD)


class Words:
    """Words of a slice of texts: document, length in bytes, hash, place in the slice.

    Hashes take some numbers of eight bytes for each byte while they are made; without
    ``hashed`` there are none.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray = SPACED,
                 fold: np.ndarray = SAME, hashed: bool = True):
        inside = table[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        borders = offsets[:-1][offsets[:-1] < len(data)]
        first[borders] = inside[borders]
        self.starts = np.flatnonzero(first)
        if hashed:
            kept = fold[data[inside]]
            place = np.cumsum(inside)[self.starts] - 1
            self.lengths, self.hashes = run_hashes(kept, place)
        else:
            last = inside.copy()
            last[:-1] &= ~inside[1:] | first[1:]
            self.lengths = np.flatnonzero(last) + 1 - self.starts
        self.ends = self.starts + self.lengths
        #: index of the first word of each document, and the end of the last
        self.bounds = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.bounds)
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.counts)
        self.inside = inside


def coded(kept: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Codes of runs of bytes that stand one after the other, and the distinct runs by code."""
    borders = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    found = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(borders), pa.py_buffer(kept)]
    ).dictionary_encode()
    return found.indices.to_numpy(), found.dictionary


def grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First word index and hash of every run of ``n`` words within a document."""
    total = len(words.hashes)
    if total < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    size = total - n + 1
    at = np.flatnonzero(words.doc[:size] == words.doc[n - 1:])
    h = words.hashes[:size].copy()
    for k in range(1, n):
        h *= ODD
        h += words.hashes[k:size + k]
    return at, mix(h[at])


# ---------------------------------------------------------------- per-text columns

def map_slices(docs: DataFrame, text: str, keep: list[str], fields: list[T.StructField],
               work: Callable[[np.ndarray, np.ndarray], list]) -> DataFrame:
    """``keep`` columns of each row with columns that ``work`` makes from its text.

    ``work(data, offsets)`` gets a slice of whole texts and returns a value per
    text for each of ``fields``.  Texts are read in the tasks; nothing is shuffled.
    """
    made = {f.name for f in fields}
    keep = [c for c in keep if c not in made]
    schema = T.StructType([docs.schema[c] for c in keep] + fields)
    types = [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in slices(batch.column(len(keep))):
                values = [v if isinstance(v, pa.Array) else pa.array(v, t)
                          for v, t in zip(work(data, offsets), types)]
                rest = [c.slice(row, end - row) for c in batch.columns[:len(keep)]]
                yield pa.RecordBatch.from_arrays(rest + values, names=schema.names)

    rows = docs.select(*(F.col(f"`{c}`") for c in keep), utf8(text).alias("__bytes"))
    return rows.mapInArrow(run, schema)
