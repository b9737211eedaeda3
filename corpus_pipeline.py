"""A training-data pipeline of operators of ``palaver.llm`` over ``documents``.

Each stage gets all rows that its predecessor kept, is written as Parquet in the
shared folder and reread.  All stages but the last return the columns of
``documents``.  NULL ids, texts and repeated rows are handled as each operator says;
in short: texts without ten words go in the first stage, and of equal rows one
stays.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm import bagminhash, bpe, repetition, spacedseed, suffixdedup
from palaver.llm.common import findable, written

WORD_BPE = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text passes the quality rules."""
    return repetition.judge(docs).where("kept").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every class of near duplicates, that of the smallest id."""
    return bagminhash.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that earlier strings of 100 bytes repeat.

    A character that lost one of its bytes goes as a whole; documents stay, even
    if nothing is left of their text.
    """
    left = suffixdedup.deduplicated(docs, outputs=("kept_text",))
    return left.withColumns({
        "text": F.when(F.col("text").isNotNull(), F.col("kept_text")),
        "n_chars": F.char_length("kept_text").cast(docs.schema["n_chars"].dataType),
    }).select(docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of the benchmark."""
    return spacedseed.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and their ids, and digests of ids and of the text they decode to."""
    return bpe.with_tokens(docs, public_tokenizers.path(WORD_BPE),
                           outputs=("n_tokens", "ids", "ids_sha256", "decoded_sha256"),
                           keep=("doc_id", "lang", "source", "n_chars"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontaminated),
    ("tokens", tokens),
]

#: Suffix sorting and byte-pair merges have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole ``documents`` table."""
    findable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
