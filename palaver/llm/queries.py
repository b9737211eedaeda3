"""Registered queries of this subpackage, each with its check SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm import (bagminhash, bpe, hmm, licenses, merkle, repair, repetition, spacedseed,
                         suffixdedup, tokenalign, toxicity, urlrules, warc)
from palaver.llm.common import crc_remainder, findable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
WORD_BPE = "word_bpe_49k.json"


def query(sql: str | None = None):
    def register(f):
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            findable(spark)
            return f(spark, sf_dir)

        QUERIES[f.__name__] = run
        if sql:
            ORACLE[f.__name__] = sql
        return run
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of every document."""
    return bpe.with_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE),
                           outputs=("n_tokens", "ids_sha256", "decoded_sha256"),
                           keep=("doc_id",))


@query()
def op6_quality_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures, longest repeat, covered fraction and verdict of every document."""
    return repetition.judge(table(spark, sf_dir, "documents"), keep=["doc_id"])


@query()
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence labels, base places and score of every document."""
    return licenses.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])


#: Labelled rows of which the toxicity model learns, at most.
TOXICITY_ROWS = 20_000


@query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a model that saw no row of remainder 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_remainder("doc_id", 4) == 2
    rows = toxicity.training_rows(docs, table(spark, sf_dir, "labels"), ~held_out,
                                  "doc_id", "text", "toxic", TOXICITY_ROWS)
    scored = toxicity.with_scores(docs, toxicity.train(rows), keep=["doc_id"])
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query()
def op10_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that it holds a passage of."""
    return spacedseed.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document: the smallest id among its near duplicates."""
    return bagminhash.classes(table(spark, sf_dir, "documents"))


@query()
def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, list rule and verdict of every page's url.

    Pages without a list rule are labelled by the label of their id: low quality
    or toxic is block, else allow.
    """
    bad = (F.min("quality") == 0) | (F.max("toxic") == 1)
    labels = (table(spark, sf_dir, "labels").where("doc_id is not null")
              .groupBy(F.col("doc_id").alias("page_id"))
              .agg(F.when(bad, "block").otherwise("allow").alias("verdict")))
    return urlrules.judge(table(spark, sf_dir, "pages"), labels)


@query("""
    WITH p AS (
        SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hexadecimal,
               row_number() OVER same AS number, max(page_id) OVER same AS first
        FROM pages
        WINDOW same AS (PARTITION BY coalesce(html, '') ORDER BY page_id DESC NULLS LAST))
    SELECT page_id, strlen(payload) AS payload_bytes,
           array_to_string(list_transform(range(32), lambda k: substr(
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + (((('0x' || substr(hexadecimal, 1 + 5 * (k // 4), 5))::INT)
                     >> (15 - 5 * (k % 4))::INT) & 31)::INT, 1)), '') AS payload_digest,
           CASE WHEN number = 1 THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN number > 1 THEN first END AS refers_to
    FROM p
""")
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record type, digest and size of every page, read back from its archive."""
    index = warc.archived(table(spark, sf_dir, "pages"))
    return warc.read(index, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op8_repair_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, size and checksum of every document's ids, read back from the shards."""
    shards = repair.stored(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
    return repair.read(shards, outputs=("ids_crc32",)).withColumnRenamed("id", "doc_id")


@query()
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that earlier 100-byte strings repeat, and what is left."""
    return suffixdedup.deduplicated(
        table(spark, sf_dir, "documents"), keep=["doc_id"],
        outputs=("n_bytes", "n_removed", "n_spans", "kept_sha256"))


MANIFEST_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@query("""
    WITH RECURSIVE crc AS (
        SELECT doc_id, text, source,
               concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-'),
                      coalesce(strlen(source) || ':' || source, '-'),
                      coalesce(strlen(lang) || ':' || lang, '-'),
                      coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-')) AS head,
               list_reduce(
                   list_prepend(4294967295::BIGINT, list_transform(
                       string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                   lambda crc, b: list_reduce(
                       list_prepend(xor(crc, b), range(8)),
                       lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384)
                                         ELSE x >> 1 END)) AS inverted
        FROM documents),
    leaves AS (
        SELECT doc_id, source,
               sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
               CASE WHEN inverted % 2 = 1
                    THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':'
                                                 || replace(text, chr(10), ''), '-'))
                    ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS start
        FROM crc),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
               count(*) OVER (PARTITION BY source) AS n
        FROM leaves),
    nodes AS (
        SELECT source, 0 AS level, pos, n, leaf AS node FROM placed
        UNION ALL
        SELECT source, any_value(level) + 1, pos // 3, any_value(n + 2) // 3,
               sha256(string_agg(node, '' ORDER BY pos))
        FROM nodes WHERE n > 1 GROUP BY source, pos // 3),
    tops AS (
        SELECT source, node, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos,
               count(*) OVER () AS n
        FROM nodes WHERE n = 1),
    upper AS (
        SELECT 0 AS level, pos, n, node FROM tops
        UNION ALL
        SELECT any_value(level) + 1, pos // 3, any_value(n + 2) // 3,
               sha256(string_agg(node, '' ORDER BY pos))
        FROM upper WHERE n > 1 GROUP BY pos // 3),
    lower_steps AS (
        SELECT a.source, a.level, a.pos,
               coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
               coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
        FROM nodes a JOIN nodes b ON a.source IS NOT DISTINCT FROM b.source
             AND a.level = b.level AND a.pos // 3 = b.pos // 3
        WHERE a.n > 1 GROUP BY a.source, a.level, a.pos),
    upper_steps AS (
        SELECT a.level, a.pos,
               coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
               coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
        FROM upper a JOIN upper b ON a.level = b.level AND a.pos // 3 = b.pos // 3
        WHERE a.n > 1 GROUP BY a.level, a.pos),
    climb AS (
        SELECT doc_id, source, pos AS leaf_pos, 0 AS level, pos, n, start AS node, '' AS proof FROM placed
        UNION ALL
        SELECT c.doc_id, c.source, c.leaf_pos, c.level + 1, c.pos // 3, (c.n + 2) // 3,
               sha256(s.l || c.node || s.r), c.proof || s.l || s.r
        FROM climb c JOIN lower_steps s ON c.source IS NOT DISTINCT FROM s.source
             AND c.level = s.level AND c.pos = s.pos
        WHERE c.n > 1),
    over AS (
        SELECT c.doc_id, c.source, c.leaf_pos, 0 AS level, t.pos, t.n, c.node, c.proof
        FROM climb c JOIN tops t ON c.source IS NOT DISTINCT FROM t.source WHERE c.n = 1
        UNION ALL
        SELECT o.doc_id, o.source, o.leaf_pos, o.level + 1, o.pos // 3, (o.n + 2) // 3,
               sha256(s.l || o.node || s.r), o.proof || s.l || s.r
        FROM over o JOIN upper_steps s ON o.level = s.level AND o.pos = s.pos
        WHERE o.n > 1),
    root AS (SELECT node AS root FROM upper WHERE n = 1)
    SELECT p.doc_id, p.leaf, t.node AS subroot, root.root, sha256(o.proof) AS proof_sha256,
           o.node AS folded_root, o.node = root.root AS verified
    FROM placed p JOIN over o ON p.source IS NOT DISTINCT FROM o.source AND p.pos = o.leaf_pos AND o.n = 1
         JOIN tops t ON t.source IS NOT DISTINCT FROM p.source CROSS JOIN root
""")
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, source root, root and proof of every document, checked on partly tampered rows.

    Rows whose id has an even crc32 (a NULL id: that of '') are checked without the
    line feeds of their text.
    """
    docs = table(spark, sf_dir, "documents")
    text = F.when(crc_remainder("doc_id", 2) == 0, F.replace("text", F.lit("\n"), F.lit("")))
    tampered = merkle.leaf([*(F.col(f) for f in MANIFEST_FIELDS[:-1]), F.coalesce(text, "text")])
    rows = merkle.manifest(docs, "doc_id", "source", MANIFEST_FIELDS, {"tampered": tampered})
    rows = rows.withColumn("folded_root", merkle.folded(F.col("tampered")))
    return rows.select("doc_id", "leaf", "subroot", "root", merkle.proof().alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


@query()
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned groups and links of a byte-level and a piece tokenizer in every document."""
    return tokenalign.alignment(table(spark, sf_dir, "documents"),
                                public_tokenizers.path("byte_bpe_50k.json"),
                                public_tokenizers.path("piece_bpe_32k.model"))


@query()
def op11_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Likelihood of every document by a hidden Markov model that saw no row of remainder 2."""
    training = crc_remainder("doc_id", 7) != 2
    rows = hmm.scores(table(spark, sf_dir, "documents"), training)
    return rows.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known",
                       "train_tokens", "base_score", "score")
