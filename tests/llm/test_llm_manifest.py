"""Merkle manifest against a plain tree built in memory."""

import hashlib

import pytest

from palaver.llm import merkle, queries
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, source string, lang string, n_chars bigint, at int, node string"
FIELDS = queries.MANIFEST_FIELDS


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    values = ["-" if row[f] is None else str(row[f]) for f in FIELDS]
    return digest("".join("-" if row[f] is None else f"{len(v.encode())}:{v}"
                          for f, v in zip(FIELDS, values)))


def climb(nodes, arity):
    """The top of a list of digests, and each one's path of (left, right)."""
    paths = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        made, below = [], []
        for start in range(0, len(nodes), arity):
            run = nodes[start:start + arity]
            for k in range(len(run)):
                for i in under[start + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1:])))
            made.append(digest("".join(run)))
            below.append(sum(under[start:start + arity], []))
        nodes, under = made, below
    return nodes[0], paths


def plain_manifest(rows, arity):
    """Sorted (doc_id, leaf, subroot, root, path) of every row."""
    groups = {}
    for row in rows:
        groups.setdefault(row["source"], []).append(row)
    first = lambda v: (v is not None, v if v is not None else 0)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    tops, found = [], []
    for name in names:
        ordered = sorted(groups[name], key=lambda r: (first(r["doc_id"]), plain_leaf(r)))
        leaves = [plain_leaf(r) for r in ordered]
        top, paths = climb(leaves, arity)
        tops.append(top)
        found.append([(r["doc_id"], leaf, top, path) for r, leaf, path in zip(ordered, leaves, paths)])
    root, upper = climb(tops, arity)
    return sorted(((d, leaf, top, root, path + upper[k]) for k, group in enumerate(found)
                   for d, leaf, top, path in group), key=repr)


def odd_rows():
    rows = [(i, f"text {i}\n" * (i % 4), "hot", "en", i, 1, "x") for i in range(40)]
    rows += [(None, None, None, None, None, None, None)] * 2
    rows += [(None, "", None, "", 0, 1, "y"), (7, "a\nb", "hot", None, 3, 1, "z"),
             (7, "a\nb", "hot", None, 3, 1, "z"), (7, "other", "hot", "de", 5, 1, "z"),
             (50, "é" * 50_000, "é", "fr", 50_000, 1, ""), (51, "-", "", "-", -1, 0, "-"),
             (52, "x", "ab", "en", 1, 1, ""), (53, "x", "a", "en", 1, 1, ""), (54, "y", "a", "en", 1, 1, "")]
    return rows


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_manifest_equals_a_plain_tree(spark, arity):
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    got = merkle.manifest(docs, "doc_id", "source", FIELDS, {"at": F.col("at")}, arity)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "path", "at"]
    rows = [(r.doc_id, r.leaf, r.subroot, r.root, [tuple(s) for s in r.path]) for r in got.collect()]
    names = SCHEMA.replace(" bigint", "").replace(" string", "").replace(" int", "").split(", ")
    want = plain_manifest([dict(zip(names, r)) for r in odd_rows()], arity)
    assert sorted(rows, key=repr) == want


def test_query_tells_tampered_rows(spark, tmp_path):
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    docs.drop("at", "node").write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.QUERIES["op13_merkle_manifest"](spark, str(tmp_path)).collect()
    texts = {r[0]: r[1] for r in odd_rows()}
    assert len(rows) == len(odd_rows())
    import zlib
    for r in rows:
        if r.doc_id is None or r.doc_id == 7:
            continue
        even = zlib.crc32(str(r.doc_id).encode()) % 2 == 0
        assert r.verified == (not (even and "\n" in (texts[r.doc_id] or "")))
        assert (r.folded_root == r.root) == r.verified
    assert any(not r.verified for r in rows) and any(r.verified for r in rows)


def test_proof_is_the_digest_of_all_siblings(spark):
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    got = merkle.manifest(docs, "doc_id", "source", FIELDS)
    for r in got.withColumn("proof", merkle.proof()).withColumn("top", merkle.folded(F.col("leaf"))).collect():
        assert r.proof == digest("".join(s.left + s.right for s in r.path))
        assert r.top == r.root


def test_empty_and_single_tables(spark):
    empty = merkle.manifest(spark.createDataFrame([], SCHEMA), "doc_id", "source", FIELDS)
    assert empty.columns == ["doc_id", "leaf", "subroot", "root", "path"] and empty.count() == 0
    one = merkle.manifest(spark.createDataFrame(odd_rows()[:1], SCHEMA), "doc_id", "source", FIELDS).first()
    assert one.leaf == one.subroot == one.root and one.path == []


def test_no_plan_gathers_a_group(spark):
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    got = merkle.manifest(docs, "doc_id", "source", FIELDS)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Python" not in plan and "Arrow" not in plan
