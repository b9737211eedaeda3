"""Token alignment against a plain walk over the bytes of both tokenizers."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from palaver.llm import queries, tokenalign

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  ", "\n", "a", "a ", " a", "a  b", "a\n", "x ▁ y", "▁", "tab\tand\nline  two \n\n three ",
       "nul\x00byte", "<|endoftext|> as text <s> </s> <unk> <0x41>", "don't they're I'll 12 345,6",
       "né à la Übergröße ﬁ ½ ² ά ñandú é é", "中文 字符 ， 日本語テキスト", "👍🏽 👩‍👩‍👧 ok", "a　b　 c",
       "a b  c", "a\x85b \x85 c", "a   b", "﻿ bom", "x" * 5000, " x" * 3000, "​ ‍ z",
       "word word word word", "and the the and of", "The the THE"]


class Plain:
    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.alphabet = tokenalign._byte_alphabet()

    def tokens(self, text):
        """Ids and end bytes of both, or None where they do not spell the blank and the text."""
        want = (" " + text).encode()
        ids_a = self.a.encode(" " + text, add_special_tokens=False).ids
        ids_b = self.b.encode(text)
        bytes_a = [bytes(self.alphabet[c] for c in self.a.id_to_token(i)) for i in ids_a]
        bytes_b = []
        for i in ids_b:
            piece = self.b.id_to_piece(i)
            byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
            bytes_b.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
        if not text or b"".join(bytes_a) != want or b"".join(bytes_b) != want:
            return None
        return (ids_a, np.cumsum([len(x) for x in bytes_a]).tolist(),
                ids_b, np.cumsum([len(x) for x in bytes_b]).tolist())

    def align(self, text):
        """Groups as ``(A ids, B ids)``, and links."""
        found = self.tokens(text or "")
        if found is None:
            return [], []
        ids_a, ends_a, ids_b, ends_b = found
        common = sorted(set(ends_a) & set(ends_b))
        groups = [([i for i, e in zip(ids_a, ends_a) if low < e <= high],
                   [i for i, e in zip(ids_b, ends_b) if low < e <= high])
                  for low, high in zip([0] + common, common)]
        links, i, j = [], 0, 0
        while i < len(ids_a) and j < len(ids_b):
            links.append((ids_a[i], ids_b[j]))
            x, y = ends_a[i], ends_b[j]
            i, j = i + (x <= y), j + (y <= x)
        return groups, links


def plain_alignment(texts):
    plain = Plain()
    found = [plain.align(t) for t in texts]
    counts = Counter(p for _, links in found for p in set(links))
    highest = {}
    for (a, _), n in counts.items():
        highest[a] = max(highest.get(a, 0), n)
    rows = []
    for groups, links in found:
        named = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        rows.append((sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups),
                     len(links), sum(counts[p] == highest[p[0]] for p in links),
                     sum(counts[p] for p in links),
                     hashlib.sha256(named.encode()).hexdigest() if named else ""))
    return rows


def random_texts(n, seed):
    rnd = random.Random(seed)
    alphabet = ["a", "the", " ", " ", " ", "  ", "\n", "é", "中", ".", "'s", "9", "▁", "\t", " ", "　",
                "ing", "Ab", "\x00", "👍", "\x7f", "\x85"]
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(n)]


def compare(spark, texts):
    docs = spark.createDataFrame([(k if k % 7 else None, t, 1.0, "x") for k, t in enumerate(texts)],
                                 "doc_id bigint, text string, n_a double, row string")
    got = tokenalign.alignment(docs.repartition(3), A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                           "groups_sha256"]
    rows = [tuple(r) for r in got.collect()]
    want = [(k if k % 7 else None, *r[:6], r[6]) for k, r in enumerate(plain_alignment(texts))]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    assert sorted(rows, key=key) == sorted(want, key=key)


def test_alignment_equals_a_plain_walk(spark):
    stored = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
              .orderBy("doc_id").collect()]
    compare(spark, ODD + ODD[:9] + random_texts(150, 3) + stored[:80])


@pytest.mark.parametrize("frequent", [1, 50])
def test_rare_pairs_are_joined(spark, monkeypatch, frequent):
    monkeypatch.setattr(tokenalign, "FREQUENT", frequent)
    compare(spark, ODD + random_texts(60, 4))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert tokenalign.alignment(docs, A, B).count() == 0


def test_blocks_and_strings_of_any_size(spark, monkeypatch):
    texts = ODD + random_texts(40, 5)
    pair = tokenalign.Pair(A, B)
    data = [(t or "").encode() for t in texts]
    arrays = np.frombuffer(b"".join(data), np.uint8), np.cumsum([0] + [len(d) for d in data])
    want = tokenalign.block(pair, *arrays, digests=True)
    for size in (1, 40, 1 << 20):
        monkeypatch.setattr(tokenalign, "STRING_BYTES", size)
        got = tokenalign.block(pair, *arrays, digests=True)
        assert np.array_equal(got.counts, want.counts) and got.digests == want.digests
    pair.by_chunk = False
    whole = tokenalign.block(pair, *arrays, digests=True)
    assert np.array_equal(whole.counts, want.counts) and whole.digests == want.digests
    assert "op12_token_alignment" in queries.QUERIES
