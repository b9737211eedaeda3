"""Operators that look at each text by itself, against plain readings."""

import hashlib
import random
import re

import llm_brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from palaver.llm import bpe, licenses, queries, repair, repetition, toxicity
from palaver.llm.common import ALNUM, LOWER, Words, grams, slices

PATH = public_tokenizers.path(queries.WORD_BPE)
SCHEMA = "doc_id bigint, text string"


def arrays(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.cumsum([0] + [len(d) for d in data])


def random_texts(alphabet, n, size, seed=5):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, size))) for _ in range(n)]


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    return [(r.doc_id, r.text) for r in rows.collect()]


@pytest.fixture(scope="module")
def odd_rows(spark, documents):
    """Documents, NULLs, empty, very long and repeated texts, and columns with taken names."""
    rows = documents[:60] + [(None, None), (None, "a b"), (1, None), (7001, ""), (7002, " \n\t"),
                             (7003, "word " * 30_000), (7003, "word " * 30_000), (7004, "é" * 9000)]
    return spark.createDataFrame([(i, t, "x", 1.5) for i, t in rows],
                                 SCHEMA + ", __words string, score double")


def test_words_are_those_of_the_pattern():
    texts = random_texts(["a", "B", "é", " ", "\n", "-", "0", "　", "\x0b", "_"], 300, 60)
    data, offsets = arrays(texts)
    spaced, plain = Words(data, offsets), Words(data, offsets, ALNUM, LOWER)
    for k, text in enumerate(texts):
        assert spaced.counts[k] == len(llm_brute.WORD.findall(text))
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        assert plain.counts[k] == len(re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low))
    known = {}
    for k in range(len(spaced.hashes)):
        word = data[spaced.starts[k]:spaced.ends[k]].tobytes()
        assert known.setdefault(word, spaced.hashes[k]) == spaced.hashes[k]
    assert len(set(known.values())) == len(known)
    at, _ = grams(spaced, 5)
    assert len(at) == sum(max(0, c - 4) for c in spaced.counts)


def test_slices_hold_whole_texts():
    texts = [b"", b"abc" * 50, b"", b"x", b"y" * 500, b""]
    column = pa.array([b"skip", *texts], pa.binary()).slice(1)
    seen = []
    for row, end, data, offsets in slices(column, 100):
        seen += [data[a:b].tobytes() for a, b in zip(offsets, offsets[1:])]
        assert len(offsets) == end - row + 1
    assert seen == texts


ODD = ["<|endoftext|>a<|startoftext|> b<|endoftext|><|endoftext|>", "ΑΣ İI x́ ISN'T 123 a__b c\x1cd",
       "", "   ", "g é ́e ﬁ ½²", "<|ENDOFTEXT|>", "a" * 3000, "日本語テキスト👍🏽", " x'S'll", "Ab!!, c.d"]


@pytest.mark.parametrize("encode", ["queue", "library"])
def test_tokens_equal_the_library(documents, encode):
    texts = ODD + random_texts(
        ["a", "B", " ", "\n", "é", "e", "́", "Σ", "ß", "'", "s", "1", "_", "!", ".", "中", "﻿", "İ",
         "\x00", "<|endoftext|>"], 400, 40) + [t for _, t in documents[:40]]
    library = Tokenizer.from_file(PATH)
    data = [t.encode() for t in texts]
    if encode == "queue":
        own = bpe.Bpe(PATH)
        ids, at = own.encode(*arrays(texts))
        spelled, place = own.spell(ids)
        found = [(ids[x:y].tobytes(), bytes(spelled[place[x]:max(place[y] - 1, place[x])]))
                 for x, y in zip(at, at[1:])]
    else:
        found = [(i.tobytes(), None) for i in repair.Encoder(PATH).encode(data)]
    for text, (ids, decoded) in zip(texts, found):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        if decoded is not None:
            assert decoded.decode() == library.decode(want, skip_special_tokens=False)


def test_memo_of_chunks_is_asked_once_for_each():
    asked = []

    class Asked(dict):
        def __getitem__(self, key):
            asked.append(key)
            return super().__getitem__(key)

    own, texts = repair.Encoder(PATH), ["Haus, haus HAUS. 7a! ?! " * 50, "", "haus", "Haus"]
    own.memo = Asked()
    library = Tokenizer.from_file(PATH)
    for text, ids in zip(texts, own.encode([t.encode() for t in texts]), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert sorted(asked) == [b",", b".", b"7a!", b"?!", b"haus"]
    assert own.encode([]) == []


def test_memo_of_pieces_is_bounded_by_bytes():
    memo = bpe._Memo(lambda key: (key,) * 10, 20_000)
    for _ in range(2):
        for k in range(3000):
            assert memo[f"piece{k}"] == (f"piece{k}",) * 10
            assert memo["often"] == ("often",) * 10
    assert memo.weight <= 20_000 and len(memo) + len(memo.older) < 200 and "often" in memo
    own = bpe.Bpe(PATH)
    own.pieces.limit = 5_000
    texts = random_texts(["a", "b", "c", " "], 200, 60)
    ids, at = own.encode(*arrays(texts))
    want, _ = bpe.load(PATH).encode(*arrays(texts))
    assert np.array_equal(ids, want) and len(own.pieces) < 60


def test_with_tokens_over_odd_rows(odd_rows):
    got = bpe.with_tokens(odd_rows, PATH, outputs=("n_tokens", "ids", "decoded", "ids_sha256"))
    assert got.columns == ["doc_id", "text", "__words", "score", "n_tokens", "ids", "decoded",
                           "ids_sha256"]
    rows = got.collect()
    assert len(rows) == odd_rows.count()
    for r in rows:
        assert r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()
        if not (r.text or "").strip():
            assert (r.ids, r.decoded) == ([], "")


def test_quality_measures():
    texts = ["", " ", "a b c d e f g h i j a b c d e f g h i j a b c d e", "x\n\nx\n \n \nx y\r\nx y",
             "é" * 10 + " " + "é " * 30, "a " * 50]
    texts += random_texts(["a", "b", "é", " ", " ", "\n", "#", " c", "\x0b", "　"], 300, 250)
    got = repetition.measure(*arrays(texts), repetition.Limits())
    for k, text in enumerate(texts):
        want = llm_brute.quality(text)
        assert tuple(int(column[k]) for column in got[:6]) == want[:6], text
        assert bool(got[7][k]) == want[6]


def test_quality_verdict(odd_rows, spark):
    rows = repetition.judge(odd_rows).collect()
    assert len(rows) == odd_rows.count()
    assert not [r for r in rows if r.kept and (r.base_failed or r.n_words < 10)]
    prose = " ".join(f"w{i}" for i in range(900))
    long_repeat = prose + " " + " ".join(f"w{i}" for i in range(110)) + prose.replace("w", "v")
    made = spark.createDataFrame([(1, prose), (2, long_repeat)], SCHEMA)
    kept = {r.doc_id: (r.kept, r.base_failed, r.longest_repeat)
            for r in repetition.judge(made).collect()}
    # 109 words stand twice: the base rules pass, the longest repeat does not.
    assert kept == {1: (True, False, 0), 2: (False, False, 109)}


def test_license_base_places(documents, spark):
    phrases = {p.split()[0]: p.split() for p in licenses.BASE}
    texts = [(i, t) for i, t in documents] + [
        (9001, "Under the MIT-license; under the mit license. CC BY-NC 4.0"),
        (9002, "apache license version 2"), (9003, "under the mit"), (9004, "license under the mit")]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(texts, SCHEMA)).collect()}
    for i, text in texts:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
        at = [k for p in phrases.values() for k in range(len(words)) if words[k:k + len(p)] == p]
        r = got[i]
        assert (r.n_words, r.n_base) == (len(words), len(at))
        assert (r.first_word, r.last_word) == ((min(at), max(at)) if at else (None, None))
        assert 0 <= r.score <= 1
    assert got[9001].base_labels == "cc-by-nc,mit"


def test_license_templates(spark):
    made = [(1, "x y " + licenses.TEMPLATES[0].text + " and more"),
            (2, licenses.TEMPLATES[5].text.replace("permitted", "allowed")),
            (3, licenses.TEMPLATES[5].text.replace("binary", "object")),
            (4, "this software is free and public"), (5, None), (6, "")]
    got = {r.doc_id: r.labels for r in licenses.scan(spark.createDataFrame(made, SCHEMA)).collect()}
    # A changed word between the key phrases is tolerated, one within them is not.
    assert got == {1: "mit", 2: "bsd", 3: "", 4: "", 5: "", 6: ""}


def test_license_over_odd_and_no_rows(odd_rows, spark):
    assert licenses.scan(odd_rows).count() == odd_rows.count()
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.fixture(scope="module")
def insults(spark):
    rnd = random.Random(3)
    rows, labels = [], []
    for i in range(1500):
        bad = rnd.random() < 0.2
        words = [f"w{rnd.randint(0, 400)}" for _ in range(rnd.randint(5, 60))]
        if bad:
            words[rnd.randrange(len(words))] = rnd.choice(["vile", "rotten", "nasty"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return (spark.createDataFrame(rows, SCHEMA),
            spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id bigint, toxic int"))


def test_toxicity_learns_from_allowed_rows(insults):
    from pyspark.sql import functions as F
    docs, labels = insults
    allowed = F.col("doc_id") % 3 != 0
    rows = toxicity.training_rows(docs.withColumn("label", F.lit("x")), labels, allowed, "doc_id",
                                  "text", "toxic", 700)
    assert rows.count() == 700
    model = toxicity.train(rows)
    assert len(model.places) < 2000
    scored = toxicity.with_scores(docs, model, keep=["doc_id"]).where(~allowed)
    truth = {r.doc_id: r.toxic for r in labels.where("doc_id is not null").collect()
             if r.toxic is not None}
    wrong = [r for r in scored.collect() if truth.get(r.doc_id) != r.predicted]
    assert len(wrong) <= 10


def test_toxicity_without_labels(odd_rows, spark):
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    from pyspark.sql import functions as F
    model = toxicity.train(toxicity.training_rows(odd_rows, labels, F.lit(True), "doc_id", "text",
                                                  "toxic", 10))
    got = toxicity.with_scores(odd_rows, model).collect()
    assert len(got) == odd_rows.count()
    assert {(round(r.score, 4), r.predicted) for r in got} == {(0.0474, 0)}
