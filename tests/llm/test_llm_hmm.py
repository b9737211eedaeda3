"""Hidden Markov scores against sums over all paths and plain counts."""

import itertools
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from palaver.llm import hmm, queries
from palaver.llm.common import crc_remainder

WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id bigint, text string, row string, training int"


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def is_training(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 != 2


def plain_base(rows):
    """n_tokens, n_known, N and base score of every row."""
    counts = Counter(w for i, t in rows if is_training(i) for w in [*plain_words(t), None])
    n, v = sum(counts.values()), len(counts)
    found = []
    for _, text in rows:
        words = [*plain_words(text), None]
        found.append((len(words), sum(counts[w] > 0 for w in words), n,
                      sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)))
    return found


def random_model(rnd, states, classes):
    draw = lambda *shape: rnd.random(shape) + 0.05
    start, move, emit = draw(states), draw(states, states), draw(classes, states)
    return hmm.Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def all_paths(model, sequence):
    """Likelihood of a sequence and its expected counts, by going through all paths."""
    n = len(model.start)
    total, counts = 0.0, np.zeros((1 + n + len(model.emit), n))
    for path in itertools.product(range(n), repeat=len(sequence)):
        p = model.start[path[0]]
        for k, (state, c) in enumerate(zip(path, sequence)):
            p *= model.emit[c, state] * (model.move[path[k - 1], state] if k else 1)
        total += p
        counts[0, path[0]] += p
        for x, y in zip(path, path[1:]):
            counts[1 + x, y] += p
        for state, c in zip(path, sequence):
            counts[1 + n + c, state] += p
    return total, counts / total


@pytest.mark.parametrize("states", [1, 2, 3])
def test_recursions_equal_sums_over_all_paths(states):
    rnd = np.random.default_rng(states)
    model = random_model(rnd, states, 5)
    sequences = [rnd.integers(0, 5, rnd.integers(1, 7)) for _ in range(25)]
    flat = np.concatenate(sequences).astype("<u2")
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sequences])])
    want = [all_paths(model, s) for s in sequences]
    assert np.allclose(model.log10(flat, offsets), [math.log10(p) for p, _ in want], atol=1e-12)
    assert np.allclose(model.expect(flat, offsets), sum(c for _, c in want), rtol=1e-4, atol=1e-4)


def test_blocks_take_bounded_memory():
    rnd = np.random.default_rng(2)
    letters = np.frombuffer(b"abcdefghijklmno  ", np.uint8)
    data = letters[rnd.integers(0, len(letters), hmm.BLOCK_BYTES)]
    classes = rnd.integers(0, 50, hmm.BLOCK_TOKENS).astype("<u2")
    model = random_model(rnd, hmm.STATES, 50)
    offsets = np.arange(0, len(data) + 1, 1 << 12)
    places = np.arange(0, len(classes) + 1, 1 << 7)
    for work, limit in ((lambda: hmm.words_of(data, offsets), 60 << 20),
                        (lambda: model.expect(classes, places), 150 << 20)):
        tracemalloc.start()
        work()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < limit


def test_rounds_raise_the_likelihood(monkeypatch):
    monkeypatch.setattr(hmm, "PRIOR", 0.0)
    rnd = np.random.default_rng(4)
    true = random_model(rnd, 3, 12)
    sequences = []
    for _ in range(60):
        state, s = rnd.choice(3, p=true.start), []
        for _ in range(30):
            s.append(rnd.choice(12, p=true.emit[:, state]))
            state = rnd.choice(3, p=true.move[state])
        sequences.append(s)
    flat = np.array(sum(sequences, []), "<u2")
    offsets = np.arange(0, 60 * 30 + 1, 30)
    shares = np.bincount(flat, minlength=12) / len(flat)
    model, before = hmm.Model.first(shares, 3), -np.inf
    for _ in range(12):
        total = model.log10(flat, offsets).sum()
        assert total > before - 0.05
        before, model = total, model.update(model.expect(flat, offsets), shares)


def test_words_and_shapes():
    texts = ["Ab ab\tAB é", "", "  ", "x" * 4000 + " É x"]
    data = [t.encode() for t in texts]
    text, code, words = hmm.words_of(np.frombuffer(b"".join(data), np.uint8),
                                     np.cumsum([0] + [len(d) for d in data]))
    words = words.to_pylist()
    for k, t in enumerate(texts):
        assert [words[c].decode() for c, d in zip(code, text) if d == k] == plain_words(t)
    some = [b"a", b"ab", b"xxabc", b"yyabc", b"zabc", "né".encode(), b"a" * 20 + b"abc", b"b" * 30 + b"abc"]
    got = hmm.shapes(pa.array(some, pa.large_binary()))
    assert got[2] == got[3] and got[6] == got[7] and len(set(got[[0, 1, 2, 4, 5, 6]])) == 6
    assert list(hmm.shapes(pa.array(some[3:5], pa.large_binary()))) == list(got[3:5])


def some_rows():
    rnd = random.Random(8)
    words = ["the", "The", "of", "and", "é", "x1", "naïve", "a-b", "zz"] + [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(rnd.choice(words[:rnd.choice([4, 12, 69])]) for _ in range(rnd.randint(0, 40))))
            for k in range(150)]
    rows += [(None, None), (None, ""), (None, "the lone"), (3, "again the"), (3, "again the"), (900, None),
             (901, " \n\t"), (902, "new " * 3000), (903, "\x00 \x1c a　b"), (904, "y" * 20_000)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA).repartition(3)


def scored(spark, rows):
    got = hmm.scores(frame(spark, rows), crc_remainder("doc_id", 7) != 2)
    assert got.columns == ["doc_id", "training", "n_tokens", "n_known", "train_tokens", "base_score",
                           "score"]
    return got.collect()


KEY = lambda r: (r[0] is not None, r[0] or 0, *r[1:3], round(r[3], 6))


@pytest.mark.parametrize("own, known", [(1 << 13, 1 << 17), (8, 20), (1, 1)])
def test_scores_equal_plain_sums(spark, monkeypatch, own, known):
    """Counts and base by plain sums; the model's score from a fixed model by plain recursion."""
    monkeypatch.setattr(hmm, "OWN", own)
    monkeypatch.setattr(hmm, "KNOWN", known)
    rows, seen = some_rows(), []
    fixed = {}

    def keep(sequences, shares, states):
        seen.extend(sequences.select("id", "classes").collect())
        fixed["model"] = random_model(np.random.default_rng(1), 2, len(shares))
        return fixed["model"]

    monkeypatch.setattr(hmm, "train", keep)
    got = scored(spark, rows)
    base = plain_base(rows)
    flat = [(r.doc_id, r.n_tokens, r.n_known, r.base_score, r.train_tokens, r.training) for r in got]
    want = [(i, *b[:2], b[3], b[2], is_training(i)) for (i, _), b in zip(rows, base)]
    for x, y in zip(sorted(flat, key=KEY), sorted(want, key=KEY)):
        assert x[:3] == y[:3] and x[4:] == y[4:] and math.isclose(x[3], y[3], abs_tol=1e-8)

    # Words by share of all tokens; a word without a class of its own shares that of its shape.
    every = Counter(w for _, t in rows for w in plain_words(t))
    train = Counter(w for i, t in rows if is_training(i) for w in plain_words(t))
    total = sum(every.values()) + len(rows)
    with_own = sorted((w for w in every if every[w] * own >= total), key=str.encode)
    if known < own:
        with_own = [w for w in with_own if every[w] * known >= total]
    rest = [w for w in every if w not in set(with_own)]
    shape = dict(zip(rest, hmm.shapes(pa.array([w.encode() for w in rest], pa.large_binary()))))
    tokens, kinds = Counter(), Counter()
    for w in rest:
        tokens[shape[w]] += train[w]
        kinds[shape[w]] += train[w] > 0
    model = fixed["model"]
    expected = []
    for i, t in rows:
        words = plain_words(t)
        classes = [1 + with_own.index(w) if w not in shape else 1 + len(with_own) + shape[w]
                   for w in words] + [0]
        state, likely = None, 0.0
        for c in classes:
            state = (model.start if state is None else state @ model.move) * model.emit[c]
            likely += math.log10(state.sum())
            state = state / state.sum()
        likely += sum(math.log10((train[w] + 1) / (tokens[shape[w]] + kinds[shape[w]] + 1))
                      for w in words if w in shape)
        expected.append((i, len(words) + 1, 0, likely))
    mine = sorted(((r.doc_id, r.n_tokens, 0, r.score) for r in got), key=KEY)
    for x, y in zip(mine, sorted(expected, key=KEY)):
        assert x[:2] == y[:2] and math.isclose(x[3], y[3], rel_tol=1e-9, abs_tol=1e-7)


def test_training_equals_rounds_in_memory(spark, monkeypatch):
    monkeypatch.setattr(hmm, "SEED_ROWS", 5)
    rnd = np.random.default_rng(2)
    sequences = [rnd.integers(0, 9, rnd.integers(1, 30)).astype("<u2") for _ in range(40)]
    shares = np.full(9, 1 / 9)
    table = spark.createDataFrame([(k, k % 4 != 0, bytearray(s.tobytes())) for k, s in enumerate(sequences)],
                                  "row long, training boolean, classes binary")
    got = hmm.train(table.repartition(5), shares, 2)
    chosen = table.where("training").select("row", F.xxhash64("classes", "row").alias("h")).orderBy("h")
    seed = [sequences[r.row] for r in chosen.limit(5).collect()]
    model = hmm.Model.first(shares, 2)
    for rows in [seed] * hmm.SEED_STEPS + [[s for k, s in enumerate(sequences) if k % 4]] * hmm.STEPS:
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in rows])])
        model = model.update(model.expect(np.concatenate(rows), offsets), shares)
    for x, y in ((got.start, model.start), (got.move, model.move), (got.emit, model.emit)):
        assert np.allclose(x, y, rtol=1e-3, atol=1e-6)


def test_empty_tables_and_no_training(spark):
    assert scored(spark, []) == []
    only = next(i for i in range(100) if not is_training(i))
    row, = scored(spark, [(only, "a b")])
    assert (row.training, row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (False, 3, 0, 0, 0.0)


def test_held_out_texts_are_likelier_than_by_counts(spark):
    rows = queries.QUERIES["op11_hmm_scores"](spark, "/root/testdata/sf0.01").collect()
    held_out = [r for r in rows if r.held_out and r.n_tokens > 1]
    assert len(rows) == 1000 and len(held_out) > 100
    assert sum(r.score for r in held_out) > sum(r.base_score for r in held_out)
