"""Operators that compare texts or write files, against plain readings."""

import base64
import gzip
import hashlib
import json
import random
import zlib
from itertools import combinations
from urllib.parse import urlparse

import llm_brute
import numpy as np
import public_tokenizers
import pytest
from pyarrow import fs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from palaver.llm import bagminhash, components, queries, repair, spacedseed, suffixdedup, urlrules
from palaver.llm import warc
from palaver.llm.common import sifted

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string"
PATH = public_tokenizers.path(queries.WORD_BPE)


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return sorted((r.doc_id, r.text) for r in rows)


# ---------------------------------------------------------------- WARC

@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    rows = [(1, "http://a/é x", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "u", ""),
            (None, "n", "<p>é</p>"), (5, "u", "x" * 300_000), (6, "v", "\r\n\r\nWARC/1.1\r\n"),
            (7, "w", "same"), (7, "w", "same"), (7, "w2", "same"), (None, None, None)]
    path = str(tmp_path_factory.mktemp("pages") / "pages.parquet")
    made = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    made.withColumn("digest", F.lit("taken")).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def test_warc_round_trip(pages, spark):
    index = warc.archived(pages)
    got = warc.read(index).collect()
    assert len(got) == pages.count() == index.count()
    by_payload = {}
    for r in pages.collect():
        by_payload.setdefault((r.html or "").encode(), []).append(r.page_id)
    digests = {base64.b32encode(hashlib.sha1(p).digest()).decode(): p for p in by_payload}
    for payload, ids in by_payload.items():
        same = [r for r in got if digests[r.payload_digest] == payload]
        assert sorted(str(r.page_id) for r in same) == sorted(map(str, ids))
        (first,) = [r for r in same if r.record_type == "response"]
        largest = max((i for i in ids if i is not None), default=None)
        assert first.page_id == largest and first.payload == payload and first.refers_to is None
        for r in same:
            assert r.payload_bytes == len(payload)
            assert r is first or (r.record_type, r.refers_to) == ("revisit", largest)
    assert {r.url for r in got if r.page_id == 1} == {"http://a/%C3%A9%20x"}


def test_warc_small_payloads_are_all_responses(pages):
    roles = warc.with_roles(pages, min_bytes=9).collect()
    assert {r.n_bytes for r in roles if r.n_bytes < 9} == {0, 4}
    assert all(r.refers_to is None for r in roles if r.n_bytes < 9)
    assert sum(r.refers_to is not None for r in roles) == 2


def test_warc_files(pages, spark):
    folder = warc.shared_folder(spark, "warc-test")
    archives = warc.write(warc.with_roles(pages), f"{folder}/streams")
    whole = b""
    for r in archives.collect():
        store, local = fs.FileSystem.from_uri(r.path)
        data = store.open_input_file(local).read()
        unpacker = zlib.decompressobj(31)
        whole += unpacker.decompress(data)
        assert unpacker.eof and not unpacker.unused_data
    index = warc.normalise(archives, f"{folder}/records")
    for path in {r.path for r in index.select("path").collect()}:
        store, local = fs.FileSystem.from_uri(path)
        data = store.open_input_file(local).read()
        sidecar = [json.loads(x) for x in store.open_input_file(f"{local}.idx").read().splitlines()]
        assert sum(e["length"] for e in sidecar) == len(data)
        for e in sidecar:
            record = gzip.decompress(data[e["place"]:e["place"] + e["length"]])
            assert record.startswith(b"WARC/1.1\r\n") and record in whole


def test_warc_no_rows(pages):
    assert warc.read(warc.archived(pages.where("page_id = 99"))).count() == 0


# ---------------------------------------------------------------- URL rules

def test_url_parts_and_list(spark):
    urls = ["http://A.Example.com/en/1?x#y", "https://www.example.com/en/", "ftp://x.net/es/", None,
            "no scheme/en/", "http://example.com", "http://example.com?q=/en/", "http://É.NET/fr/ü",
            "http://notexample.com/en/", "://com/", "http://example.com/en", "a://b://c/d", "http://",
            "http://net/es/1\n2?z"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)],
                                  "page_id bigint, url string")
    labels = spark.createDataFrame([], "page_id bigint, verdict string")
    got = {r.page_id: r for r in urlrules.judge(pages, labels).collect()}
    assert len(got) == len(urls)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, url in enumerate(urls):
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
            host, path = rest[:cut].translate(lower), rest[cut:].split("?")[0].split("#")[0]
        assert (got[i].host, got[i].path) == (host, path), url
        fits = [(h + p, v) for h, p, v in urlrules.RULES
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda f: len(f[0]), default=(None, "allow"))
        assert (got[i].rule, got[i].verdict) == (rule, verdict), url


def test_url_rules_are_mined(spark):
    rnd = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        spam = rnd.random() < 0.3
        host = rnd.choice(["spam.org", "casino.org"]) if spam else f"site{rnd.randint(0, 30)}.org"
        rows.append((i, f"https://{host}/{rnd.choice(['a', 'b'])}/{i}?k={i}"))
        if i % 2:
            labels.append((i, "block" if spam else "allow"))
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    got = urlrules.judge(pages, spark.createDataFrame(labels, "page_id bigint, verdict string"))
    for r in got.collect():
        assert r.rule is None
        assert r.verdict == ("block" if r.host in ("spam.org", "casino.org") else "allow"), r
        assert urlparse(rows[r.page_id][1]).netloc == r.host


def test_mined_rules_equal_a_plain_enumeration(spark):
    rnd = random.Random(4)
    rows = []
    for _ in range(80):
        tokens = {t for t in "abcdefg" if rnd.random() < 0.4}
        tokens |= {"h"} if "a" in tokens else set()  # always together with a
        label = "block" if "b" in tokens and rnd.random() < 0.95 or rnd.random() < 0.1 else "allow"
        rows.append((sorted(tokens), label))
    labelled = spark.createDataFrame(rows, "tokens array<string>, verdict string").repartition(3)
    got = {(tuple(sorted(r.antecedent)), r.verdict): (r.confidence, r.support) for r in
           urlrules.mined_rules(labelled, 0.1, 0.7, 5).collect()}
    want = {}
    for size in range(1, 8):
        for chosen in combinations("abcdefg", size):
            fitting = [v for t, v in rows if set(chosen) <= set(t)]
            for verdict in ("allow", "block"):
                n = fitting.count(verdict)
                if n >= 8 and n / len(fitting) >= 0.7:
                    want[chosen, verdict] = n / len(fitting), n / 80
    assert len(want) > 5 and got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_long_urls_end(spark):
    """One URL of 40 segments, and a host whose URLs have 30 constant parts."""
    parts = "/".join(f"p{chr(97 + k // 10)}{chr(97 + k % 10)}" for k in range(30))
    segments = "/".join(f"s{chr(97 + k // 10)}{chr(97 + k % 10)}" for k in range(40))
    rows = [(0, f"http://one.org/{segments}")]
    rows += [(k, f"http://many.org/{parts}/{k}?x={k}") for k in range(1, 60)]
    rows += [(k, f"http://other{k}.org/") for k in range(60, 100)]
    pages = spark.createDataFrame(rows + [(200, f"http://many.org/{parts}")], "page_id bigint, url string")
    labels = spark.createDataFrame([(k, "block" if 0 < k < 60 else "allow") for k in range(100)],
                                   "page_id bigint, verdict string")
    got = {r.page_id: r.verdict for r in urlrules.judge(pages, labels).collect()}
    assert got[0] == "allow" and got[30] == got[200] == "block" and got[99] == "allow"


# ---------------------------------------------------------------- suffix-array dedup

def check_repeats(spark, rows, **sizes):
    """rows: (doc_id, text), ids without repeats."""
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("spans", F.lit(3)).repartition(3)
    got = suffixdedup.deduplicated(docs, keep=["doc_id"], outputs=(
        "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"), **sizes)
    got = {r.doc_id: r for r in got.collect()}
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    want = llm_brute.repeats([(i, (t or "").encode()) for i, t in ordered])
    assert len(got) == len(rows)
    for key, *values, kept in want:
        r = got[key]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == tuple(values), key
        assert bytes(r.kept) == kept and len(r.spans) == r.n_spans


def passages(seed, n, alphabet="abcd ", size=900):
    rnd = random.Random(seed)
    pool = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(60, 260))) for _ in range(12)]
    rows = []
    for i in range(n):
        parts = [rnd.choice(pool) if rnd.random() < 0.6 else
                 "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 200)))
                 for _ in range(rnd.randint(0, size // 150))]
        rows.append((i * 7 - 30, "".join(parts)))
    return rows


@pytest.mark.parametrize("seed,alphabet", [(1, "abcd "), (2, "é日x"), (3, "ab")])
def test_repeats_equal_brute_force(spark, seed, alphabet):
    rows = passages(seed, 60, alphabet)
    rows += [(10_001, "a" * 450), (10_002, "ab" * 300), (10_003, "a" * 99), (10_004, "a" * 100),
             (10_005, ""), (10_006, None), (None, rows[3][1] + "tail")]
    check_repeats(spark, rows)


def test_repeats_of_hot_cores_in_chunks(spark):
    rnd = random.Random(9)
    core = "the very same passage of text that stands in a great many of the documents here, word by word"
    rows = [(5000 + i, "".join(rnd.choice("xyz") for _ in range(rnd.randint(0, 90))) + core[:rnd.randint(60, 94)]
             + "".join(rnd.choice("xyz") for _ in range(rnd.randint(0, 90)))) for i in range(150)]
    check_repeats(spark, rows + passages(4, 20), chunk_size=4, held_rows=40)


def test_repeated_rows_and_ids(spark):
    rnd = random.Random(2)
    text = "".join(rnd.choice("abcdefgh ") for _ in range(400))
    other = text[100:] + "!" * 20
    rows = [(5, text), (5, text), (5, other), (6, text), (6, "short"), (6, "short")]
    got = suffixdedup.deduplicated(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 6
    left = sorted((r.doc_id, r.n_bytes, r.n_bytes - r.n_removed) for r in got)
    first_whole = [(5, 320, 20), (5, 400, 0), (5, 400, 400)]
    first_other = [(5, 320, 320), (5, 400, 0), (5, 400, 100)]
    assert left[:3] in (first_whole, first_other)
    assert left[3:] == [(6, 5, 5), (6, 5, 5), (6, 400, 0)]


def test_texts_of_one_id_and_checksum_are_not_copies(spark):
    """Two texts of 160 bytes with equal crc32, and many short rows without an id."""
    rnd = random.Random(9)
    first = bytes(rnd.choice(b"abcdefghij") for _ in range(160))
    other = bytearray(rnd.choice(b"klmnopqrst") for _ in range(156)) + b"\0\0\0\0"
    table = []
    for n in range(256):
        for _ in range(8):
            n = n >> 1 ^ 0xEDB88320 if n & 1 else n >> 1
        table.append(n)
    want, have = zlib.crc32(first) ^ 0xFFFFFFFF, zlib.crc32(bytes(other[:156])) ^ 0xFFFFFFFF
    back = want
    for _ in range(4):
        k = next(i for i in range(256) if table[i] >> 24 == back >> 24)
        back = ((back ^ table[k]) << 8 | k) & 0xFFFFFFFF
    other[156:] = (back ^ have).to_bytes(4, "little")
    assert zlib.crc32(first) == zlib.crc32(bytes(other))
    rows = [(None, first), (None, bytes(other)), (5, first[:99])] + [(None, b"")] * 50 + [(None, None)]
    docs = spark.createDataFrame([(i, None if t is None else bytearray(t)) for i, t in rows],
                                 "doc_id bigint, text binary")
    got = suffixdedup.deduplicated(docs, outputs=("n_bytes", "n_removed")).collect()
    assert len(got) == len(rows) and sum(r.n_removed for r in got) == 0
    again = suffixdedup.deduplicated(docs.union(docs), outputs=("n_bytes", "n_removed")).collect()
    assert sum(r.n_removed for r in again) == 320


@pytest.mark.parametrize("n, kinds, groups", [(0, 2, 1), (1, 2, 1), (500, 2, 1), (3000, 3, 40), (3000, 1 << 60, 7)])
def test_multikey_quicksort(n, kinds, groups):
    rng = np.random.default_rng(n)
    words = rng.integers(0, kinds, (n, 6)).astype(np.uint64) << np.uint64(3)
    group = rng.integers(0, groups, n)
    want = np.lexsort((*words.T[::-1], group))
    assert np.array_equal(suffixdedup.multikey_quicksort(words, group), want)


def test_blind_trie_sorts():
    rnd = np.random.default_rng(4)
    strings = rnd.integers(0, 3, (400, 40)).astype(np.uint8)
    strings[100:200] = strings[:100]
    strings[200:300, :35] = strings[:100, :35]
    group = np.sort(rnd.integers(0, 5, 400))
    strings[:, :8] = 1
    order = suffixdedup.deep_shallow(group, strings, 8)
    keys = [(int(group[i]), strings[i].tobytes()) for i in order]
    assert keys == sorted(keys)


# ---------------------------------------------------------------- near duplicates

def edited(rnd, words, n):
    words = list(words)
    for _ in range(n):
        words[rnd.randrange(len(words))] = f"edit{rnd.randint(0, 10 ** 6)}"
    return words


def test_classes_equal_brute_force(spark, documents):
    rnd = random.Random(6)
    docs = dict(documents)
    base = [f"w{rnd.randint(0, 5000)}" for _ in range(300)]
    for k in range(40):
        docs[20_000 + k] = " ".join(edited(rnd, base, rnd.randint(0, 8)))
    for k in range(30):
        other = [f"w{rnd.randint(0, 5000)}" for _ in range(40)]
        docs[21_000 + 2 * k] = " ".join(other)
        docs[21_001 + 2 * k] = " ".join(edited(rnd, other, 1))
    docs |= {30_000: "one two", 30_001: "one  two\n", 30_002: "", 30_003: " ", 30_004: "x " * 500,
             30_005: "x " * 480, 30_006: "x " * 200}
    rows = spark.createDataFrame(list(docs.items()) + [(None, "one two")], SCHEMA).repartition(4)
    got = {r.doc_id: r.class_id for r in bagminhash.classes(rows).collect()}
    assert got == llm_brute.classes(docs)


def test_large_buckets_lose_no_link(spark, monkeypatch):
    """Blocks of a bucket join what pairs verified one by one join, with fewer links than members."""
    rng = np.random.default_rng(3)
    n, size = 400, bagminhash.REGISTERS
    weight = 12 * 100 + 8 * bagminhash.BANDS + size
    monkeypatch.setattr(bagminhash, "BLOCK", 64 * weight)
    common = [np.sort(rng.integers(0, 1 << 62, 100)).astype(np.uint64) for _ in range(4)]
    bags, sketch = [], rng.integers(0, 256, (n, size)).astype(np.uint8)
    lead = [np.flatnonzero(np.arange(n) % 4 == k)[0] for k in range(4)]
    for k in range(n):
        kept = rng.random(100) < rng.choice((0.85, 0.92, 0.97))
        h = np.where(kept, common[k % 4], rng.integers(0, 1 << 62, 100).astype(np.uint64))
        bags.append((np.sort(h), np.ones(100, np.int64)))
        same = rng.random(size) < rng.choice((0.6, 0.8, 0.95))
        sketch[k, same] = sketch[lead[k % 4], same]
    component = np.where(np.arange(n) < 150, 0, np.arange(n))
    # All share the band 7, and every third one the band 8; no other band is common.
    bands = 1000 + np.arange(n * bagminhash.BANDS).reshape(n, -1)
    bands[:, 0], bands[::3, 1] = 7, 8
    placed = [(7, k, int(component[k]), weight) for k in range(n)]
    placed += [(8, k, int(component[k]), weight) for k in range(0, n, 3)]
    agree = (sketch[:, None] == sketch).sum(2)
    links = [(0, k) for k in range(150)]
    for x, y in zip(*np.nonzero(agree >= bagminhash.LIKELY * size)):
        if x < y and component[x] != component[y] and bagminhash.overlap(bags[x], bags[y]) >= 0.8:
            links.append((int(x), int(y)))
    assert len(links) > 600
    dealt = bagminhash._dealt(spark.createDataFrame(
        placed, "bucket bigint, id bigint, component bigint, weight bigint"))
    held = spark.createDataFrame(
        [(k, sketch[k].tobytes(), bands[k].tolist(), h.tobytes() + c.astype(np.uint32).tobytes())
         for k, (h, c) in enumerate(bags)], "id bigint, sketch binary, bands array<bigint>, bag binary")
    active = bagminhash._active(dealt, held.drop("bag"))
    likely = {(int(x), int(y)) for x, y in zip(*np.nonzero(agree >= bagminhash.LIKELY * size))
              if x < y and component[x] != component[y]}
    assert {r.id for r in active.collect()} == {k for pair in likely for k in pair}
    assert active.count() < dealt.count()
    got = bagminhash._links_of_blocks(active.join(held, "id")).collect()
    for r in got:
        assert r.similarity == pytest.approx(bagminhash.overlap(bags[r.a], bags[r.b])) and r.similarity >= 0.8

    def groups(pairs):
        above = list(range(n))
        for x, y in pairs:
            while above[x] != x:
                x = above[x]
            while above[y] != y:
                y = above[y]
            above[max(x, y)] = min(x, y)
        def top(x):
            return x if above[x] == x else top(above[x])
        return [top(x) for x in range(n)]

    assert groups(links[:150] + [(r.a, r.b) for r in got]) == groups(links)
    inside = bagminhash._Block(7, [
        np.arange(n), component, sketch, bands, [h.tobytes() + c.astype(np.uint32).tobytes() for h, c in bags]],
        None).links()
    assert len(inside) < 250 and groups(links[:150] + [x[:2] for x in inside]) == groups(links)


def test_blocks_of_one_component_do_not_meet(spark, monkeypatch):
    monkeypatch.setattr(bagminhash, "BLOCK", 50)
    component = [0] * 1000 + [1] * 300 + [2] * 30 + list(range(3, 63))
    placed = [(7, k, c) for k, c in enumerate(component)] + [(8, k, 0) for k in range(1000)]
    placed += [(9, k, 0) for k in range(1000)] + [(9, 1300, 2)]
    placed += [(10, k, component[k]) for k in range(900, 1100)]
    rows = bagminhash._dealt(spark.createDataFrame(
        [(*p, 1) for p in placed], "bucket bigint, id bigint, component bigint, weight bigint")).collect()
    groups = {}
    for r in rows:
        groups.setdefault((r.bucket, r.i, r.j), ([], []))[r.side].append((r.id, r.component))
    assert max(len(a) + len(b) for a, b in groups.values()) < 200
    met = {}
    for (bucket, i, j), (a, b) in groups.items():
        pairs = combinations(a, 2) if i == j else ((x, y) for x in a for y in b)
        kinds = {c for _, c in a + b}
        assert len(kinds) > 1 or not kinds & {0, 1}
        for (x, c), (y, d) in pairs:
            if c != d:
                met[bucket, min(x, y), max(x, y)] = met.get((bucket, min(x, y), max(x, y)), 0) + 1
    want = {(7, x, y) for x, y in combinations(range(len(component)), 2)
            if component[x] != component[y]} | {(9, k, 1300) for k in range(1000)}
    want |= {(10, x, y) for x in range(900, 1000) for y in range(1000, 1100)}
    assert set(met) == want and set(met.values()) == {1}
    # The single text meets itself and each of 20 blocks; all others meet it once.
    assert sum(r.bucket == 9 for r in rows) == 1000 + 1 + 20


def test_one_row_of_each_class_stays(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(3, text, "a"), (3, text, "b"), (1, text + " x", "c"), (None, text, "d"), (8, None, "e"),
            (9, "", "f"), (None, None, "g")]
    docs = spark.createDataFrame([(*r, 5, "z") for r in rows], SCHEMA + ", id string, __row int, __id string")
    kept = bagminhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert {(r["__row"], r["__id"]) for r in kept.collect()} == {(5, "z")}
    assert sorted(r.id for r in kept.collect()) == ["c", "d", "e", "f", "g"]
    assert bagminhash.one_of_each(docs.where("doc_id = 77")).count() == 0


def test_estimates_are_unbiased():
    rng = np.random.default_rng(1)
    errors = []
    for k in range(80):
        def bag(common):
            h = np.sort(np.concatenate([common, rng.integers(0, 1 << 62, rng.integers(1, 90))]))
            return h.astype(np.uint64), rng.integers(1, (2, 5, 30)[k % 3], len(h))
        common = rng.integers(0, 1 << 62, rng.integers(5, 200))
        a, b = bag(common), bag(common)
        doc = np.repeat([0, 1], [len(a[0]), len(b[0])])
        s = bagminhash.signatures(doc, np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]), 2)
        errors.append((s[0] == s[1]).mean() - bagminhash.overlap(a, b))
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.05


def test_filter_of_ids_loses_none(spark):
    rows = spark.range(20_000).select((F.col("id") * 977 - 5000).alias("id"), F.lit("x").alias("text"))
    rows = rows.union(spark.createDataFrame([(None, "y")], "id bigint, text string"))
    ids = rows.where("id % 50 = 0").select("id").union(rows.where("id is null").select("id"))
    want = {r.id for r in ids.collect()} - {None}
    for bits in (1 << 24, 1 << 15, 64):
        got = sifted(rows, ids, bits=bits)
        found = {r.id for r in got.collect()}
        assert got.columns == rows.columns and want <= found
        assert bits == 64 or len(found) < 3 * len(want) or bits < 1 << 20
    assert sifted(rows, ids.where("false")).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(300, 301), (5, 5)]
    got = {r.node: r.component for r in components.components(
        spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 160)},
                   300: 300, 301: 300}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# ---------------------------------------------------------------- decontamination

def test_leaks(spark):
    rnd = random.Random(8)
    item = [f"q{rnd.randint(0, 9999)}" for _ in range(40)]
    noise = [f"n{rnd.randint(0, 9999)}" for _ in range(200)]
    swapped = list(item)
    for k in range(6, 40, 9):
        swapped[k] = "zzz"
    docs = [(1, " ".join(noise + item + noise)), (2, " ".join(noise + swapped)),
            (3, ", ".join(item).upper()), (4, " ".join(noise)), (5, " ".join(item[:12])),
            (6, " ".join(item[10:30])), (7, None), (8, ""), (None, " ".join(item)),
            (9, " ".join(noise[:50] * 200 + item)), (1, " ".join(item)),
            (10, " ".join(w for k, w in enumerate(item) if k % 2) + " x" * 30)]
    items = spark.createDataFrame([(70, " ".join(item)), (71, "too short"), (72, None), (None, "a b")],
                                  "item_id bigint, text string")
    made = spark.createDataFrame(docs, SCHEMA).withColumn("place", F.lit(1))
    got = {(r.doc_id, r.item_id): (r.place, r.overlap, r.matches)
           for r in spacedseed.leaks(made, items).collect()}
    assert got == {(1, 70): (0, 40, 40), (2, 70): (200, 40, 36), (3, 70): (0, 40, 40),
                   (6, 70): (0, 20, 20), (9, 70): (10_000, 40, 40)} or got == {
                       (1, 70): (200, 40, 40), (2, 70): (200, 40, 36), (3, 70): (0, 40, 40),
                       (6, 70): (0, 20, 20), (9, 70): (10_000, 40, 40)}
    kept = spacedseed.clean(made, items)
    assert kept.columns == made.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["10", "4", "5", "7", "8", "None"]
    assert spacedseed.leaks(made.where("doc_id = 99"), items).count() == 0
    assert spacedseed.leaks(made, items.where("item_id = 99")).count() == 0


def test_every_leak_keeps_a_seed():
    for size in range(13, 26):
        same = np.array([[k not in gone for k in range(size)]
                         for gone in combinations(range(size), size // 5)])
        seeded = np.zeros(len(same), bool)
        for mask in spacedseed.MASKS:
            for at in range(size - mask[-1]):
                seeded |= same[:, np.array(mask) + at].all(1)
        assert seeded.all(), (size, same[~seeded][0].astype(int))


def test_leaks_with_substitutions_equal_brute_force(spark):
    items = {70: " ".join(f"q{k}" for k in range(13)), 71: " ".join(f"r{k}" for k in range(100))}
    docs = {}
    for gone in ((3, 8), (4, 9), (2, 7), (2, 7, 8)):
        docs[len(docs)] = " ".join("x" if k in gone else w for k, w in enumerate(items[70].split()))
    for phase in range(5):
        docs[len(docs)] = " ".join("x" if k % 5 == phase else w
                                   for k, w in enumerate(items[71].split()))
    got = {(r.doc_id, r.item_id) for r in spacedseed.leaks(
        spark.createDataFrame(list(docs.items()), SCHEMA),
        spark.createDataFrame(list(items.items()), "item_id bigint, text string")).collect()}
    assert got == set(llm_brute.leaks(docs, items))


def test_more_copied_text_keeps_a_leak(spark):
    rnd = random.Random(11)
    items = {70: " ".join(f"q{k}" for k in range(120)), 71: " ".join(f"r{k}" for k in range(60))}
    docs = {0: " ".join("x" if k >= 20 and k % 4 == 0 else f"q{k}" for k in range(120)),
            1: " ".join("x" if k < 20 or 60 <= k < 90 and k % 2 else f"q{k}" for k in range(120)),
            2: " ".join(["x", *items[71].split()[5:17], "x", "x", "x"]), 3: ""}
    for _ in range(150):
        words = items[71].split()[rnd.randrange(40):][:rnd.randint(13, 40)]
        share = rnd.choice((0.75, 0.8, 0.85))
        docs[len(docs)] = " ".join(w if rnd.random() < share else "x" for w in ["x", *words, "y"])
    got = {(r.doc_id, r.item_id): (r.overlap, r.matches) for r in spacedseed.leaks(
        spark.createDataFrame(list(docs.items()), SCHEMA),
        spark.createDataFrame(list(items.items()), "item_id bigint, text string")).collect()}
    assert (0, 70) in got and (2, 71) not in got
    assert got == llm_brute.leaks(docs, items)


def test_texts_of_one_item_id(spark):
    texts = [" ".join(f"{c}{k}" for k in range(30)) for c in "ab"]
    items = spark.createDataFrame([(70, t) for t in texts], "item_id bigint, text string")
    docs = spark.createDataFrame([(k, texts[k % 2]) for k in range(6)], SCHEMA)
    assert sorted(r.doc_id for r in spacedseed.leaks(docs, items).collect()) == list(range(6))


# ---------------------------------------------------------------- token shards

def test_grammars_round_trip():
    rng = np.random.default_rng(0)
    for _ in range(150):
        ids = [np.append(rng.integers(2, rng.integers(3, 8), rng.integers(0, 200)), 1).astype(np.uint32)
               for _ in range(rng.integers(1, 6))]
        whole = np.concatenate(ids)
        symbols, rules, base = repair.compress(whole, 1, 2, 50, 0.0)
        assert (repair.expand(symbols, rules, base) == whole).all()
        assert (repair.expansions(rules, base) == [len(repair.expand(r, rules, base))
                                                   for r in rules]).all()
        shard = repair.Shard.load(repair.Shard.of([None, *range(1, len(ids))], ids).dump())
        for k, (doc, start, some) in enumerate(shard.documents()):
            assert doc == (k or None) and (some == ids[k]).all()
            assert (shard.document(k) == ids[k]).all()
        a, b = sorted(rng.integers(0, len(whole) + 1, 2))
        assert b == a or (shard.ids(a, b) == whole[a:b]).all()


def test_shards_hold_all_documents(spark, documents):
    rows = documents + [(None, "b"), (None, "a"), (-5, None), (7, "again"), (9000, "w " * 20_000)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("id", F.lit("x")).repartition(3)
    got = repair.read(repair.stored(docs, PATH)).collect()
    library, start = Tokenizer.from_file(PATH), 0
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    for (doc, text), r in zip(rows, sorted(got, key=lambda r: r.start), strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        assert (r.id, r.start, r.n_tokens, r.ids) == (doc, start, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert repair.read(repair.stored(docs.where("doc_id = 123456"), PATH)).count() == 0


# ---------------------------------------------------------------- pipeline

def test_pipeline_equals_plain_reading(spark, documents):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "repeated_passages", "decontamination", "tokens"]
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    kept = {r.doc_id: r.text for r in rows if not llm_brute.quality(r.text)[-1]}
    linked = llm_brute.classes(kept)
    kept = sorted((i, t) for i, t in kept.items() if linked[i] == i)
    kept = [(i, rest[-1].decode("utf-8", "ignore")) for (i, _), rest in zip(
        kept, llm_brute.repeats([(i, t.encode()) for i, t in kept]))]
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    kept = [(i, t) for i, t in kept if not any(x in t for x in items)]
    library = Tokenizer.from_file(PATH)
    want = {i: (len(t), library.encode(t, add_special_tokens=False).ids) for i, t in kept}
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_chars, r.ids) for r in got} == want
    assert len(got) == len(want)


def test_pipeline_stages_over_odd_rows(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (1, None, "en", None, 4), (1, "", None, "s", None),
         (None, "many words " * 4000, "en", "s", 3)], docs.schema)
    for rows in (odd, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, SF_DIR)
            assert name == "tokens" or out.columns == docs.columns
            assert out.count() <= rows.count()
