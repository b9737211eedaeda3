"""Licence scan with a positional index of rare licence words.

One pass over all texts counts in how many of them each licence word stands.
Every template is indexed under its ``RARE`` words of highest inverse document
frequency, with their places in the template.  A second pass looks up the rare
words of each text; postings of one template that agree on where it would start
(``AGREEING`` different words at least) intersect to a candidate place.  There the template's mandatory key phrases must
stand at their own places, and enough of its words must agree.

Besides, the base phrases are found wherever their words stand consecutively.
Words are runs of digits, letters and characters beyond ASCII, A-Z lower-cased.
The licence words and templates are fixed, so what reaches the driver (a count
for each licence word) does not depend on the corpus.

NULL and empty texts have no words, no label and score 0.  Repeated rows are
scanned alike; other columns are passed through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palaver.llm.common import ALNUM, LOWER, Words, map_slices, slices, utf8

RARE = 3
AGREEING = 2
MIN_AGREE = 0.7
FIELDS = [T.StructField(n, t) for n, t in (
    ("n_words", T.LongType()), ("n_base", T.LongType()), ("first_word", T.LongType()),
    ("last_word", T.LongType()), ("base_labels", T.StringType()), ("labels", T.StringType()),
    ("score", T.DoubleType()))]

#: Phrases that give a label wherever they stand.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}


@dataclass(frozen=True)
class Template:
    """Wording of a licence, and phrases of it that must stand at their places."""

    label: str
    text: str
    phrases: tuple[str, ...]


#: Opening words and usual notices of public licences.
TEMPLATES = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy "
             "of this software and associated documentation files", ("free of charge",
                                                                     "copy of this software")),
    Template("apache-2", "Licensed under the Apache License, Version 2.0", ("apache license",)),
    Template("gpl-3", "licensed under the GNU General Public License, version 3",
             ("gnu general public license", "version 3")),
    Template("gpl", "you can redistribute it and/or modify it under the terms of the GNU General "
             "Public License as published by the Free Software Foundation",
             ("gnu general public license",)),
    Template("lgpl", "under the terms of the GNU Lesser General Public License",
             ("gnu lesser general public license",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without "
             "modification, are permitted provided that the following conditions are met",
             ("source and binary forms", "following conditions")),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public "
             "License, v. 2.0", ("mozilla public license",)),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 "
             "International License", ("creative commons attribution 4 0 international",)),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any "
             "purpose with or without fee is hereby granted", ("with or without fee",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain",
             ("unencumbered software", "public domain")),
)


def words_of(text: str) -> list[str]:
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.translate(
        {b: b + 32 for b in range(65, 91)}))


class Vocabulary:
    """Hashes of all licence words, sorted; a word is its place in them."""

    def __init__(self, templates: tuple[Template, ...] = TEMPLATES, base: dict[str, str] = BASE):
        self.templates, self.base = templates, base
        self.words = sorted({w for t in templates for w in words_of(t.text)}
                            | {w for p in base for w in words_of(p)}
                            | {w for t in templates for p in t.phrases for w in words_of(p)})
        joined = " ".join(self.words).encode()
        hashes = Words(np.frombuffer(joined, np.uint8), np.array([0, len(joined)]),
                       ALNUM, LOWER).hashes
        order = np.argsort(hashes)
        self.words = [self.words[i] for i in order]
        self.hashes = hashes[order]
        self.number = {w: i for i, w in enumerate(self.words)}

    def ids(self, text: str) -> list[int]:
        return [self.number[w] for w in words_of(text)]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each word in the vocabulary, -1 for other words."""
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        return np.where(self.hashes[at] == hashes, at, -1)


def document_counts(docs: DataFrame, text: str, vocabulary: Vocabulary) -> tuple[int, np.ndarray]:
    """Number of texts, and of texts with each licence word."""
    size = len(vocabulary.words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, found = 0, np.zeros(size, np.int64)
        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0)):
                words = Words(data, offsets, ALNUM, LOWER)
                known = vocabulary.find(words.hashes)
                seen = np.unique(words.doc[known >= 0] * size + known[known >= 0])
                found += np.bincount(seen % size, minlength=size)
                total += len(offsets) - 1
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, size), pa.int32()),
                                          pa.array(np.concatenate(([total], found)))],
                                         names=["word", "n"])

    counts = (docs.select(utf8(text)).mapInArrow(run, "word int, n long")
              .groupBy("word").agg(F.sum("n").alias("n")))
    by_word = {r.word: r.n for r in counts.toLocalIterator()}
    return by_word.get(-1, 0), np.array([by_word.get(i, 0) for i in range(size)])


class Index:
    """Postings of the templates' rare words: word -> (template, place)."""

    def __init__(self, vocabulary: Vocabulary, total: int, counts: np.ndarray):
        self.vocabulary = vocabulary
        idf = np.log((total + 1) / (counts + 1))
        self.idf = {w: float(v) for w, v in zip(vocabulary.words, idf)}
        self.labels = sorted({t.label for t in vocabulary.templates} | set(vocabulary.base.values()))
        self.base = [(vocabulary.ids(p), 1 << self.labels.index(n))
                     for p, n in vocabulary.base.items()]
        self.templates, postings = [], []
        for number, template in enumerate(vocabulary.templates):
            ids = vocabulary.ids(template.text)
            required = np.zeros(len(ids), bool)
            for phrase in template.phrases:
                wanted = vocabulary.ids(phrase)
                place = next(i for i in range(len(ids)) if ids[i:i + len(wanted)] == wanted)
                required[place:place + len(wanted)] = True
            self.templates.append((np.array(ids), required,
                                   1 << self.labels.index(template.label)))
            rare = sorted(set(ids), key=lambda w: (-idf[w], vocabulary.words[w]))[:RARE]
            postings += [(w, number, i) for i, w in enumerate(ids) if w in rare]
        postings.sort()
        self.posted, self.posted_template, self.posted_place = np.array(postings).T

    def places(self, known: np.ndarray, bounds: np.ndarray, doc: np.ndarray
               ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Label bit, document and agreement of every place where a template stands."""
        at = np.flatnonzero(np.isin(known, self.posted))
        first = np.searchsorted(self.posted, known[at])
        count = np.searchsorted(self.posted, known[at], "right") - first
        row = np.repeat(np.arange(len(at)), count)
        entry = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        start = at[row] - self.posted_place[entry]
        key = np.stack([self.posted_template[entry], start, self.posted[entry]], 1)
        place, agreeing = np.unique(np.unique(key, axis=0)[:, :2], axis=0, return_counts=True)
        for number, (ids, required, bit) in enumerate(self.templates):
            rare = len(np.unique(self.posted[self.posted_template == number]))
            at = place[(place[:, 0] == number) & (agreeing >= min(AGREEING, rare)), 1]
            at = at[(at >= 0) & (at + len(ids) <= len(known))]
            at = at[doc[at] == doc[at + len(ids) - 1]]
            same = known[at[:, None] + np.arange(len(ids))] == ids
            fits = same[:, required].all(1) & (same.mean(1) >= MIN_AGREE)
            yield bit, doc[at[fits]], same.mean(1)[fits]

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> list:
        """The columns ``FIELDS`` of a slice of texts."""
        words = Words(data, offsets, ALNUM, LOWER)
        n = len(words.counts)
        known = self.vocabulary.find(words.hashes)
        n_base, base_bits, bits = np.zeros((3, n), np.int64)
        first, last = np.full(n, len(known) + 1), np.full(n, -1)
        score = np.zeros(n)
        for ids, bit in self.base:
            at = np.flatnonzero(known == ids[0])
            at = at[at + len(ids) <= len(known)]
            for k, word in enumerate(ids):
                at = at[(known[at + k] == word) & (words.doc[at + k] == words.doc[at])]
            doc = words.doc[at]
            place = at - words.bounds[doc]
            np.add.at(n_base, doc, 1)
            np.minimum.at(first, doc, place)
            np.maximum.at(last, doc, place)
            base_bits[doc] |= bit
            score[doc] = 1.0
        for bit, doc, agreement in self.places(known, words.bounds, words.doc):
            bits[doc] |= bit
            np.maximum.at(score, doc, agreement)
        none = n_base == 0
        return [words.counts, n_base, pa.array(first, pa.int64(), mask=none),
                pa.array(last, pa.int64(), mask=none), self.names(base_bits),
                self.names(base_bits | bits), score]

    def names(self, bits: np.ndarray) -> list[str]:
        return [",".join(n for i, n in enumerate(self.labels) if b >> i & 1) if b else ""
                for b in bits.tolist()]


def scan(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
         vocabulary: Vocabulary | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with labels, base places and score."""
    vocabulary = vocabulary or Vocabulary()
    index = Index(vocabulary, *document_counts(docs, text, vocabulary))
    return map_slices(docs, text, docs.columns if keep is None else keep, FIELDS, index.scan)
