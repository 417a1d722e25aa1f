"""License scans: a trained paragraph classifier, confirmed by template comparison.

A paragraph is a line; longer ones are read in overlapping pieces of ``PIECE_WORDS``
words.  Consecutive lines with words are also read joined, in such pieces and from every
line on, so that a wrapped notice is whole in one; a joined piece counts where no other
counted piece of its family overlaps it.  The features of a piece are its hashed word 1-grams and 2-grams, of unit
length together.  A multinomial logistic regression tells the licence families and the
class ``unknown`` apart.  It is fitted on the driver, on the notices below with words
left out, and on at most ``SAMPLE_PARAGRAPHS`` paragraphs of the corpus that resemble no
notice (a bounded sample of rows labelled by comparison; the bound is a parameter).
The unknown class is calibrated: a family counts only from the probability that no more
than ``FALSE_SHARE`` of held-out unknown paragraphs reach.  A prediction is confirmed
where the piece holds at least ``CONFIRM`` of the 2-grams of one of the family's notices.

``n_paragraphs`` counts the pieces of lines.  All paragraphs of all whole texts are scored, in Arrow batches; the weights
(``BUCKETS`` x families) and notices are broadcast and do not grow with the input.

Defined cases: NULL and empty texts have no paragraph and no licence; several families
in one text are all told, sorted; repeated lines count each time; ties go to the family
that sorts first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebars.llm.words import extended, mix, slices, words

BUCKETS = 1 << 14
PIECE_WORDS = 48
SAMPLE_PARAGRAPHS = 2000
FALSE_SHARE = 0.001
CONFIRM = 0.6
ROUNDS = 150
UNKNOWN = "unknown"

# Notices of each family (fixed values).
NOTICES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "This project is released under the Apache 2.0 license.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license.",
    ],
    "CC-BY": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "This text is available under the Creative Commons Attribution-ShareAlike License.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "Licensed under the GPL version 2 or later.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright. All rights reserved. Unauthorized copying of this file is strictly prohibited.",
    ],
}


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of all texts: ``(word hashes, first word, end word, text)`` of each."""
    hashes, first, place = words(data, offsets)
    if len(hashes) == 0:
        return hashes, *(np.zeros(0, np.int64) for _ in range(3))
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    line = np.cumsum(data == 10)[place[0]]
    new = np.ones(len(hashes), bool)
    new[1:] = (line[1:] != line[:-1]) | (text[1:] != text[:-1])
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(hashes))
    stride = PIECE_WORDS // 2
    n = np.maximum(1, -(-(end - start - PIECE_WORDS) // stride) + 1)
    at = np.repeat(start, n) + stride * (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
    return hashes, at, np.minimum(at + PIECE_WORDS, np.repeat(end, n)), text[at]


def joined(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces ``(first word, end word, text)`` that span several consecutive lines: from
    every line, up to ``PIECE_WORDS`` words or the end of the last whole line before."""
    none = np.zeros(0, np.int64)
    hashes, first, place = words(data, offsets)
    if len(hashes) == 0:
        return none, none, none
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    line = np.cumsum(data == 10)[place[0]]
    turn = np.ones(len(hashes), bool)
    turn[1:] = (line[1:] != line[:-1]) | (text[1:] != text[:-1])
    start = np.flatnonzero(turn)  # lines
    end = np.append(start[1:], len(hashes))
    apart = np.ones(len(start), bool)
    apart[1:] = (np.diff(line[start]) > 1) | (text[start[1:]] != text[start[:-1]])
    last = np.append(np.flatnonzero(apart)[1:], len(start))[np.cumsum(apart) - 1]  # line after the paragraph
    stop = end[last - 1]
    # a line longer than a piece is left from its last half piece on
    at = np.maximum(start, end - PIECE_WORDS // 2)
    out = []
    for size in (PIECE_WORDS // 2, PIECE_WORDS):
        for begin in (start, at):
            until = np.minimum(begin + size, stop)
            out.append(np.stack([begin, until, text[start]])[:, until > end])
    both = np.unique(np.concatenate(out, axis=1), axis=1)
    return both[0], both[1], both[2]


def features(hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the 1-grams and 2-grams of all pieces, and where each piece's begin."""
    n = end - start
    total = 2 * n - 1
    heads = np.cumsum(total) - total
    at = np.arange(total.sum()) - np.repeat(heads, total)
    base, size = np.repeat(start, total), np.repeat(n, total)
    one = at < size
    place = base + np.where(one, at, at - size)
    pair = hashes[np.minimum(place + 1, len(hashes) - 1)] * np.uint64(0x9E3779B97F4A7C15)
    value = np.where(one, hashes[place], mix(hashes[place] + pair))
    return (value & np.uint64(BUCKETS - 1)).astype(np.int64), heads


def _lines(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return pieces(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))


def _two_grams(hashes: np.ndarray) -> frozenset[int]:
    return frozenset((hashes[:-1] * np.uint64(3) + hashes[1:]).tolist()) if len(hashes) > 1 else frozenset(hashes.tolist())


class Model:
    def __init__(self, families: list[str], weights: np.ndarray, bias: np.ndarray, least: float):
        self.families, self.weights, self.bias, self.least = families, weights, bias, least
        self.notices = [[_two_grams(words(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0]) for t in NOTICES[f]] for f in families]

    def probabilities(self, buckets: np.ndarray, heads: np.ndarray) -> np.ndarray:
        n = np.diff(np.append(heads, len(buckets)))
        score = np.add.reduceat(self.weights[buckets], heads, axis=0) / np.sqrt(n)[:, None] + self.bias
        score = np.exp(score - score.max(axis=1, keepdims=True))
        return score / score.sum(axis=1, keepdims=True)

    def resembles(self, hashes: np.ndarray, family: int) -> float:
        grams = _two_grams(hashes)
        return max(len(g & grams) / len(g) for g in self.notices[family])


def train(unknown: list[str], seed: int = 11) -> Model:
    """Fit on the notices, with words left out, and on unknown paragraphs; a third of the
    latter is held out to calibrate."""
    rng = np.random.default_rng(seed)
    families = sorted(NOTICES)
    texts, label = [], []
    for f, family in enumerate(families):
        for notice in NOTICES[family]:
            parts = notice.split()
            for k in range(40):
                kept = [w for w in parts if k == 0 or rng.random() > 0.12]
                texts.append(" ".join(kept or parts))
                label.append(f)
    model = Model(families, np.zeros((BUCKETS, len(families) + 1), np.float32), np.zeros(len(families) + 1), 1.0)
    hashes, start, end, _ = _lines(unknown)
    plain = [k for k in range(len(start)) if max(model.resembles(hashes[start[k]:end[k]], f) for f in range(len(families))) < CONFIRM / 2]
    held = np.array([k % 3 == 0 for k in range(len(plain))], bool)
    plain = np.array(plain, np.int64)
    learn = plain[~held] if len(plain) else plain
    known = _lines(texts)
    # one table of pieces: notices first, then unknown ones
    all_hashes = np.concatenate([known[0], hashes])
    s = np.concatenate([known[1], start[learn] + len(known[0])])
    e = np.concatenate([known[2], end[learn] + len(known[0])])
    y = np.concatenate([np.array(label)[known[3]], np.full(len(learn), len(families))])
    buckets, heads = features(all_hashes, s, e)
    n = np.diff(np.append(heads, len(buckets)))
    row = np.repeat(np.arange(len(y)), n)
    value = (1 / np.sqrt(n))[row]
    aim = np.eye(len(families) + 1)[y]
    share = 1 / np.maximum(1, np.bincount(y, minlength=len(families) + 1))[y]
    share = (share / share.sum())[:, None]
    used, column = np.unique(buckets, return_inverse=True)
    w, b = np.zeros((len(used), len(families) + 1)), np.zeros(len(families) + 1)
    for _ in range(ROUNDS):
        z = np.stack([np.bincount(row, w[column, c] * value, len(y)) for c in range(w.shape[1])], axis=1) + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        g = (p / p.sum(axis=1, keepdims=True) - aim) * share
        w -= 40 * np.stack([np.bincount(column, g[row, c] * value, len(used)) for c in range(w.shape[1])], axis=1) + 1e-4 * w
        b -= 4 * g.sum(axis=0)
    model.weights[used], model.bias, model.least = w, b, 0.5
    test = plain[held] if len(plain) else plain
    if len(test):
        p = model.probabilities(*features(hashes, start[test], end[test]))[:, :-1].max(axis=1)
        model.least = max(0.5, float(np.quantile(p, 1 - FALSE_SHARE)))
    return model


def sample(docs: DataFrame, text: str = "text", n: int = SAMPLE_PARAGRAPHS) -> list[str]:
    """At most ``n`` different paragraphs, the same for the same rows: the smallest
    digests of the first paragraphs' texts.  The number of different digests gives a
    bar that about ``2 * n`` of them are under, so only those are shuffled and merged,
    however large the input is."""
    line = F.substring_index(F.coalesce(F.col(text), F.lit("")), "\n", 1)
    rows = docs.select(F.substring(line, 1, 2000).alias("line")).filter("line <> ''")
    rows = rows.select("line", (F.shiftrightunsigned(F.xxhash64("line"), 11) / F.lit(float(1 << 53))).alias("h"))
    different = rows.agg(F.approx_count_distinct("h")).first()[0]
    kept = rows.filter(F.col("h") < F.lit(min(1.0, 2 * n / max(1, different)))).distinct()
    return [r["line"] for r in kept.orderBy("h", "line").limit(n).collect()]


def scan(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``n_paragraphs``, ``licences`` (confirmed families), ``n_predicted``,
    ``n_confirmed`` and ``licence_score`` (the best family's probability)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("n_paragraphs", "licences", "n_predicted", "n_confirmed", "licence_score")
    at = docs.schema.names.index(text)
    out = extended(docs.schema, n_paragraphs="long", licences="array<string>", n_predicted="long", n_confirmed="long", licence_score="double")

    def run(batches):
        model = sent.value
        for batch in batches:
            size = batch.num_rows
            lines, predicted, confirmed, best = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size)
            found: list[set[str]] = [set() for _ in range(size)]
            for i, j, data, offsets in slices(batch.column(at), 1 << 18):
                hashes, start, end, owner = pieces(data, offsets)
                if len(start) == 0:
                    continue
                np.add.at(lines, owner + i, 1)
                n = len(start)
                start, end, owner = (np.concatenate(x) for x in zip((start, end, owner), joined(data, offsets)))
                p = model.probabilities(*features(hashes, start, end))
                family = p[:, :-1].argmax(axis=1)
                sure = p[np.arange(len(p)), family]
                told: dict[tuple[int, int, bool], list[tuple[int, int]]] = {}
                for k in np.flatnonzero((sure >= model.least) & (p.argmax(axis=1) == family)):
                    row, f, place = i + owner[k], int(family[k]), (int(start[k]), int(end[k]))
                    best[row] = max(best[row], sure[k])
                    sound = model.resembles(hashes[place[0]:place[1]], f) >= CONFIRM
                    for count, kind in ((predicted, False), *(((confirmed, True),) if sound else ())):
                        others = told.setdefault((row, f, kind), [])
                        if k < n or not any(x < place[1] and place[0] < y for x, y in others):
                            count[row] += 1
                            others.append(place)
                    if sound:
                        found[row].add(model.families[f])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lines), pa.array([sorted(x) for x in found], pa.list_(pa.string())),
                                              pa.array(predicted), pa.array(confirmed), pa.array(best)], names=out.names)

    return docs.mapInArrow(run, out)


def op3_licence_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan(docs, train(sample(docs))).drop("text")
