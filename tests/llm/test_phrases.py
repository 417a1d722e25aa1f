"""Collocation mining against brute force."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pricebars.llm import phrases as P
from pricebars.session import ensure_checkpoint_dir


def brute(rows, least, inside, top):
    f, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    found = {}
    for (lang, w), a in f.items():
        if len(w) > 1 and a >= least:
            cuts = [(1000000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
            found[lang, w] = (a, min(cuts))
    kept = [(lang, w, a, cut) for (lang, w), (a, cut) in found.items()
            if len(w) == 3 or not any(100 * b >= inside * a for (m, v), (b, _) in found.items()
                                      if m == lang and len(v) == 3 and w in (v[:2], v[1:]))]
    out = set()
    for lang in {k[0] for k in kept}:
        mine = sorted((k for k in kept if k[0] == lang), key=lambda k: (-k[3][0], -k[2], " ".join(k[1]).encode()))[:top]
        out |= {(lang, r + 1, " ".join(w), a, l, rr, total[lang], score) for r, (_, w, a, (score, _, l, rr)) in enumerate(mine)}
    return out


def mined(spark, rows, **more):
    ensure_checkpoint_dir(spark)
    docs = spark.createDataFrame(rows, "text string, lang string")
    got = P.collocations(docs, **more).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return {tuple(r) for r in got.collect()}


@pytest.mark.parametrize("shards", [1, 2, 3])
def test_phrases_equal_brute_force(spark, shards):
    rng = np.random.default_rng(shards)
    words = ["New", "york", "city", "a", "b", "c", "ÄÖ", "x\x00y", "12-3"]
    rows = []
    for _ in range(150):
        w = rng.choice(words, rng.integers(0, 25)).tolist()
        seps = rng.choice([" ", " ", "\t", "  ", ". ", ",", "\n"], len(w)).tolist()
        rows.append(("".join(a + b for a, b in zip(w, seps)), [None, "und", "en", "a\tb"][rng.integers(0, 4)]))
    rows += [("new york city", "en")] * 30 + [("", "en"), (None, "en"), (" \n.", "fr")]
    want = brute(rows, 5, 50, 12)
    assert len(want) > 20 and mined(spark, rows, least=5, top=12, shards=shards) == want


def test_overlaps_repeats_and_hot_phrase(spark):
    rows = [("a a a a", "en")] * 10 + [("b " * 4000, "en"), ("a a. a a", "fr")]
    assert mined(spark, rows) == brute(rows, 10, 50, 2000)


def test_slots_that_collide_change_nothing():
    """All slots in use from scan 1 on, as if every phrase shared one with an early one: each
    phrase is still counted over exactly one cycle."""
    shards = [["a b c. a b", "c a b"], ["b c a b c", "a b"]]
    full = [np.ones(P.SLOTS, np.uint8)] * 2
    got, names = Counter(), {}
    for step in range(4):
        texts = pa.array(shards[step % 2])
        for _, _, data, offsets in P.slices(texts):
            for part in P.counted(pa.array(["en"] * 2), data, offsets, step, 2, 0, full):
                for r in part.to_pylist():
                    if r["words"] == 1:
                        names[r["w1"]] = r["word"].split("\t")[1]
                    got[tuple(x for x in (r["w1"], r["w2"], r["w3"]) if x is not None)] += r["n"]
    want = Counter()
    for text in shards[0] + shards[1]:
        for piece in text.split("."):
            w = piece.split()
            want.update(tuple(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    assert {tuple(names[x] for x in k): n for k, n in got.items()} == dict(want)


def test_words_of_one_number_are_counted_again(spark, monkeypatch):
    seeds, real = [], P._cycles

    def first_fails(docs, least, shards, seed):
        seeds.append(seed)
        return None if seed == 0 else real(docs, least, shards, seed)

    monkeypatch.setattr(P, "_cycles", first_fails)
    rows = [("one two three", "en")] * 12
    assert mined(spark, rows) == brute(rows, 10, 50, 2000) and seeds == [0, 1]


def test_empty_table_and_other_columns(spark):
    ensure_checkpoint_dir(spark)
    none = spark.createDataFrame([], "text string, lang string")
    assert P.collocations(none).count() == 0
    docs = spark.createDataFrame([("x y", "en", 1, "p")] * 11, "text string, lang string, rank int, phrase string")
    assert [tuple(r) for r in P.collocations(docs).select("lang", "rank", "phrase", "a").collect()] == [("en", 1, "x y", 11)]


def test_only_phrases_whose_cycle_is_not_over_are_numbered(monkeypatch):
    numbered = []
    unique = P._unique
    monkeypatch.setattr(P, "_unique", lambda key: numbered.append(len(key)) or unique(key))
    tables = [np.zeros(P.SLOTS, np.uint8) for _ in range(2)]  # all active from the first scan on
    data = np.frombuffer(b"a b c d e f g h i j", np.uint8)
    langs, offsets = pa.array(["en"]), np.array([0, len(data)])
    rows = pa.Table.from_batches(P.counted(langs, data, offsets, 1, 2, 0, tables))
    assert rows["words"].to_pylist() == [1] * 10 + [2] * 9 + [3] * 8 and numbered == [10, 9, 8]
    numbered.clear()
    assert list(P.counted(langs, data, offsets, 2, 2, 0, tables)) == [] and numbered == [10]


def test_triples_that_go_on_when_their_pairs_are_done(spark):
    tables = [np.zeros(P.SLOTS, np.uint8), np.full(P.SLOTS, 2, np.uint8)]
    data = np.frombuffer(b"a b c a b c a b", np.uint8)
    rows = pa.Table.from_batches(P.counted(pa.array(["en"]), data, np.array([0, len(data)]), 2, 2, 0, tables))
    number = {w: np.uint64(P.xxhash.xxh3_64_intdigest(f"en\t{w}".encode(), 0)).view(np.int64).item() for w in "abc"}
    got = {tuple(r[c] for c in ("w1", "w2", "w3", "start", "n")) for r in rows.to_pylist()}
    assert got == {(*(number[w] for w in t), 2, 2) for t in ("abc", "bca", "cab")}
