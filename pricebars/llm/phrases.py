"""Phrase collocation mining by dynamic itemset counting.

The rows are dealt by hash into ``SHARDS`` shards that are scanned in turn, again and
again; each scan is one Spark job.  Lengths are interleaved: single words are counted from
the first scan on, and after every scan a longer phrase is activated where both its
subphrases (all words but the last, all but the first) have reached the threshold in what
was counted so far.  From then on a phrase is counted for exactly one full cycle, so each
count is over all rows, whatever the scan it began at; scans end when no length can be
active any more (at most ``MAX_WORDS`` cycles).

Which phrases are active is told by a table of ``SLOTS`` bytes per length that every task
gets: the slot of a phrase (a hash of its language and words) holds the scan from which
longer phrases may use it.  The start of a longer phrase is the later one of its two
subphrases' slots, so it needs no list of candidates.  Two phrases in one slot only make
others active earlier than needed; their count is still that of one full cycle and falls
below the threshold where it should.  So the table is of fixed size and results are exact.
What a scan counts is written below ``spark.checkpoint.dir`` and added up by shuffles that
combine on the map side; only slots (at most ``SLOTS``) come to the driver.

Phrases are counted as rows of 64-bit word numbers, a digest of language and word; the first
cycle also lists every word with its number.  Should two words share a number, the whole
is counted again with other numbers, so counts are exact.

Words are runs of anything but spaces and tabs within a piece, pieces are what lies between
``.,;:!?`` and line breaks; A-Z are lower-cased.  All counts are per language.

Defined cases: a NULL or empty text has no words; a NULL language is ``und``; a NULL
language and a language named ``und`` are one; equal rows count as often as they stand;
texts of any length are read whole, in slices that end between texts; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricebars.llm.settle import settled, spread_join
from pricebars.llm.words import LOWER, mix, slices
from pricebars.session import ensure_checkpoint_dir

SHARDS = 2
MAX_WORDS = 3
SLOTS = 1 << 24
SLICE_BYTES = 4 << 20
MIN_COUNT = 10
INSIDE_PERCENT = 50
TOP = 2000
RANK_PARTS = 32
NEVER = 255

PIECE = np.zeros(256, bool)
PIECE[[ord(c) for c in ".,;:!?"]] = PIECE[0x0A:0x0E] = True
GAP = PIECE.copy()
GAP[[0x20, 0x09]] = True
GAP_BYTES = np.flatnonzero(GAP).astype(np.uint8).tobytes()
PARTS = "word string, words int, w1 long, w2 long, w3 long, start int, n long"
NUMBERS = ["w1", "w2", "w3"]


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """``(words, row of each word, piece of each word)`` of the texts in ``data``."""
    gap = np.take(GAP, data)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = np.flatnonzero(~gap & (np.concatenate([[True], gap[:-1]]) | edge[:-1])) if len(data) else np.zeros(0, np.int64)
    ends = np.flatnonzero(~gap & (np.concatenate([gap[1:], [True]]) | edge[1:])) + 1 if len(data) else begins
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(begins, offsets)))
    borders = np.flatnonzero(np.take(PIECE, data) | edge[:-1])
    piece = np.cumsum(np.bincount(np.searchsorted(begins, borders), minlength=len(begins) + 1))[:len(begins)]
    places = np.zeros(len(begins) + 1, np.int64)
    np.cumsum(ends - begins, out=places[1:])
    kept = data.tobytes().translate(LOWER.tobytes(), GAP_BYTES)
    texts = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(places), pa.py_buffer(kept))
    return texts, row, piece


def slot(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(SLOTS - 1)).astype(np.int64)


def joined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hash of a phrase from the hashes of its words."""
    return mix(first * np.uint64(0x9E3779B97F4A7C15) + second)


def _unique(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Different values as they come, the first place and the count of each, and the value of each place."""
    inverse, value = pd.factorize(key)
    first = np.empty(len(value), np.int64)
    first[inverse[::-1]] = np.arange(len(key) - 1, -1, -1)
    return value, first, inverse, np.bincount(inverse, minlength=len(value))


def counted(langs: pa.Array, data: np.ndarray, offsets: np.ndarray, step: int, shards: int, seed: int,
            tables: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows of ``PARTS`` for the phrases that are active in scan ``step``."""
    texts, row, piece = tokens(data, offsets)
    if len(texts) == 0:
        return
    texts, langs = texts.dictionary_encode(), langs.dictionary_encode()
    names = langs.dictionary
    code = texts.indices.to_numpy().astype(np.int64) * len(names) + langs.indices.to_numpy()[row]
    value, _, word, often = _unique(code)
    lang = names.take(pa.array(value % len(names))).cast(pa.large_string())
    text = texts.dictionary.take(pa.array(value // len(names)))
    keys = pc.binary_join_element_wise(lang, text, pa.scalar("\t", pa.large_string()))
    numbers = np.array([xxhash.xxh3_64_intdigest(k, seed) for k in keys.cast(pa.large_binary()).to_pylist()], np.uint64)

    def rows(words, strings, parts, start, n):
        size = len(n)
        cells = [pa.array(p.view(np.int64)) for p in parts] + [pa.nulls(size, pa.int64())] * (MAX_WORDS - words)
        return pa.RecordBatch.from_arrays(
            [strings, pa.array(np.full(size, words, np.int32)), *cells, pa.array(start.astype(np.int32)), pa.array(n.astype(np.int64))],
            names=["word", "words", *NUMBERS, "start", "n"])

    if step < shards:
        yield rows(1, keys.cast(pa.string()), [numbers], np.zeros(len(keys), np.int32), often)
    # the phrases of one length: the places of the text where one stands, the hash of each, and the
    # number of each in this slice and its words, if all of them were counted
    at, heads, known = np.arange(len(word)), numbers[word], (word, [np.arange(len(keys))])
    reach = tables[0][slot(numbers)][word]
    for words in range(2, MAX_WORDS + 1):
        # a phrase at a place and its successor at the next, one word further
        follows = at[1:] == at[:-1] + 1
        pair = np.flatnonzero(follows & (piece[1:] == piece[:-1]) if words == 2 else follows)
        start = np.maximum(reach[:-1], reach[1:])[pair]
        go = start <= step
        pair, start = pair[go], start[go]
        if len(pair) == 0:
            return
        now = np.flatnonzero(step < start.astype(np.int64) + shards)  # others have had their cycle
        if len(now):
            phrase, parts = (known[0][pair[now]], known[1]) if known else numbered(word, at[pair[now]], words - 1)
            last = word[at[pair[now]] + words - 1]
            value, first, inverse, n = _unique(phrase * len(keys) + last)
            parts = [p[phrase[first]] for p in parts] + [last[first]]
            yield rows(words, pa.nulls(len(n), pa.string()), [numbers[p] for p in parts], start[now][first], n)
            known = (inverse, parts) if len(now) == len(pair) else None
        else:
            known = None
        if words < MAX_WORDS:
            at, heads = at[pair], joined(heads[pair], numbers[word[at[pair] + words - 1]])
            reach = tables[words - 1][slot(heads)]


def numbered(word: np.ndarray, at: np.ndarray, words: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """A number for the ``words`` words at each of the places ``at``, and the words of each number."""
    value, first, inverse, _ = _unique(word[at])
    parts, size = [value], int(word.max()) + 1
    for k in range(1, words):
        last = word[at + k]
        _, first, new, _ = _unique(inverse * size + last)
        parts, inverse = [p[inverse[first]] for p in parts] + [last[first]], new
    return inverse, parts


def scan(docs: DataFrame, step: int, shards: int, seed: int, tables: list[np.ndarray], path: str) -> None:
    """One scan of the shard whose turn it is, written to ``path``.  Tasks get the slots in use,
    five bytes each, and lay them out again."""
    used = [np.flatnonzero(table != NEVER).astype(np.int32) for table in tables]
    shared = docs.sparkSession.sparkContext.broadcast([(u, table[u]) for u, table in zip(used, tables)])
    mine = docs.filter(F.pmod(F.xxhash64("text"), F.lit(shards)) == step % shards)

    def run(batches):
        laid = []
        for slots, steps in shared.value:
            laid.append(np.full(SLOTS, NEVER, np.uint8))
            laid[-1][slots] = steps
        for batch in batches:
            langs, texts = batch.column(0), batch.column(1)
            for begin, end, data, offsets in slices(texts, SLICE_BYTES):
                yield from counted(langs.slice(begin, end - begin), data, offsets, step, shards, seed, laid)

    mine.mapInArrow(run, PARTS).write.parquet(path)
    shared.destroy()


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = MIN_COUNT,
                     shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """``(phrases, totals)``: ``phrase`` (language, tab, words), ``words`` and ``n`` of each phrase
    of up to ``MAX_WORDS`` words that occurs ``least`` times or more; ``lang`` and its ``total`` of words."""
    docs = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    seed = 0
    while True:
        found = _cycles(docs, least, shards, seed)
        if found is not None:
            return found
        seed += 1


def _cycles(docs: DataFrame, least: int, shards: int, seed: int) -> tuple[DataFrame, DataFrame] | None:
    """All scans; None if two words have one number."""
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/phrases-{uuid.uuid4().hex}"
    tables = [np.full(SLOTS, NEVER, np.uint8) for _ in range(MAX_WORDS - 1)]
    complete, parts, vocabulary = [], [], None
    for step in range(MAX_WORDS * shards):
        scan(docs, step, shards, seed, tables, f"{folder}/{step}")
        parts.append(spark.read.schema(PARTS).parquet(f"{folder}/{step}"))
        # what is not complete yet; phrases of the longest length are only needed once they are
        due = (F.col("start") == step - shards + 1) if step >= shards - 1 else F.lit(False)
        running = _union(parts[-shards:]).filter(F.col("start") > step - shards)
        sums = []
        for words in range(2, MAX_WORDS + 1):  # as many columns as words: narrow rows to shuffle
            own = running.filter((F.col("words") == words) & (F.lit(True) if words < MAX_WORDS else due))
            own = own.groupBy(*NUMBERS[:words], "start").agg(F.sum("n").alias("n"))
            sums.append(own.select(F.lit(words).alias("words"), *[F.col(c) if k < words else F.lit(None).cast("long").alias(c)
                                                                 for k, c in enumerate(NUMBERS)], "start", "n"))
        longer = _union(sums)
        if step < shards:  # single words, with their strings
            some = running.filter("words = 1").groupBy("word", "w1").agg(F.sum("n").alias("n"))
            if step == shards - 1:
                vocabulary = some = settled(some)
                if not some.groupBy("w1").count().filter("count > 1").isEmpty():
                    return None
            ones = some.select(F.lit(1).alias("words"), "w1", *[F.lit(None).cast("long").alias(c) for c in NUMBERS[1:]],
                               F.lit(0).alias("start"), "n")
            longer = longer.unionByName(ones)
        reached = settled(longer.filter(F.col("n") >= least))
        if step >= shards - 1:
            complete.append(reached.filter(due))
        for words in range(1, MAX_WORDS):
            new = _slots_of(reached.filter(F.col("words") == words), words)
            table = tables[words - 1]
            table[new[table[new] == NEVER]] = step + 1
    totals = vocabulary.groupBy(_lang("word").alias("lang")).agg(F.sum("n").alias("total"))
    names = vocabulary.filter(F.col("n") >= least).select(F.col("w1").alias("w"), "word")
    spelt = F.array_sort(F.collect_list(F.struct("place", "word")))
    worded = (spread_join(_union(complete).select("words", "n", *NUMBERS, F.posexplode(F.array(*NUMBERS)).alias("place", "w"))
                          .filter("w is not null"), names, "w", "n")
              .groupBy("words", "n", *NUMBERS).agg(spelt.alias("s")))
    phrase = F.concat(_lang("s[0].word"), F.lit("\t"), F.array_join(F.transform("s", lambda x: F.substring_index(x["word"], "\t", -1)), " "))
    return settled(worded.select(phrase.alias("phrase"), "words", "n")), totals


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _slots_of(phrases: DataFrame, words: int) -> np.ndarray:
    """The distinct slots of some phrases, as bitmaps of ``SLOTS`` bits in all."""

    def run(batches):
        for batch in batches:
            numbers = [batch.column(k).to_numpy().view(np.uint64) for k in range(words)]
            heads = numbers[0]
            for more in numbers[1:]:
                heads = joined(heads, more)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(slot(heads)) + 1)], names=["place"])

    places = phrases.select(*NUMBERS[:words]).mapInArrow(run, "place long")
    maps = places.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    found = [np.zeros(0, np.int64)]
    for row in maps.collect():
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), bitorder="little")
        found.append(np.flatnonzero(bits) + (row["bucket"] - 1) * len(bits))
    return np.concatenate(found)


def _words(phrase: str) -> Column:
    return F.substring_index(phrase, "\t", -1)


def _lang(phrase: str) -> Column:
    return F.expr(f"left({phrase}, length({phrase}) - length(substring_index({phrase}, '\\t', -1)) - 1)")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = MIN_COUNT, inside: int = INSIDE_PERCENT,
                 top: int = TOP, shards: int = SHARDS) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of two words or more of each
    language.  A phrase is cut in two where ``score = floor(1e6 * a * a / (l * r))`` is least; one
    that lies in a longer phrase with ``inside`` percent of its count or more is left out."""
    found, totals = frequent_phrases(docs, text, lang, least, shards)
    w = F.split(_words("phrase"), " ")
    longer = found.filter(F.col("words") > 1).select("phrase", "words", F.col("n").alias("a"), _lang("phrase").alias("lang"), w.alias("w"))

    def part(begin: Column, size: Column) -> Column:
        return F.concat(F.col("lang"), F.lit("\t"), F.array_join(F.slice("w", begin, size), " "))

    # one row for each side of each cut, joined with the counts once
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut")
    cuts = longer.select("*", cut)
    sides = cuts.select("phrase", "words", "a", "cut", F.explode(F.array(
        F.struct(F.lit(True).alias("is_left"), part(F.lit(1), F.col("cut")).alias("part")),
        F.struct(F.lit(False).alias("is_left"), part(F.col("cut") + 1, F.col("words") - F.col("cut")).alias("part")))).alias("side"))
    sides = sides.select("phrase", "words", "a", "cut", "side.*")
    counts = found.select(F.col("phrase").alias("part"), F.col("n").alias("side_n"))
    known = spread_join(sides, counts, "part", "phrase")
    both = known.groupBy("phrase", "words", "a", "cut").agg(
        F.max(F.when(F.col("is_left"), F.col("side_n"))).alias("l"), F.max(F.when(~F.col("is_left"), F.col("side_n"))).alias("r"))
    # whole numbers of up to 38 digits; the score itself is 1,000,000 at most
    wide = {c: F.col(c).cast("decimal(19,0)") for c in "alr"}
    both = both.withColumn("over", wide["a"] * wide["a"] * F.lit(1000000).cast("decimal(7,0)")).withColumn("under", wide["l"] * wide["r"])
    scored = both.withColumn("score", F.expr("over div under").cast("long"))
    best = scored.groupBy("phrase", "words", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("b"))
    holders = longer.filter(F.col("words") > 2).select("a", F.explode(F.array(
        part(F.lit(1), F.col("words") - 1), part(F.lit(2), F.col("words") - 1))).alias("phrase"))
    holders = holders.groupBy("phrase").agg(F.max("a").alias("held"))
    kept = (best.join(holders, "phrase", "left")
            .filter(F.col("held").isNull() | (F.col("held").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * inside)))
    best_first = [F.desc("score"), F.desc("a"), "words_of"]
    listed = kept.select(_lang("phrase").alias("lang"), _words("phrase").alias("words_of"), "a", "b.l", "b.r", "b.score")
    # first in parts of a language, so that the last task of one gets RANK_PARTS x top rows at most
    some = Window.partitionBy("lang", "part").orderBy(*best_first)
    listed = (listed.withColumn("part", F.pmod(F.xxhash64("words_of"), F.lit(RANK_PARTS)))
              .withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= top))
    order = Window.partitionBy("lang").orderBy(*best_first)
    ranked = listed.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return (ranked.join(totals, "lang")
            .select("lang", "rank", F.col("words_of").alias("phrase"), "a", "l", "r", F.col("total").alias("n"), "score"))


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, piece_text FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[.,;:!?\x0A-\x0D]')) AS piece_text
    FROM documents)),
worded AS (SELECT piece, lang, list_filter(string_split_regex(piece_text, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM (SELECT lang, w, unnest([1, 2, 3]) AS k FROM worded WHERE len(w) > 0) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS n FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(n) AS BIGINT) AS total FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= 10),
cuts AS (
  SELECT lang, k, phrase, a, c, array_to_string(w[1:c], ' ') AS lp, array_to_string(w[c + 1:k], ' ') AS rp
  FROM (SELECT *, unnest(range(1, k)) AS c FROM cand)),
scored AS (
  SELECT x.lang, x.k, x.phrase, x.a, x.c, p.n AS l, q.n AS r,
         CAST((CAST(1000000 AS HUGEINT) * x.a * x.a) // (CAST(p.n AS HUGEINT) * q.n) AS BIGINT) AS score
  FROM cuts x JOIN f p ON p.lang = x.lang AND p.k = x.c AND p.phrase = x.lp
              JOIN f q ON q.lang = x.lang AND q.k = x.k - x.c AND q.phrase = x.rp),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
held AS (
  SELECT lang, phrase, max(a) AS held FROM (
    SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM cand WHERE k = 3)
  GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN held h ON h.lang = b.lang AND h.phrase = b.phrase AND b.k = 2
  WHERE h.held IS NULL OR 100 * h.held < 50 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.total AS n, r.score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000
"""
