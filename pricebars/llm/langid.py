"""Language ID: multinomial naive Bayes over hashed character n-grams.

Characters are lower-cased; every run of characters that are not letters is one
blank.  The features of a text are its n-grams of ``ORDERS`` characters, hashed to
``BUCKETS``.  Counts are taken over all labelled rows (no sample), reduced per task
before the shuffle.  The log-probability matrix (``BUCKETS`` x languages floats) is
broadcast; its size is bounded by ``MAX_LANGUAGES`` and does not grow with the rows.

Defined cases: a NULL text, or one without a letter, is ``und`` with score 0; with
no labelled row every text is ``und``; ties go to the language that sorts first;
rows with a NULL language teach nothing; repeated rows count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricebars.llm.words import extended, mix, slices

BUCKETS = 1 << 16
ORDERS = (2, 3)
SMOOTHING = 0.5
MAX_LANGUAGES = 256
UNDETERMINED = "und"
MIN_SCORE = 0.5

_LETTER: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _LETTER


def _codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters and single blanks of all texts as code points, and where each starts."""
    code = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    ahead = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=ahead[1:])
    at = ahead[offsets]
    blank = ~_letters()[code]
    first = np.zeros(len(code) + 1, bool)
    first[at] = True
    keep = ~blank
    keep[1:] |= ~blank[:-1] & ~first[1:-1]
    kept = np.zeros(len(code) + 1, np.int64)
    np.cumsum(keep, out=kept[1:])
    code = np.where(blank, np.uint32(32), code)[keep]
    return code, kept[at]


def grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram order: the bucket of every n-gram, and the text it is of."""
    code, at = _codes(data, offsets)
    if len(code) == 0:
        return
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    wide = code.astype(np.uint64)
    for n in ORDERS:
        if len(wide) < n:
            return
        value = np.full(len(wide) - n + 1, n, np.uint64)
        for j in range(n):
            value = (value << np.uint64(21)) ^ wide[j:len(wide) - n + 1 + j]
        one = text[:len(value)] == text[n - 1:]
        yield (mix(value[one]) >> np.uint64(64 - (BUCKETS - 1).bit_length())).astype(np.int64), text[:len(value)][one]


def _lowered(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(column.fill_null("")) if column.null_count else pc.utf8_lower(column)


def gram_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``(lang, bucket, n)`` over all rows with a language; bucket -1 counts texts."""

    def count(batches):
        held: dict[str, np.ndarray] = {}

        def out():
            for name, c in held.items():
                at = np.flatnonzero(c)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at - 1), pa.array(c[at])], names=["lang", "bucket", "n"])
            held.clear()

        for batch in batches:
            names = np.array(batch.column(1).to_pylist(), dtype=object)
            for a, b, data, offsets in slices(_lowered(batch.column(0))):
                known, code = np.unique(names[a:b], return_inverse=True)
                size = len(known) * (BUCKETS + 1)
                total = np.zeros(size, np.int64)
                for bucket, row in grams(data, offsets):
                    total += np.bincount(code[row] * (BUCKETS + 1) + bucket + 1, minlength=size)
                total[np.arange(len(known)) * (BUCKETS + 1)] = np.bincount(code, minlength=len(known))
                for name, c in zip(known, total.reshape(len(known), -1)):
                    held[name] = held[name] + c if name in held else c.copy()
                if len(held) > 32:
                    yield from out()
        yield from out()

    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("lang IS NOT NULL AND text IS NOT NULL")
    return rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray, np.ndarray]:
    """``(languages, log priors, log-probability matrix)`` of the labelled rows."""
    counts = gram_counts(docs, text, lang)
    found = counts.limit((BUCKETS + 1) * MAX_LANGUAGES + 1).toArrow()
    if found.num_rows > (BUCKETS + 1) * MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: the matrix would not be bounded")
    names = sorted(set(found.column("lang").to_pylist()))
    table = np.zeros((BUCKETS + 1, max(1, len(names))))
    if names:
        code = np.searchsorted(np.array(names, dtype=object), np.array(found.column("lang").to_pylist(), dtype=object))
        table[found.column("bucket").to_numpy() + 1, code] = found.column("n").to_numpy()
    prior = np.log(table[0] + 1) - np.log((table[0] + 1).sum())
    seen = table[1:] + SMOOTHING
    return names, prior, (np.log(seen) - np.log(seen.sum(axis=0))).astype(np.float32)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], text: str = "text",
            lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its posterior probability."""
    names = model[0]
    sent = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop(lang_pred, score)
    fields = docs.schema.names
    out = extended(docs.schema, **{lang_pred: "string", score: "double"})

    def judge(batches):
        _, prior, matrix = sent.value
        for batch in batches:
            column = batch.column(fields.index(text))
            label, sure = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for a, b, data, offsets in slices(_lowered(column)):
                sums = np.tile(prior, (b - a, 1))
                letters = np.zeros(b - a, bool)
                code, at = _codes(data, offsets)
                letters[np.diff(at) > 0] = True
                for bucket, row in grams(data, offsets):
                    heads = np.flatnonzero(np.diff(row, prepend=-1))
                    if len(heads):
                        sums[row[heads]] += np.add.reduceat(matrix[bucket], heads, axis=0, dtype=np.float64)
                best = sums.argmax(axis=1)
                share = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
                known = letters & bool(names)
                label[a:b], sure[a:b] = np.where(known, best, -1), np.where(known, share, 0.0)
            told = pa.array([names[k] if k >= 0 else UNDETERMINED for k in label], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, told, pa.array(sure)], names=[*batch.schema.names, lang_pred, score])

    return docs.mapInArrow(judge, out)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows never learned from: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def learned(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    return train(docs.filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0))


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = predict(docs.select("doc_id", "text"), learned(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def keep_known(docs: DataFrame) -> DataFrame:
    """Pipeline stage: documents in a learned language; ``und`` and texts whose
    posterior is below ``MIN_SCORE`` go."""
    found = predict(docs, learned(docs), lang_pred="_lang_pred", score="_score")
    return found.filter((F.col("_lang_pred") != UNDETERMINED) & (F.col("_score") >= MIN_SCORE)).drop("_lang_pred", "_score")
