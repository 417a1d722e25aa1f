"""Suffix arrays and exact removal of repeated passages against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pricebars.llm import suffixes as S
from pricebars.session import ensure_checkpoint_dir


def naive(t):
    t = [int(x) for x in t]
    return sorted(range(len(t)), key=lambda i: t[i:])


@pytest.mark.parametrize("letters", [1, 2, 3, 250])
def test_suffix_array_equals_sorting(letters):
    rng = np.random.default_rng(letters)
    for n in (0, 1, 2, 3, 17, 400):
        for _ in range(10):
            t = rng.integers(0, letters, n)
            assert S.suffix_array(t.astype(np.int32)).tolist() == naive(t)


def test_names_sorted_by_recursion_and_by_doubling(monkeypatch):
    t = np.array([2, 1, 3, 1, 3] * 60 + [1, 2] * 50 + [3] * 40)
    assert S.suffix_array(t).tolist() == naive(t)
    monkeypatch.setattr(S, "BUCKETS", 3)
    assert S.suffix_array(t).tolist() == naive(t)


def test_common_prefixes_stop_at_region_ends():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 300).astype(np.uint8)
    ends = np.array([90, 140, 300])
    end = ends[np.searchsorted(ends, np.arange(300), side="right")]
    sa = S.suffix_array(data.astype(np.int32))
    got = S.common_prefixes(data, sa, end)
    raw = data.tobytes()
    for a, b in zip(sa[:-1], sa[1:]):
        x, y = raw[a:end[a]], raw[b:end[b]]
        k = 0
        while k < min(len(x), len(y)) and x[k] == y[k]:
            k += 1
        assert got[b] == k


def test_repeated_windows_equal_counting():
    rng = np.random.default_rng(7)
    for w in (3, 6):
        for _ in range(60):
            regions = [bytes(rng.integers(97, 99, rng.integers(0, 30)).astype(np.uint8)) for _ in range(rng.integers(0, 7))]
            n = Counter(r[i:i + w] for r in regions for i in range(len(r) - w + 1))
            got = S.repeated_windows(regions, w)
            assert [g.tolist() for g in got] == [[n[r[i:i + w]] > 1 for i in range(max(len(r) - w + 1, 0))] for r in regions]


def test_anchors_cover_all_windows_and_depend_on_content_only():
    rng = np.random.default_rng(5)
    middle = rng.integers(0, 256, 700).astype(np.uint8)
    a, b = np.concatenate([rng.integers(0, 256, 311).astype(np.uint8), middle]), np.concatenate([middle, rng.integers(0, 256, 90).astype(np.uint8)])
    pins = []
    for data, at in ((a, 311), (b, 0)):
        first, last, key, pin = S.anchors(data)
        assert first[0] == 0 and last[-1] == len(data) - S.WINDOW and (first[1:] == last[:-1] + 1).all()
        assert (last - first <= S.WINDOW - S.GRAM).all() and (pin >= last - first).all()
        anchor = np.repeat(first + pin, last - first + 1)
        pins.append(anchor[at:at + 501] - at)
    assert (pins[0] == pins[1]).all()


def brute(texts, w=S.WINDOW):
    raw = [(t or "").encode() for t in texts]
    n = Counter(b[i:i + w] for b in raw for i in range(len(b) - w + 1))
    out = []
    for b in raw:
        runs = []
        for i in range(len(b) - w + 1):
            if n[b[i:i + w]] > 1:
                if runs and i <= runs[-1][1]:
                    runs[-1][1] = i + w
                else:
                    runs.append([i, i + w])
        kept = b"".join(b[x:y] for x, y in zip([0] + [r[1] for r in runs], [r[0] for r in runs] + [len(b)]))
        out.append((kept, tuple(map(tuple, runs))))
    return out


def word(rng, n):
    return " ".join("".join(rng.choice(list("abcdeé"), rng.integers(2, 8))) for _ in range(n))


def cases():
    rng = np.random.default_rng(11)
    passage, line = word(rng, 70), word(rng, 18)
    texts = [None, "", "short", "x" * 199, "y" * 200, "z" * 201, "ab" * 400, "ab" * 400, "q" * 1500]
    texts += [word(rng, 60) + passage + word(rng, int(k)) for k in rng.integers(0, 60, 12)]          # a common passage
    texts += [word(rng, 30) + line + word(rng, 30) for _ in range(12)]                                # a common line, below a window
    base = word(rng, 200)
    texts += [base.replace(" ", "  ", k) for k in range(4)] + [base, base]                            # near and exact copies
    texts += [passage + passage + word(rng, 3)] + [passage[:205], passage[3:]]
    texts += [word(rng, int(k)) for k in rng.integers(10, 300, 20)]
    return texts


def check(spark, texts):
    ensure_checkpoint_dir(spark)
    docs = spark.createDataFrame([(i, t, "kept", i) for i, t in enumerate(texts)], "doc_id long, text string, kept string, tid long")
    got = {r["doc_id"]: (bytes(r["kept"]), tuple((s["begin"], s["end"]) for s in r["spans"])) for r in S.without_repeats(docs).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)
    assert S.without_repeats(docs).columns == ["doc_id", "text", "tid", "kept", "spans"]


def test_passages_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(S, "SHARD_BYTES", 2000)
    check(spark, cases())


def test_hot_keys_and_long_texts_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(S, "HOT_BYTES", 1000)
    check(spark, cases())


def test_segments_of_a_long_text_give_the_same_windows(monkeypatch):
    rng = np.random.default_rng(2)
    texts = [bytes(rng.integers(97, 103, n).astype(np.uint8)) for n in (150, 200, 900, 2501)]
    batch = pa.RecordBatch.from_arrays([pa.array([bytes([i]) for i in range(4)], pa.binary()), pa.array(texts, pa.binary())], names=["tid", "data"])

    def windows():
        out = {}
        for rows in S._anchor_rows([batch]):
            for r in rows.to_pylist():
                for k in range(r["size"] - S.WINDOW + 1):
                    assert (r["tid"], r["at"] + k) not in out
                    out[r["tid"], r["at"] + k] = (r["key"], r["at"] + r["pin"])
        return out

    whole = windows()
    assert len(whole) == 1 + 701 + 2302
    monkeypatch.setattr(S, "SEGMENT", 300)
    assert windows() == whole


def test_query_columns_and_empty_table(spark, tmp_path):
    ensure_checkpoint_dir(spark)
    text = "wörd " * 100
    rows = [(1, text), (2, text), (None, None), (3, "plain")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: tuple(r)[1:] for r in S.op13_suffix_dedup(spark, str(tmp_path)).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert got == {1: (600, 600, 1, nothing), 2: (600, 600, 1, nothing), None: (0, 0, 0, nothing), 3: (5, 0, 0, hashlib.sha256(b"plain").hexdigest())}
    none = spark.createDataFrame([], "doc_id long, text string")
    assert S.without_repeats(none).count() == 0


def test_whole_texts_go_to_python_in_bounded_batches(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    ensure_checkpoint_dir(spark)
    docs = spark.range(6000, numPartitions=1).selectExpr("id AS doc_id", "repeat(cast(id AS string), 400) AS text")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

    try:
        spark.conf.set(key, "67108864b")
        S.without_repeats(docs)
        assert max(r["size"] for r in docs.mapInArrow(sizes, "size long").collect()) < 5 << 20
        spark.conf.set(key, "1m")  # one that someone chose stays
        S.without_repeats(docs.limit(1))
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.set(key, before)
