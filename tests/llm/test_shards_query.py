"""The whole sharding query against what its columns must obey."""

import zlib
from collections import Counter, defaultdict

import pytest

from pricebars.llm import shards
from pricebars.session import ensure_checkpoint_dir


def run(spark, tmp_path, rows):
    ensure_checkpoint_dir(spark)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, shard int").write.parquet(f"{tmp_path}/documents.parquet")
    return shards.op5_kdtree_shards(spark, str(tmp_path)).collect()


def check(got, rows):
    def size(t):
        return len((t or "").encode()) + 1

    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((i, size(t), zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert {r["law"] for r in got} <= {"bytes"} and all(r["grown_shard"] is None for r in got)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) <= set(range(16)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    weight = Counter()
    for r in got:
        weight[r["shard"]] += r["size"]
    total = sum(weight.values())
    groups = defaultdict(Counter)
    for (i, t, *_), r in zip(rows, sorted(got, key=lambda r: r["doc_id"])):
        groups[t][r["shard"]] += r["size"]
    split = [t for t, c in groups.items() if len(c) > 1 and sum(c.values()) <= shards.GROUP_SHARE * total / 16]
    return weight, total, split


def test_shards_are_even_and_groups_whole(spark, tmp_path):
    import random
    r = random.Random(1)
    rows = []
    for k in range(6000):
        text = "".join(r.choice("abcdé \n") for _ in range(r.randint(0, 300)))
        rows += [text] * (1 if k % 7 else r.randint(2, 4))
    rows = [(i, t, "en", 0) for i, t in enumerate(rows)]
    got = run(spark, tmp_path, rows)
    weight, total, split = check(got, rows)
    assert not split and len(weight) == 16 and max(weight.values()) < 1.04 * total / 16 and min(weight.values()) > 0.96 * total / 16


def test_a_hot_text_is_split_and_odd_rows_stay(spark, tmp_path):
    rows = [(i, "hot " * 50, "en", 0) for i in range(3000)] + [(3000 + i, f"{i} " * (i % 40), None, 0) for i in range(2000)]
    rows += [(6000, None, None, None), (6001, "", None, None), (6002, "x" * 100_000, None, None)]
    got = run(spark, tmp_path, rows)
    weight, total, _ = check(got, rows)
    assert len(weight) == 16 and max(weight.values()) < 1.05 * total / 16 + 100_000


@pytest.mark.parametrize("n", [0, 1, 5])
def test_small_tables(spark, tmp_path, n):
    rows = [(i, "same", "en", 0) for i in range(n)]
    assert len(run(spark, tmp_path, rows)) == n


def test_target_bytes(spark):
    ensure_checkpoint_dir(spark)
    from pyspark.sql import functions as F
    docs = spark.range(4000).select("id", F.repeat(F.lit("x"), (F.col("id") % 90 + 1).cast("int")).alias("t"))
    out = shards.kd_shards(docs, [F.col("id")], F.octet_length("t"), F.xxhash64("id"), F.xxhash64("id"), target_bytes=20_000)
    sizes = [r["b"] for r in out.groupBy("shard").agg(F.sum(F.octet_length("t")).alias("b")).collect()]
    assert len(sizes) == 16 and max(sizes) <= 20_000
