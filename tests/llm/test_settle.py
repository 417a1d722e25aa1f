"""Joins that split hot keys, and components, against plain ones."""

import time

from pyspark.sql import functions as F

from pricebars.llm import settle
from pricebars.llm.graph import components
from pricebars.llm.settle import checkpointed, settled


def hot_table(spark):
    """A third of the rows on one key, a third on a NULL key, the others on many."""
    i = F.col("id")
    key = F.when(i % 3 == 0, F.lit(7).cast("long")).when(i % 3 == 1, F.lit(None).cast("long")).otherwise(i)
    return spark.range(30_000).select(key.alias("k"), i.alias("v"))


def test_hot_keys_are_few(spark, monkeypatch):
    t = hot_table(spark)
    assert [r["k"] for r in settle.hot_keys(t, "k").filter("_parts > 1").collect()] == [7]
    monkeypatch.setattr(settle, "HOT_SHARE", 100)
    assert [(r["k"], r["_parts"]) for r in settle.hot_keys(t, "k").collect()] == [(7, 334)]
    assert settle.hot_keys(t.limit(0), "k").count() == 0


def test_beside_equals_a_plain_join(spark):
    t = hot_table(spark)

    def least(part):
        return part.groupBy("k").agg(F.min("v").alias("m")).filter("m <> 2")

    for table in (t, t.limit(0)):
        got = settle.beside(table, "k", least)
        assert got.exceptAll(table.join(least(table), "k")).count() == 0
        assert got.count() == table.join(least(table), "k").count()


def test_spread_join_equals_a_plain_join(spark):
    t = hot_table(spark)
    one = t.groupBy("k").agg(F.max("v").alias("m")).filter("k IS NOT NULL AND k <> 5")
    for how in ("inner", "left"):
        got, want = settle.spread_join(t, one, "k", "v", how), t.join(one, "k", how)
        assert got.columns == ["k", "v", "m"] and got.exceptAll(want).count() == 0 and got.count() == want.count()
    assert settle.spread_join(t.limit(0), one, "k", "v", "left").count() == 0


def test_components(spark):
    chain = [(k, k + 1) for k in range(1, 60)] + [(100, k) for k in range(101, 400)] + [(5, 5), (1, 2), (900, 899)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(chain, "u long, v long")).collect()}
    want = {**{k: 1 for k in range(1, 61)}, **{k: 100 for k in range(100, 400)}, 899: 899, 900: 899}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0

def _shuffles(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def _freed(spark, before):
    end = time.time() + 20  # files are removed in the background
    while _shuffles(spark) - before and time.time() < end:
        time.sleep(0.1)
    return not _shuffles(spark) - before


def test_tables_leave_no_shuffle_files(spark):
    for keep in (settled, checkpointed):
        before = _shuffles(spark)
        rows = spark.range(20_000).selectExpr("id % 9999 AS k").groupBy("k").count()
        out = keep(rows)
        assert _freed(spark, before)
        assert out.count() == rows.count() == 9999  # what was written, and the frame itself once more
    assert spark.conf.get(settle.FREED) == "false"


def test_components_leave_no_shuffle_files(spark):
    before = _shuffles(spark)
    found = components(spark.range(1, 600).selectExpr("id AS u", "id - id % 7 AS v"))
    assert _freed(spark, before)
    assert found.filter("component <> id - id % 7 AND id > 6").count() == 0
