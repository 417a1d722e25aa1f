"""Verification of a candidate group against brute force: texts told whole and as differences."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricebars.llm import nearjoin as N
from pricebars.session import ensure_checkpoint_dir


@pytest.mark.parametrize("blocks", [1, 3])
def test_links_of_a_mixed_group(spark, blocks):
    ensure_checkpoint_dir(spark)
    r = random.Random(blocks)
    base = r.sample(range(1, 10**6), 120)
    sets = [set(base)]
    for k in range(25):  # near copies: told as differences
        sets.append(set(base[:r.randint(60, 120)]) | set(r.sample(range(10**6, 2 * 10**6), r.randint(0, 25))))
    other = r.sample(range(2 * 10**6, 3 * 10**6), 90)
    for k in range(15):  # another kin, told whole; some share a little with the model
        sets.append(set(other[:r.randint(50, 90)]) | set(r.sample(base, r.randint(0, 30))))
    sets += [{7}, set(base[:1])]
    weight = [r.randint(1, 3) for _ in sets]
    rows = [(0, i, bytes(np.array(sorted(s), np.uint64).tobytes()), w) for i, (s, w) in enumerate(zip(sets, weight))]
    table = spark.createDataFrame(rows, "component long, rid long, value binary, weight long")
    told = N._told(table.drop("weight"))
    kinds = {t["rid"]: t["lacks"] is None for t in told.collect()}
    assert not kinds[0] and any(kinds.values()) and sum(not k for k in kinds.values()) > 10
    dealt = table.select("component", "rid", "weight", (F.col("rid") % blocks).alias("block"))
    pairs = (dealt.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other")).join(told, "rid")
             .select("component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "rid", "weight", "block", *N.TOLD))
    done = N._verify(pairs.repartition("component", "low", "high").sortWithinPartitions("component", "low", "high"), 0.5).collect()
    got = {i: sum(d["links"] for d in done if d["u"] == i) for i in range(len(sets))}
    want = {i: sum(w for j, (t, w) in enumerate(zip(sets, weight)) if i != j and len(s & t) / len(s | t) >= 0.5) for i, s in enumerate(sets)}
    assert got == want and max(want.values()) > 5
