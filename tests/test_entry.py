"""The entry module with and without the optional part."""

import subprocess
import sys

import pytest

import __spark_entry__ as entry
from pricebars.plans.catalog import QUERIES
from pricebars.plans.oracle import ORACLE

BLOCK = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {0!r} or name == {0!r}:
            raise {1}("blocked")
sys.meta_path.insert(0, Block())
import __spark_entry__ as e
from pricebars.plans.catalog import QUERIES
assert set(QUERIES) <= set(e.queries()) and not any(n.startswith("op") and n[2].isdigit() for n in e.queries()), sorted(e.queries())
assert "pipeline" not in e.queries() and set(e.oracle_sql()) <= set(e.queries())
"""


@pytest.mark.parametrize("name,error", [("ahocorasick", "ModuleNotFoundError"), ("xxhash", "ImportError"),
                                        ("pricebars.llm", "ModuleNotFoundError"), ("corpus_pipeline", "ModuleNotFoundError")])
def test_price_queries_stand_without_the_corpus_part(name, error):
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", BLOCK.format(name, error)], cwd=entry.__file__.rsplit("/", 1)[0],
                          capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-1500:]


def test_every_sql_has_its_query():
    assert set(ORACLE) <= set(QUERIES) and set(entry.oracle_sql()) <= set(entry.queries())


def test_pipeline_stages_bound_their_arrow_batches(spark, tmp_path):
    import corpus_pipeline

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.createDataFrame([("i", "some words of a benchmark item")], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(k, f"the words of text {k}", "en", "s", 20) for k in range(8)], "doc_id long, text string, lang string, source string, n_chars long")
    try:
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.set(key, "67108864b")
            stage(spark, docs, str(tmp_path))
            assert int(spark.conf.get(key).rstrip("b")) <= 4 << 20
    finally:
        spark.conf.set(key, before)
