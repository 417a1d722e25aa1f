"""N-gram Jaccard join: MinHash banding, followed by exact verification.

Every text is the set of its five-word shingles (``words.py``).  Texts with the same
set are one class member with a count, so copies never form pairs.  A signature has
``TREES`` bands (called trees) of minima of independent permutations.  The depth of a
band is fixed before any data is seen: the largest, up to ``DEPTH``, whose recall at the
threshold reaches ``TARGET_RECALL`` (``forest_depth``).  There are no tries.  All texts that
share a whole band in any tree are candidates.

Candidates are not paired.  A trie node links its members to its smallest one, the
links' components are the candidate groups, and each group is verified whole: every
pair of a group is compared exactly, on the shingle sets, in blocks of at most
``BLOCK_ROWS`` texts and ``BLOCK_SHINGLES`` shingles.  A large group becomes many pairs of
blocks, each its own unit of work; what leaves a block is one row per text (its
number of links, and one edge that keeps its class together), never a pair.  So no
link between different texts is lost, and hot groups are spread over tasks.

What is copied to the blocks is short: a group's smallest member is its model, and a text
is told by the shingles it has beyond the model and those of the model it lacks, where
these are fewer than its own.  With ``m`` and ``e`` for these two lists, two such texts share
``|model| - |m1| - |m2| + |m1 & m2| + |e1 & e2|`` shingles, which is as exact as their sets.

Defined cases: NULL texts and texts without words have no class but their own and no
links; a text of one to four words is one shingle; repeated rows are documents of their
own; the class id is the smallest document id of the class, NULL ids last; links count
documents, copies included.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebars.llm.graph import components
from pricebars.llm.settle import beside, checkpointed, discard, rows_of, settled, spread_join
from pricebars.llm.words import mix, shingles, slices, words

THRESHOLD = 0.8
TREES = 24
DEPTH = 8
TARGET_RECALL = 0.9999
BLOCK_ROWS = 256
BLOCK_SHINGLES = 1 << 20
DENSE_CELLS = 1 << 23
SEED = 20240229


def forest_depth(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, target: float = TARGET_RECALL) -> int:
    """Shorten the prefix until a pair at the threshold is matched by some tree with
    the target probability."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < target:
        depth -= 1
    return depth


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(SEED)
    return r.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1), r.integers(0, 1 << 32, n, dtype=np.uint32)


def unique_shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different shingles of each text, and where each text's begin."""
    hashes, first, _ = words(data, offsets)
    value, starts = shingles(hashes, first)
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    value, text = value[new], text[new]
    return value, np.searchsorted(text, np.arange(len(starts)))


def sketches(docs: DataFrame, prefix: int, trees: int = TREES) -> DataFrame:
    """``docs`` (``doc_id``, ``text``, ``text_key``) as ``doc_id``, ``text_key``, digest of
    the shingle set (NULL without words), its size and one prefix key per tree."""
    a, b = _permutations(trees * prefix)

    def run(batches):
        for batch in batches:
            for i, j, data, offsets in slices(batch.column(1)):
                value, first = unique_shingles(data, offsets)
                size = np.diff(first)
                full = np.flatnonzero(size)
                keys = np.zeros((j - i, trees), np.uint64)
                digest = np.zeros((j - i, 2), np.uint64)
                if len(full):
                    heads = first[full]
                    short = (value >> np.uint64(32)).astype(np.uint32)
                    for t in range(trees):
                        key = np.full(len(full), t + 1, np.uint64)
                        for p in range(t * prefix, (t + 1) * prefix):
                            key = mix(key ^ np.minimum.reduceat(short * a[p] + b[p], heads).astype(np.uint64))
                        keys[full, t] = key
                    digest[full, 0] = np.add.reduceat(value, heads)
                    digest[full, 1] = np.add.reduceat(mix(value ^ np.uint64(0xA5A5A5A5A5A5A5A5)), heads)
                raw = digest.tobytes()
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(2),
                    pa.array([raw[16 * k:16 * k + 16] if size[k] else None for k in range(j - i)], pa.binary()), pa.array(size.astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, (j - i) * trees + 1, trees, dtype=np.int32)), pa.array(keys.view(np.int64).ravel()))],
                    names=["doc_id", "text_key", "set_key", "n_shingles", "trees"])

    return docs.select("doc_id", "text", "text_key").mapInArrow(run, "doc_id long, text_key binary, set_key binary, n_shingles long, trees array<long>")


def text_key(text: str):
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def _verify(rows: DataFrame, threshold: float) -> DataFrame:
    """Rows sorted by ``(component, low, high)``: links of each text with the texts of
    the other block (or of its own, where the blocks are one)."""

    def linked(group: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array([g[0] for g in group])
        weight = np.array([g[1] for g in group])
        second = np.array([g[2] for g in group])
        size, model, met = (np.array([g[k] for g in group], np.int64) for k in (3, 4, 5))
        near = np.array([g[7] is not None for g in group])  # told against the model
        extra = [np.frombuffer(g[6], np.uint64) for g in group]
        lacks = [np.frombuffer(g[7] or b"", np.uint64) for g in group]
        n_lacks = np.array([len(x) for x in lacks])
        n = len(group)
        value = np.concatenate(extra + lacks)
        owner = np.repeat(np.arange(2 * n), [len(x) for x in extra + lacks])
        order = np.argsort(value, kind="stable")
        value, owner = value[order], owner[order]
        new = np.ones(len(value), bool)
        new[1:] = value[1:] != value[:-1]
        word = np.cumsum(new) - 1
        shared = np.bincount(word)[word] > 1 if len(word) else np.zeros(0, bool)
        word, owner = word[shared], owner[shared]
        cross = np.zeros((2 * n, 2 * n), np.float32)
        step = max(1, DENSE_CELLS // (2 * n))
        if len(word):
            word = np.cumsum(np.diff(word, prepend=word[0]) > 0)
            cuts = np.searchsorted(word, np.arange(0, word[-1] + 1 + step, step))
            for c, (p, q) in enumerate(zip(cuts[:-1], cuts[1:])):
                m = np.zeros((2 * n, min(step, int(word[-1]) + 1 - c * step)), np.float32)
                m[owner[p:q], word[p:q] - c * step] = 1
                cross += m @ m.T  # whole numbers below 2^24: exact
        both = cross[:n, :n].astype(np.float64)
        alike = near[:, None] & near[None, :]
        both += np.where(alike, model[:, None] - n_lacks[:, None] - n_lacks[None, :] + cross[n:, n:], 0)
        # a text that is told whole against one that is not: what it shares with the model counts
        one = near[:, None] & ~near[None, :]
        mixed = np.where(one, met[None, :] - cross[n:, :n], 0)
        both += mixed + mixed.T
        union = size[:, None] + size[None, :] - both
        link = both / union >= threshold
        np.fill_diagonal(link, False)
        if second.any():
            link &= second[:, None] != second[None, :]
        label = np.arange(len(ids))
        while True:  # the smallest place that can be reached over links
            less = np.minimum(label, np.where(link, label[None, :], len(ids)).min(axis=1))
            less = less[less]
            if (less == label).all():
                break
            label = less
        return np.stack([ids, ids[label]]), link @ weight

    def run(batches):
        held: list[tuple] = []
        at = None
        out: list[tuple[np.ndarray, np.ndarray]] = []

        def told():
            found = pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([e[0] for e, _ in out])), pa.array(np.concatenate([e[1] for e, _ in out])),
                pa.array(np.concatenate([n for _, n in out]).astype(np.int64))], names=["u", "v", "links"])
            out.clear()
            return found

        for batch in batches:
            c, low, high, *rest = (x.to_pylist() for x in batch.columns)
            for k, key in enumerate(zip(c, low, high)):
                if key != at:
                    if len(held) > 1:
                        out.append(linked(held))
                    held, at = [], key
                rid, weight, block, *told_as = (x[k] for x in rest)
                held.append((rid, weight, block != key[1], *told_as))
            if len(out) > 1000:
                yield told()
        if len(held) > 1:
            out.append(linked(held))
        if out:
            yield told()

    return rows.select("component", "low", "high", "rid", "weight", "block", *TOLD).mapInArrow(run, "u long, v long, links long")


def _shingle_sets(texts: DataFrame) -> DataFrame:
    """``(rid, value)``: the sorted shingle set of each text as bytes."""

    def run(batches):
        for batch in batches:
            for i, j, data, offsets in slices(batch.column(1)):
                value, first = unique_shingles(data, offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array([value[p:q].tobytes() for p, q in zip(first[:-1], first[1:])], pa.binary())], names=["rid", "value"])

    return texts.select("rid", "text").mapInArrow(run, "rid long, value binary")


TOLD = ["size", "model_size", "met", "extra", "lacks"]


def _told(sets: DataFrame) -> DataFrame:
    """Sets (``component, rid, value``) told against their group's smallest member: ``TOLD``, with
    ``lacks`` NULL and the whole set as ``extra`` where that is shorter."""

    def run(batches):
        for batch in batches:
            rid, value, model = batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            out = []
            for v, m in zip(value, model):
                v, m = np.frombuffer(v, np.uint64), np.frombuffer(m, np.uint64)
                at = np.minimum(np.searchsorted(m, v), max(len(m) - 1, 0))
                common = m[at] == v if len(m) else np.zeros(len(v), bool)
                lacks = np.ones(len(m), bool)
                lacks[at[common]] = False
                near = (~common).sum() + lacks.sum() < len(v)
                out.append((len(v), len(m), int(common.sum()), (v[~common] if near else v).tobytes(), m[lacks].tobytes() if near else None))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([rid, *(pa.array(c, k) for c, k in zip(zip(*out), kinds))], names=["rid", *TOLD])

    models = sets.filter("rid = component").select("component", F.col("value").alias("model"))
    return spread_join(sets, models, "component", "rid").select("rid", "value", "model").mapInArrow(
        run, "rid long, size long, model_size long, met long, extra binary, lacks binary")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, text_key, class_id, n_links, rid)``, one row per row of ``docs``; ``rid``
    numbers the rows, ``text_key`` is a digest of the text."""
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), text_key(text).alias("text_key"))
    rows = sketches(source, forest_depth(threshold)).withColumn("rid", F.monotonically_increasing_id()).transform(checkpointed)  # numbers stay as written
    # one member per shingle set: its first row stands for it
    sets = (rows.filter("set_key IS NOT NULL").groupBy("set_key")
            .agg(F.min("rid").alias("rid"), F.count(F.lit(1)).alias("weight"), F.min("doc_id").alias("least_id")))
    members = sets.join(rows.select("rid", "doc_id", "text_key", "n_shingles", "trees"), "rid").transform(checkpointed)
    nodes = members.select("rid", F.explode("trees").alias("node"))

    def shared(part: DataFrame) -> DataFrame:
        return part.groupBy("node").agg(F.min("rid").alias("least"), F.max("rid").alias("most")).filter("least <> most").drop("most")

    links = beside(nodes, "node", shared).select(F.col("rid").alias("u"), F.col("least").alias("v")).filter("u <> v").distinct().transform(checkpointed)
    groups = components(links).withColumnRenamed("id", "rid").join(members.drop("trees", "set_key"), "rid").transform(checkpointed)

    def blocks(part: DataFrame) -> DataFrame:
        sizes = part.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("s"))
        n = F.greatest(F.ceil(F.col("n") * 2 / BLOCK_ROWS), F.ceil(F.col("s") * 2 / BLOCK_SHINGLES))
        # up to one whole block: not split
        return sizes.select("component", F.when(n <= 2, F.lit(1)).otherwise(n).cast("long").alias("blocks"))

    dealt = beside(groups, "component", blocks).withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")))
    # the texts of the groups only, one row for each
    wanted = dealt.select("rid", F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    found = rows_of(source, dealt.select("text_key"), "text_key").join(wanted, (F.col("text_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    # the texts are read once: rows repeated in id and text are one
    value = settled(_shingle_sets(found).dropDuplicates(["rid"]).join(dealt.select("rid", "component"), "rid"))
    told = settled(_told(value))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    pairs = (dealt.select("rid", "component", "weight", "block", other.alias("other")).join(told, "rid")
             .select("component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "rid", "weight", "block", *TOLD))
    found = _verify(pairs.repartition("component", "low", "high").sortWithinPartitions("component", "low", "high"), threshold).transform(checkpointed)
    discard(value, told)
    links = found.groupBy("u").agg(F.sum("links").alias("links")).withColumnRenamed("u", "rid")
    final = components(found.select("u", "v")).withColumnRenamed("id", "rid")
    known = (members.select("rid", "set_key", "weight", "least_id").join(links, "rid", "left").join(final, "rid", "left")
             .withColumn("component", F.coalesce("component", "rid")).transform(checkpointed))
    known = beside(known, "component", lambda part: part.groupBy("component").agg(F.min("least_id").alias("class_id"))).select("set_key", "class_id", "component", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return (spread_join(rows.select("doc_id", "text_key", "set_key", "rid"), known, "set_key", "rid", "left")
            .select("doc_id", "text_key", F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "rid").alias("component"), "rid"))


def op1_jaccard_join(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return classes(docs).select("doc_id", "class_id", "n_links")


def one_of_each(docs: DataFrame) -> DataFrame:
    """Pipeline stage: of every class the document with the smallest id stays (NULL ids
    after all others); rows equal in id and text are one document."""
    found = classes(docs)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("rid").alias("rid"))
    kept = found.groupBy("component").agg(F.min_by(F.struct("doc_id", "text_key"), order).alias("k")).select(
        F.col("k.doc_id").alias("_id"), F.col("k.text_key").alias("_key")).distinct()
    keyed = docs.withColumn("_text", text_key("text"))
    same = (F.col("_text") == F.col("_key")) & F.col("doc_id").cast("long").eqNullSafe(F.col("_id"))
    return keyed.join(kept, same).dropDuplicates(["_key", "_id"]).select(*(F.col(f"`{c}`") for c in docs.columns))
