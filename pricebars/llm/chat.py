"""Chat formatting: multi-party perspective rotation, in DataFrame functions only.

For every participant of a conversation (each role but ``system``) the dialogue is
rendered with that speaker as the assistant and all others as named users.  System
turns stay as they are.  The mask holds the character spans of the text that are
trained on: the own turns' content with its end mark.

A rendering is the whole dialogue, whatever its length.  One of over ``PART_ROWS`` turns is told in
several rows, in the order of ``part``: their texts, joined, are the rendering, and their masks
count characters from its beginning.  Turns are numbered without bringing a conversation
to one task: they are dealt in ranges of their order, and a turn's place is its place in
its range after all turns of the ranges before.  So a conversation may hold a third of all rows.

Defined cases: rows without a conversation id are a conversation of their own (NULL);
a NULL role is the speaker ``unknown``; a NULL text is empty; rows equal in all four
columns count once; turns of one number are ordered by role and text, NULL turns come
first; a conversation of only system turns has no participant and no rendering.  Marks within
a role or a text are broken up (``<|`` becomes ``<\\|``), and line breaks in a role become spaces,
so no turn can pose as another one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricebars.llm.settle import settled

PART_ROWS = 4096
SYSTEM, UNKNOWN = "system", "unknown"
START, END = "<|im_start|>", "<|im_end|>\n"
SPANS = "array<struct<start:bigint,end:bigint>>"


def _header(role: Column, speaker: Column) -> Column:
    return (F.when(role == SYSTEM, F.lit(f"{START}system\n"))
            .when(role == speaker, F.lit(f"{START}assistant\n"))
            .otherwise(F.concat(F.lit(f"{START}user name="), role, F.lit("\n"))))


def _broken(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<|im_start|>"), F.lit("<\\|im_start|>")), F.lit("<|im_end|>"), F.lit("<\\|im_end|>"))


def _same(*names: str) -> Column:
    out = F.lit(True)
    for n in names:
        out = out & F.col(n).eqNullSafe(F.col(f"_{n}"))
    return out


def _other(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumnsRenamed({n: f"_{n}" for n in names})


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` (different ones) with ``place``, their number in the order of their conversation."""
    order = ["turn", "role", "text"]
    ranged = settled(rows.repartitionByRange("conv_id", *order).withColumn("range", F.spark_partition_id()))
    counts = ranged.groupBy("conv_id", "range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("conv_id", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("conv_id", "range").orderBy(*order))
    return (ranged.withColumn("inside", inside).join(_other(counts, "conv_id", "range"), _same("conv_id", "range"))
            .withColumn("place", F.col("before") + F.col("inside") - 1).select(*rows.columns, "place"))


def _offsets(parts: DataFrame, rows: DataFrame, speakers: DataFrame) -> DataFrame:
    """``(_conv_id, _part, _speaker, begin)``: the characters of a rendering before a part after the first."""
    long = parts.filter("part > 0").select("conv_id").distinct()
    mine = parts.join(_other(long, "conv_id"), _same("conv_id"), "left_semi")
    # as if all others were users: the speaker's own turns differ by the length of their header
    size = F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + F.char_length(_header(t["role"], F.lit(None).cast("string"))) + F.char_length(t["text"]) + len(END))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = mine.select("conv_id", "part", size.alias("size")).withColumn("size", F.coalesce(F.sum("size").over(before), F.lit(0)))
    own = (rows.join(_other(long, "conv_id"), _same("conv_id"), "left_semi")
           .groupBy("conv_id", "part", F.col("role").alias("speaker")).agg(F.count(F.lit(1)).alias("own")))
    grid = sizes.join(_other(speakers, "conv_id"), _same("conv_id")).select("conv_id", "part", "size", "speaker")
    told = grid.join(_other(own, "conv_id", "part", "speaker"), _same("conv_id", "part", "speaker"), "left")
    earlier = Window.partitionBy("conv_id", "speaker").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spoken = F.coalesce(F.sum(F.coalesce("own", F.lit(0))).over(earlier), F.lit(0))
    differ = F.char_length(_header(F.col("speaker"), F.col("speaker"))) - F.char_length(_header(F.col("speaker"), F.lit(None).cast("string")))
    return _other(told.select("conv_id", "part", "speaker", (F.col("size") + spoken * differ).alias("begin")), "conv_id", "part", "speaker")


def rotate(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per (conversation, speaker, part): the rendered text and its mask."""
    name = F.translate(_broken(F.coalesce(F.col(role), F.lit(UNKNOWN))), "\n\r", "  ")
    rows = placed(turns.select(F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"), name.alias("role"),
                               _broken(F.coalesce(F.col(text), F.lit(""))).alias("text")).distinct())
    rows = settled(rows.withColumn("part", F.floor(F.col("place") / PART_ROWS).cast("long")))
    speakers = rows.filter(F.col("role") != SYSTEM).select("conv_id", F.col("role").alias("speaker")).distinct()
    parts = rows.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(F.struct("place", "role", "text"))).alias("turns"))
    views = parts.join(_other(speakers, "conv_id"), _same("conv_id")).drop("_conv_id")
    views = views.join(_offsets(parts, rows, speakers), _same("conv_id", "part", "speaker"), "left")
    pieces = F.transform("turns", lambda t: F.struct(
        _header(t["role"], F.col("speaker")).alias("head"), F.concat(t["text"], F.lit(END)).alias("body"), (t["role"] == F.col("speaker")).alias("own")))
    begin = F.coalesce("begin", F.lit(0)).cast("long")
    marked = F.aggregate("pieces", F.struct(begin.alias("at"), F.array().cast(SPANS).alias("spans")), lambda acc, p: F.struct(
        (acc["at"] + F.char_length(p["head"]) + F.char_length(p["body"])).alias("at"),
        F.when(p["own"], F.concat(acc["spans"], F.array(F.struct((acc["at"] + F.char_length(p["head"])).alias("start"), (acc["at"] + F.char_length(p["head"]) + F.char_length(p["body"])).alias("end")))))
        .otherwise(acc["spans"]).alias("spans")))["spans"]
    return (views.withColumn("pieces", pieces)
            .select("conv_id", "speaker", "part", F.size("turns").cast("long").alias("n_turns"),
                    F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), "").alias("text"), marked.alias("mask")))


def op6_perspectives(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    spans = F.array_join(F.transform("mask", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return rotate(turns).withColumn("mask", spans)


SQL = r"""
WITH t AS (
  SELECT DISTINCT conv_id, CAST(turn AS BIGINT) AS turn,
    translate(replace(replace(coalesce(role, 'unknown'), '<|im_start|>', '<\|im_start|>'), '<|im_end|>', '<\|im_end|>'), chr(10) || chr(13), '  ') AS role,
    replace(replace(coalesce(text, ''), '<|im_start|>', '<\|im_start|>'), '<|im_end|>', '<\|im_end|>') AS text FROM conversations),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system'),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place FROM t),
v AS (
  SELECT n.conv_id, s.speaker, CAST(n.place // 4096 AS BIGINT) AS part, n.place,
         CASE WHEN role = 'system' THEN '<|im_start|>system' || chr(10) WHEN role = speaker THEN '<|im_start|>assistant' || chr(10)
              ELSE '<|im_start|>user name=' || role || chr(10) END AS head,
         n.text || '<|im_end|>' || chr(10) AS body, role = speaker AS own
  FROM n JOIN s ON n.conv_id IS NOT DISTINCT FROM s.conv_id),
p AS (
  SELECT *, CAST(coalesce(sum(length(head) + length(body)) OVER (PARTITION BY conv_id, speaker ORDER BY place
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS at_char FROM v)
SELECT conv_id, speaker, part, CAST(count(*) AS BIGINT) AS n_turns, string_agg(head || body, '' ORDER BY place) AS text,
       coalesce(string_agg((at_char + length(head)) || '-' || (at_char + length(head) + length(body)), ',' ORDER BY place) FILTER (WHERE own), '') AS mask
FROM p GROUP BY conv_id, speaker, part
"""
