"""Coalescing of inclusive integer intervals by run bitmaps.

Time is cut into shards of SHARD units. What an interval covers of a shard in part becomes a bitmap of one
64-bit word; the shards it covers whole are kept as one run (first, last), however many they are. Bitmaps of
an entity and shard are united by bit_or, which combines on the map side, so an entity with very many
intervals sends one word per shard and split. Set runs are then read off each word and joined across shards;
the clear runs between them are the gaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD = 60


def _mask(low: Column, high: Column) -> Column:
    """Bits low..high (0 <= low <= high < SHARD) of a word."""
    one = F.lit(1).cast("bigint")
    return F.call_function("shiftleft", F.call_function("shiftleft", one, (high - low + 1).cast("int")) - one, low.cast("int"))


def bitmap_cover(intervals: DataFrame, entity: str, low: str, high: str) -> DataFrame:
    """Disjoint set runs (entity, start, stop) inside shards, and whole-shard runs, of all intervals of an entity."""
    iv = intervals.select(F.col(entity).alias("e"), F.col(low).cast("bigint").alias("a"), F.col(high).cast("bigint").alias("b")).where(
        F.col("a") <= F.col("b")
    )
    first, last = F.floor(F.col("a") / SHARD), F.floor(F.col("b") / SHARD)
    off_a, off_b = F.col("a") - first * SHARD, F.col("b") - last * SHARD
    word = lambda shard, mask: F.struct(shard.cast("bigint").alias("shard"), mask.alias("mask"))
    full = F.lit((1 << SHARD) - 1).cast("bigint")
    words = (
        F.when(first == last, F.array(word(first, _mask(off_a, off_b))))
        .when(last == first + 1, F.array(word(first, _mask(off_a, F.lit(SHARD - 1))), word(last, _mask(F.lit(0), off_b))))
        .otherwise(F.array(word(first, _mask(off_a, F.lit(SHARD - 1))), word(last, _mask(F.lit(0), off_b))))
    )
    # A middle shard alone is a word too; a longer middle stays one compressed run.
    middle = F.when(last - first == 2, F.array(word(first + 1, full)))
    partial = (
        iv.select("e", F.explode(F.concat(words, F.coalesce(middle, F.array().cast("array<struct<shard:bigint,mask:bigint>>")))).alias("w"))
        .groupBy("e", "w.shard")
        .agg(F.bit_or("w.mask").alias("mask"))
    )
    bit = lambda i: F.call_function("getbit", F.col("mask"), i.cast("int"))
    every = F.sequence(F.lit(0), F.lit(SHARD - 1))
    starts = F.filter(every, lambda i: (bit(i) == 1) & ((i == 0) | (bit(F.greatest(i - 1, F.lit(0))) == 0)))
    stops = F.filter(every, lambda i: (bit(i) == 1) & ((i == SHARD - 1) | (bit(F.least(i + 1, F.lit(SHARD - 1))) == 0)))
    runs = partial.select("e", "shard", F.explode(F.arrays_zip(starts.alias("s"), stops.alias("t"))).alias("r")).select(
        "e", (F.col("shard") * SHARD + F.col("r.s")).alias("a"), (F.col("shard") * SHARD + F.col("r.t")).alias("b")
    )
    whole = (
        iv.where(last - first > 2)
        .select("e", ((first + 1) * SHARD).cast("bigint").alias("a"), (last * SHARD - 1).cast("bigint").alias("b"))
        .distinct()
    )
    return runs.unionByName(whole)


def periods_and_gaps(intervals: DataFrame, entity: str, low: str, high: str) -> DataFrame:
    """Columns (entity, kind, start, stop): every longest covered run as 'period', what lies between two as 'gap'.

    Rows whose low or high is null, or whose low exceeds high, cover nothing. Repeated, nested and touching
    intervals merge. A null entity is an entity. An empty table gives no rows.
    """
    pieces = bitmap_cover(intervals, entity, low, high)
    by = Window.partitionBy("e").orderBy("a", "b")
    before = F.max("b").over(by.rowsBetween(Window.unboundedPreceding, -1))
    heads = pieces.withColumn("head", (before.isNull() | (F.col("a") > before + 1)).cast("int"))
    numbered = heads.withColumn("run", F.sum("head").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    periods = numbered.groupBy("e", "run").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    follow = F.lead("a").over(Window.partitionBy("e").orderBy("a"))
    both = periods.withColumn("next", follow).select(
        "e",
        F.explode(
            F.filter(
                F.array(
                    F.struct(F.lit("period").alias("kind"), F.col("a").alias("start"), F.col("b").alias("stop")),
                    F.when(
                        F.col("next").isNotNull(),
                        F.struct(F.lit("gap").alias("kind"), (F.col("b") + 1).alias("start"), (F.col("next") - 1).alias("stop")),
                    ),
                ),
                lambda x: x.isNotNull(),
            )
        ).alias("x"),
    )
    return both.select(F.col("e").alias(entity), "x.kind", "x.start", "x.stop")
