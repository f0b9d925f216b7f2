"""Session helpers shared by every operator: table access, lineage cuts and size checks."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def get_spark(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("annuary")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df in at least as many partitions as there are cores, for work that is heavy per row.

    A table of many files already is and stays as it is; only one of a few small files is dealt out anew.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def fan_out(df: DataFrame, *keys: str) -> DataFrame:
    """df over as many partitions as shuffles have (and cores there are), for work that is heavy per row.

    Rows that are few in bytes would otherwise be joined into one partition; a stated number is kept.
    """
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(n, *keys)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The reliable folder that all executors share.

    It is spark.checkpoint.dir of the session. Only a local session that names none (a test) gets a folder of
    its own.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            folder = os.path.join(tempfile.gettempdir(), "annuary-checkpoints")
        context.setCheckpointDir(folder)
    return context._jsc.sc().getCheckpointDir().get()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write df once to the reliable checkpoint folder, so that several readers share one computation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: A key is hot if it holds more than this part of the rows of a join's left side, and more than HOT_LEAST rows.
HOT_SHARE, HOT_LEAST = 1 / 1000, 10_000


def hot_keys(rows: DataFrame, keys: list[str], least: int = HOT_LEAST) -> DataFrame:
    """The keys that hold more than HOT_SHARE of the rows (and more than least): fewer than 1 / HOT_SHARE, however many
    rows there are, so that the list may be broadcast."""
    counted = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    total = counted.agg(F.sum("_n").alias("_total"))  # one row
    hot = F.col("_n") > F.greatest(F.lit(least), F.col("_total") * HOT_SHARE)
    return counted.join(F.broadcast(total)).where(hot).select(*keys)


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], spread_by: Column, parts: int, how: str = "inner") -> DataFrame:
    """Inner or left join on keys, where the left rows of each hot key are dealt over parts by the hash of spread_by.

    Only the right rows of hot keys are copied, so both sides keep their size. left should be written down
    (cut_lineage), since it is read twice. The broadcast is the list of hot keys, which is bounded.
    """
    hot = F.broadcast(hot_keys(left, keys).withColumn("_hot", F.lit(True)))
    dealt = F.when(F.col("_hot"), F.pmod(F.xxhash64(spread_by), F.lit(parts)).cast("int")).otherwise(0)
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    a = left.join(hot, keys, "left").withColumn("_part", dealt).drop("_hot")
    b = right.join(hot, keys, "left").withColumn("_part", F.explode(copies)).drop("_hot")
    return a.join(b, [*keys, "_part"], how).drop("_part")


def numbered(rows: DataFrame, order: list[Column], name: str = "ordinal") -> DataFrame:
    """rows with their place from 1 along the order, which must be total. No task sees more than its own range.

    The rows are dealt out in ranges and sorted inside each; places count on from the sizes of the ranges before.
    """
    ranged = cut_lineage(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    range_no, inside = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ranged.groupBy(range_no.alias("_range")).agg(F.count("*").alias("_n"))  # one row per range
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = ranged.withColumn("_range", range_no).join(F.broadcast(sizes.select("_range", before.alias("_before"))), "_range")
    return placed.withColumn(name, F.col("_before") + inside + 1).drop("_range", "_before", "_at")
