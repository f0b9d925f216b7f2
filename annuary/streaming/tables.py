"""Structured Streaming counterparts: page passes that keep arriving, and windowed event counts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annuary.session import ensure_checkpoint_dir


def stream_of(spark: SparkSession, path: str, schema) -> DataFrame:
    """A stream of the files of a table, be it one file or a folder of them."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(f"{path}*")


def drain(result: DataFrame, keys: list[str], name: str | None = None) -> DataFrame:
    """Run a streaming aggregation over all that has arrived since the last time, and read its result by key.

    Each batch brings the keys whose value changed; they replace their rows in the stored result, which is written
    anew beside the old one, so a batch that runs twice changes nothing. State and results live below the reliable
    checkpoint folder under the given name, and the next call with it goes on from there, in this session or
    another one; a name must always be used for the same stream. Without a name nothing is kept for later.
    """
    spark = result.sparkSession
    at = f"{ensure_checkpoint_dir(spark).rsplit('/', 1)[0]}/stream-{name}" if name else f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    schema = result.schema

    def stored(batch: int) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{at}/result/{batch}") if batch >= 0 else spark.createDataFrame([], schema)

    def store(changed: DataFrame, batch: int) -> None:
        last = _last_batch(spark, at, batch)
        if last < 0:
            changed.write.mode("overwrite").parquet(f"{at}/result/{batch}")
            return
        # Written first, so that the state is read and changed once.
        changed.write.mode("overwrite").parquet(f"{at}/changed/{batch}")
        new = spark.read.schema(schema).parquet(f"{at}/changed/{batch}")
        old = stored(last).join(new.select(*keys), keys, "left_anti")
        old.unionByName(new).write.mode("overwrite").parquet(f"{at}/result/{batch}")

    query = result.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return stored(_last_batch(spark, at))


def _last_batch(spark: SparkSession, at: str, before: int | None = None) -> int:
    """The number of the last batch (before the given one) whose result is whole; -1 if there is none."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{at}/result")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return -1
    done = [int(f.getPath().getName()) for f in files.listStatus(folder) if files.exists(jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]
    return max((n for n in done if before is None or n < before), default=-1)


def latest_passes(records: DataFrame) -> DataFrame:
    """Per page the number of completed passes and the record that came last; late records update their page."""
    ok = records.where("status = 'ok'")
    return ok.groupBy("focus_page_number").agg(F.count("*").alias("n_passes"), F.max(F.struct("received_at", "record_id")).alias("m")).select(
        "focus_page_number", "n_passes", F.col("m.record_id").alias("last_record")
    )


def windowed_counts(events: DataFrame, length: str = "1 day", lateness: str = "2 days") -> DataFrame:
    """Events and their summed value per tumbling window and type, under a watermark.

    A window's state is dropped once the latest event is later than its end by the lateness; what comes for it
    after that is left out.
    """
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    return timed.groupBy(F.window("ts", length).alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("value")).select(
        F.col("w.start").alias("window_start"), "event_type", "n", "value"
    )
