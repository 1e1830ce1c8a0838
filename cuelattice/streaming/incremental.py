"""Incremental runs: idempotent resume over new files, and sessions of words as they come."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Shares of the key space. A batch reads only the earlier keys of the shares that its own keys fall in.
SHARES = 64


def resume(spark: SparkSession, source: str, schema: str, work: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, key: str = "id") -> None:
    """Process every file of ``source`` that was not processed before, and stop.

    A batch writes to folders named by its number, replacing what an earlier attempt
    at the same batch left, so a retry repeats nothing. Within the batch, keys that any
    earlier batch has recorded are left out; of keys that a batch has twice, the last record
    (by file name and place) is taken. Files are tracked, not lines: new records must come as new
    files. Recorded keys lie in one table beside the results, partitioned by a hash of the
    key, so the check prunes to the shares at hand and lists one folder.
    """

    def batch(rows: DataFrame, number: int) -> None:
        names = [c for c in rows.columns if c not in (key, "_file")]
        last = F.max_by(F.struct(*names), F.struct("_file", "_line")) if names else F.lit(None)
        rows = rows.withColumn("_line", F.monotonically_increasing_id())
        fresh = rows.groupBy(key).agg(last.alias("last")).select(key, *(["last.*"] if names else []))
        done = _existing(spark, f"{target}/keys")
        if done is not None:
            share = F.pmod(F.xxhash64(key), F.lit(SHARES)).cast("int")
            shares = [r[0] for r in fresh.select(share).distinct().collect()]  # at most SHARES
            earlier = done.where(F.col("share").isin(shares) & (F.col("batch") < number)).select(F.col("key").alias("_done"))
            fresh = fresh.join(earlier, F.col(key) == F.col("_done"), "left_anti")
        out = f"{target}/results/batch={number}"
        work(fresh).write.mode("overwrite").parquet(out)
        keys = spark.read.parquet(out).select(F.col(key).alias("key"), F.pmod(F.xxhash64(key), F.lit(SHARES)).cast("int").alias("share"), F.lit(number).cast("long").alias("batch")).distinct()
        keys.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "share").parquet(f"{target}/keys")

    stream = spark.readStream.schema(schema).json(source).select("*", F.col("_metadata.file_path").alias("_file"))
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def results(spark: SparkSession, target: str) -> DataFrame:
    """What all batches of ``resume`` have written."""
    return spark.read.parquet(f"{target}/results").drop("batch")


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return spark.read.parquet(path) if there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(there) else None


def word_sessions(words: DataFrame, book: str, time: str, gap: str = "1 second", late: str = "10 seconds") -> DataFrame:
    """Streaming islands: words of a book less than ``gap`` apart, with their number and span. ``time`` is a timestamp column."""
    return (
        words.withWatermark(time, late)
        .groupBy(F.session_window(time, gap).alias("session"), book)
        .agg(F.count("*").alias("words"), F.min(time).alias("first"), F.max(time).alias("last"))
        .select(book, "first", "last", "words")
    )
