"""Incremental ingest with Structured Streaming: late duplicates, windowed counts and keyed upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.operators.store import insert_or_ignore


def stream_tables(spark: SparkSession, folder: str, schema: T.StructType, files: int = 1) -> DataFrame:
    """New parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def first_within(stream: DataFrame, time: str, keys: list[str], delay: str) -> DataFrame:
    """The first row of each key, repetitions within ``delay`` dropped; state is bounded by the watermark."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, time: str, delay: str, size: str, slide: str | None, by: list[str]) -> DataFrame:
    """Rows of each time window and group; late rows beyond ``delay`` are dropped by the watermark."""
    window = F.window(time, size, slide) if slide else F.window(time, size)
    out = stream.withWatermark(time, delay).groupBy(window.alias("w"), *by).agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("window_start"), *by, "n")


def sessions(stream: DataFrame, time: str, delay: str, gap: str, key: str) -> DataFrame:
    """Sessions of a key: rows less than ``gap`` apart."""
    out = stream.withWatermark(time, delay).groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), key, "n")


def upsert_into(stream: DataFrame, target: str, keys: list[str], checkpoint: str) -> None:
    """Insert the rows of new keys into a parquet snapshot, batch by batch, then stop. Each batch writes the next snapshot
    ``target/batch=N`` beside the last, so a batch that is run again gives the same snapshot; older ones are deleted."""
    spark = stream.sparkSession

    def step(batch: DataFrame, n: int) -> None:
        path = lambda k: f"{target}/batch={k}"
        if n == 0:
            existing = spark.createDataFrame([], batch.schema)
        else:
            existing = spark.read.schema(batch.schema).parquet(path(n - 1))
        insert_or_ignore(existing, batch, keys).write.mode("overwrite").parquet(path(n))
        old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path(n - 2))
        old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)

    stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
