"""Structured Streaming forms of the batch operators on event time: deduplication, windows, sessions and states with an end.

Every function takes a streaming DataFrame and gives one; state is bounded by watermarks, so late rows beyond them are dropped,
and the batch forms in ``operators`` are authoritative. State lives in the checkpoint of the query, in the folder that all executors share.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import shared_dir


def read_events(spark: SparkSession, sf_dir: str, files_per_trigger: int = 4) -> DataFrame:
    """The events table as a stream of its files, with ts as a timestamp."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).option("pathGlobFilter", "*.parquet")
    return s.load(path=f"{sf_dir}/events*.parquet", format="parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def insert_once(events: DataFrame, keys: list[str], at: str, memory: str) -> DataFrame:
    """The first row of every key within the memory: ingest that may be repeated."""
    return events.withWatermark(at, memory).dropDuplicatesWithinWatermark(keys)


def recent(events: DataFrame, at: str, lateness: str, width: str, key: str) -> DataFrame:
    """Counts of a key in tumbling windows; rows later than ``lateness`` no longer count."""
    return events.withWatermark(at, lateness).groupBy(F.window(at, width), key).agg(F.count(F.lit(1)).alias("n"))


def cooldowns(events: DataFrame, at: str, key: str, failed: str, width: str, slide: str, least: int) -> DataFrame:
    """Keys with at least ``least`` rows in a sliding window, all of them failures."""
    w = events.withWatermark(at, slide).groupBy(F.window(at, width, slide), key)
    g = w.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.expr(failed)).alias("n_failed"))
    return g.where((F.col("n") >= least) & (F.col("n") == F.col("n_failed")))


def sessions(events: DataFrame, at: str, key: str, gap: str, lateness: str) -> DataFrame:
    """Sittings: stretches of a key without a gap as long as ``gap``."""
    return events.withWatermark(at, lateness).groupBy(key, F.session_window(at, gap).alias("s")).agg(F.count(F.lit(1)).alias("n_events"), F.max(at).alias("last"))


def drained(stream: DataFrame, mode: str = "append", what: str = "stream") -> DataFrame:
    """Runs a stream over all that is there and gives what it wrote, as a batch table."""
    spark = stream.sparkSession
    base = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    if mode == "append":
        q = stream.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").outputMode("append").trigger(availableNow=True).start()
    else:
        last = lambda df, epoch: df.write.mode("overwrite").parquet(f"{base}/out")
        q = stream.writeStream.foreachBatch(last).option("checkpointLocation", f"{base}/state").outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")
