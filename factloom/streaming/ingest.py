"""Incremental ingest of new documents, an extension of the batch operators to file streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def file_stream(spark: SparkSession, path: str, schema: StructType, files_a_trigger: int = 100) -> DataFrame:
    """New parquet files of a folder as they come."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_trigger).parquet(path)


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions of each user, closed by a gap; rows later than ``late`` behind the newest are left out."""
    ts = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if ts.isStreaming:
        ts = ts.withWatermark("ts", late)
    s = ts.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n_events"), F.round(F.sum("value"), 2).alias("total"))
    return s.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("started"), F.col("w.end").cast("timestamp_ntz").alias("ended"), "n_events", "total")


def each_batch(stream: DataFrame, step: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Runs a batch operator on every micro-batch and writes its result under the batch's number.

    A batch that is repeated after a failure overwrites its own folder, so each result is there once.
    """

    def write(df: DataFrame, epoch: int) -> None:
        step(df).write.mode("overwrite").parquet(f"{out}/batch={epoch}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
