"""Structured Streaming variants of the ledger and of event deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.scratch import fresh_path


def daily_quota(charges: DataFrame, late: str = "1 day") -> DataFrame:
    """Usage by provider and day, on a stream with a watermark or on a table."""
    timed = charges.withColumn("ts", F.col("ts").cast("timestamp"))
    timed = timed.withWatermark("ts", late) if charges.isStreaming else timed
    used = timed.groupBy("provider", F.window("ts", "1 day").alias("w")).agg(F.sum("delta").alias("used"), F.count("*").alias("n"))
    return used.select("provider", F.date_format("w.start", "yyyy-MM-dd").alias("day"), "used", "n")


def first_events(events: DataFrame, keys: list[str], late: str = "1 day") -> DataFrame:
    """Events once for each key within the watermark."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return timed.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys) if events.isStreaming else timed.dropDuplicates(keys)


def run_available(spark: SparkSession, stream: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream over what is there now, with its checkpoint and its output in the shared folder, and read the result.

    In update or complete mode each batch is kept and the last value of a key is for the reader to pick.
    """
    out, state = fresh_path(spark, "stream-out"), fresh_path(spark, "stream-state")
    if mode == "append":
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
    else:
        def save(batch: DataFrame, n: int) -> None:
            batch.write.mode("overwrite").parquet(f"{out}/batch={n}")

        query = stream.writeStream.outputMode(mode).foreachBatch(save).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema if mode == "append" else stream.schema.add("batch", "long")).parquet(out)
