"""An extension: the ledger as a stream. Events are appended once, and the latest status of each key is kept as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def idempotent_append(target: str, keys: list[str]):
    """A foreachBatch function: each micro-batch is a folder named after its number, so a batch that is replayed after a crash replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.dropDuplicates(keys).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return write


def latest_by_key(spark: SparkSession, target: str, keys: list[str], *order: str) -> DataFrame:
    """The last row of each key over all batches."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return spark.read.option("basePath", target).parquet(target).withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r", "batch")


def windowed_counts(events: DataFrame, time: str, width: str, late: str, key: str) -> DataFrame:
    """Counts by tumbling event-time window and key; rows later than the watermark are left out."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), key, "n")


def start(events: DataFrame, target: str, checkpoint: str, keys: list[str]):
    """Starts the idempotent append of a stream and takes what is there."""
    return events.writeStream.foreachBatch(idempotent_append(target, keys)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
