"""Record streams: incremental ingestion of JSON lines, and watched loss histories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.operators import turns
from siltworks.sources import MESSAGES


def read_records(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """A stream of the chat records of new files in a folder."""
    return spark.readStream.schema(MESSAGES).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def usable_records(stream: DataFrame) -> DataFrame:
    """Well-formed, usable records, once per content: first arrival wins, as a stream has no other order."""
    good = stream.where(F.col("_corrupt_record").isNull() & turns.usable())
    return good.withColumn("signature", turns.message_signature()).dropDuplicates(["signature"])


def ingest(spark: SparkSession, folder: str, out: str, checkpoint: str):
    """Process what is there and stop; a later call goes on after it. Returns the query."""
    return usable_records(read_records(spark, folder)).drop("_corrupt_record").writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)


def windowed_counts(events: DataFrame, time: str, key: str, width: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Counts per key and tumbling window of an event stream, with a watermark."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), key).count().select(F.col("window.start").alias("start"), key, "count")
