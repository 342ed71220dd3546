"""Structured Streaming counterparts of the incremental jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cinderspark.functions import scalar as S
from cinderspark.operators import weather
from cinderspark.sources import sinks


def region_stream(spark: SparkSession, schema: str, inbox: str, table: str, ledger: str, checkpoint: str) -> StreamingQuery:
    """Region files as they arrive: each batch replaces its regions and is noted in the ledger.

    A batch that is repeated after a failure replaces the same partitions, so the table is right once
    the stream has caught up, whatever was lost.
    """
    arriving = spark.readStream.schema(schema).parquet(inbox)

    def absorb(batch: DataFrame, _: int) -> None:
        if batch.take(1):
            sinks.write_regions(batch, table, ledger)

    return arriving.writeStream.foreachBatch(absorb).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def hourly_direction_counts(hours: DataFrame, late: str = "2 hours") -> DataFrame:
    """Hours by sector for each pixel and day; late rows are taken up to the watermark.

    The counts are additive, so days sum to the whole distribution. Works on streams and tables.
    """
    marked = hours.withWatermark("ts", late) if hours.isStreaming else hours
    counted = marked.withColumn("code", S.wind_class("degrees")).groupBy(F.window("ts", "1 day").alias("day"), "pixel")
    return counted.agg(*weather.direction_counts("code")).select("pixel", F.col("day.start").alias("day"), *[f"n_{d.lower()}" for d in S.DIRECTIONS])
