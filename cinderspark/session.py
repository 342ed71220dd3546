"""Session settings shared by the command line, the bench and the tests."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

#: NTZ-safe UTC clock, adaptive plans, Arrow for the few Python stages, and hive
#: partition values kept as text so that ``state_fips='06'`` survives a round trip.
CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | None = None, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus or os.cpu_count()}]").appName("cinderspark")
    for key, value in CONF.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
