"""Readers for the inputs that need more than ``spark.read.parquet``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from cinderspark.functions import geo


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN as null in every floating column: to be done once, on reading rasters."""
    kinds = {f.name: f.dataType for f in df.schema}
    return df.select(*[F.when(F.isnan(c), None).otherwise(F.col(c)).alias(c) if isinstance(kinds[c], FloatType | DoubleType) else F.col(c) for c in df.columns])


def headerless_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """All columns as text, as in files of codes with leading zeros."""
    return spark.read.csv(path, header=False, schema=", ".join(f"`{c}` string" for c in columns))


def csv_points(spark: SparkSession, path: str, x: str = "X", y: str = "Y") -> DataFrame:
    """A CSV with coordinates as features with a WKB point."""
    df = spark.read.csv(path, header=True, inferSchema=True)
    return df.withColumn("geometry", geo.point_wkb(F.col(x).cast("double"), F.col(y).cast("double")))


def hive_partitions(spark: SparkSession, path: str) -> DataFrame:
    """A hive-partitioned table whose codes stay text; filters on them prune folders."""
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        return spark.read.option("basePath", path).parquet(path)
    finally:
        spark.conf.set(key, before)


def folder_sizes(spark: SparkSession, path: str) -> DataFrame:
    """files, bytes of a folder tree; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("length")
    return files.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
