"""Proportional stratified interleaving into equal shards; DataFrame functions only.

Rows of every source are shuffled by a seeded hash and ranked; the fractional rank
``(rank - 1/2) / rows of the source`` spreads each source evenly over (0, 1). Sorting all
rows by it and cutting the order into equal runs gives shards that all have the mixture
of the whole. No window ever holds a source: ranks are found inside narrow ranges of the
hash, with the ranges' counts summed beforehand, so a source with a third of all rows is
spread like the rest. Texts are read once and never shuffled.

Defined cases: null text has no bytes (size 16, CRC 0); null source is a source of its
own; rows with equal or null ``doc_id`` keep one place each, in an order fixed by hash,
CRC and size; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinderspark.llm import shared

SEED = 20240607
ROW_OVERHEAD = 16


def interleave(documents: DataFrame, shards: int = 40, seed: int = SEED, ranges: int | None = None) -> DataFrame:
    """One row per document: doc_id, source, size, text_crc32, shard, slot, position."""
    spark = documents.sparkSession
    ranges = ranges or 4 * shared.parallelism(spark)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(
        F.col("doc_id"),
        F.col("source"),
        F.concat(F.when(F.col("source").isNull(), "0").otherwise("1"), F.coalesce(F.col("source"), F.lit(""))).alias("stratum"),
        (F.octet_length(text) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    # Without its sign the hash has the order of its ranges.
    rows = rows.withColumn("h", F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size"), 1))
    at = F.least(F.floor(F.col("h") / F.lit(float(1 << 63)) * ranges), F.lit(ranges - 1)).cast("int")
    rows = shared.stored(rows.withColumn("r", at), "shard-rows")

    # Rank within the source = rows in lower hash ranges + rank within the range.
    counts = rows.groupBy("stratum", "r").agg(F.count(F.lit(1)).alias("n"))
    by_source = Window.partitionBy("stratum")
    before = by_source.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "stratum", "r", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("below"), F.sum("n").over(by_source).alias("total")
    )
    # Every join key is non-null by construction.
    in_range = Window.partitionBy("stratum", "r").orderBy("h", "doc_id", "text_crc32", "size")
    ranked = rows.withColumn("k", F.row_number().over(in_range)).join(counts, ["stratum", "r"])
    ranked = ranked.withColumn("fraction", (F.col("below") + F.col("k") - F.lit(0.5)) / F.col("total"))
    ranked = ranked.withColumn("f", F.least(F.floor(F.col("fraction") * ranges), F.lit(ranges - 1)).cast("int"))
    ranked = ranked.select("doc_id", "source", "stratum", "size", "text_crc32", "h", "fraction", "f")

    # Place in the whole order, the same way over ranges of the fraction.
    cells = ranked.groupBy("f").agg(F.count(F.lit(1)).alias("n"))
    # One row per range: a list of at most `ranges` numbers.
    whole = Window.orderBy("f")
    cells = cells.select(
        "f",
        F.coalesce(F.sum("n").over(whole.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("below"),
        F.sum("n").over(Window.partitionBy()).alias("total"),
    )
    in_cell = Window.partitionBy("f").orderBy("fraction", F.xxhash64(F.lit(seed), "stratum"), "stratum", "h", "doc_id", "text_crc32", "size")
    placed = ranked.withColumn("k", F.row_number().over(in_cell)).join(F.broadcast(cells), "f")
    position = F.col("below") + F.col("k") - 1
    placed = placed.withColumn("position", position).withColumn(
        "shard", F.expr(f"int((position * {shards}) div total)")
    )
    # First position p of a shard is the least with p * shards >= shard * total.
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return placed.select(
        "doc_id", "source", "size", "text_crc32", "shard", (F.col("position") - first).cast("long").alias("slot"), F.col("position").cast("long").alias("position")
    )


def query(spark, sf_dir: str) -> DataFrame:
    rows = interleave(shared.read(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source",
    )
