"""Reading, shared folders, checked broadcasts and linked groups."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one or two numbers that may be broadcast; above it a shuffled join is used.
BROADCAST_ROWS = 1_000_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as a URI with its scheme.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset and all runs in one
    local JVM (tests) a temporary folder is made and set as the checkpoint folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        made = context._jsc.sc().getCheckpointDir
        if not made().isDefined():
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="cinderspark-shared-"))
        named = made().get()
    path, fs = _hadoop(context, named)
    # One form for Spark's readers and for pyarrow's file systems.
    whole = fs.makeQualified(path).toString().rstrip("/")
    return "file://" + whole.removeprefix("file:") if whole.startswith("file:/") and not whole.startswith("file://") else whole


def _hadoop(context, where: str):
    """Hadoop's path of ``where`` and its file system."""
    path = context._jvm.org.apache.hadoop.fs.Path(where)
    return path, path.getFileSystem(context._jsc.hadoopConfiguration())


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder below the shared folder, which goes when the driver ends, if not before."""
    where = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    path, fs = _hadoop(spark.sparkContext, where)
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return where


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends there."""
    spark = df.sparkSession
    path = scratch(spark, label) + "/rows"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes the files of tables made by ``stored`` that nothing reads any more."""
    for table in tables:
        path, fs = _hadoop(table.sparkSession.sparkContext, table._stored_at.removesuffix("/rows"))
        fs.delete(path, True)


def publish(fs, draft: str, final: str) -> None:
    """Moves a finished file into place; a repeated task's file is the same, so one that is there stays."""
    try:
        fs.move(draft, final)
    except OSError:
        if not fs.get_file_info(final).is_file:
            raise
        fs.delete_file(draft)


def checked_broadcast(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if its counted ``rows`` of a few numbers are within the limit."""
    return F.broadcast(df) if rows <= limit else df


def packed(docs: DataFrame, *beside: str) -> DataFrame:
    """``docs`` as one struct ``_row`` with some columns beside it, so that no name of theirs is in the way."""
    return docs.select(*beside, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def numbered(rows: DataFrame, key: str, label: str) -> DataFrame | None:
    """``rows`` written with a number ``_n`` for each, if the key repeats or is null somewhere; else None: the key will do."""
    if rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col(key).isNull() | (F.col("n") > 1)).isEmpty():
        return None
    return stored(rows.withColumn("_n", F.monotonically_increasing_id()), label)


def parallelism(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def connected(edges: DataFrame, label: str) -> DataFrame:
    """Components of ``edges`` (a long, b long): rows (node, component), component = smallest node.

    Alternating large-star and small-star steps; each step is one grouped minimum and one
    join, hot nodes are pre-aggregated, and each step is written to the shared folder.
    Nodes without edges do not appear. Null ends are ignored.
    """
    # Every edge points from the larger to the smaller node.
    def down(e: DataFrame) -> DataFrame:
        return e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()

    def state(e: DataFrame) -> tuple:
        row = e.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"),
        ).first()
        return (row["n"], row["s"])

    current = stored(down(edges.where("a is not null and b is not null")), label)
    seen = state(current)
    while seen[0]:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Large star: larger neighbours of u are tied to the least node around u.
        large = down(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        # Small star: u and its smaller neighbours are tied to the least of them.
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        last, current = current, stored(down(small), label)
        discard(last)
        now = state(current)
        if now == seen:
            break
        seen = now
    # Stars: every non-centre points at its centre.
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def unit(key: Column) -> Column:
    """A number in [0, 1) from a 64-bit hash."""
    return F.shiftrightunsigned(key, 11) / F.lit(float(1 << 53))
