"""Token counts of documents in flat, unindexed token files by a separator scan.

A token file is nothing but little-endian ids, each document followed by the
end-of-document id. Blocks of a fixed number of ids are read from any file on their own and
searched for the separator at once with vector compares. A block reports where its first
and last separators stand and the gaps between the others; a prefix scan over the blocks of
a file (running count of separators, running maximum of the last one's place) then stitches
the documents that cross block boundaries, however many blocks they cover.

Defined cases: a null or empty text is a document of 0 tokens (a lone separator); an empty
file has no document; ids after the last separator form one document marked ``ended`` =
false; an empty table gives no rows; other columns are ignored. Files are written under a
temporary name and moved into place, so a repeated task leaves the same file.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cinderspark.llm import bpe, shared

#: Free in the rank file, which has ids 0 to 50,255.
SEPARATOR = 50_256
#: 50,257 ids fit into two bytes.
DTYPE = "<u2"
BLOCK_IDS = 1 << 20


def write_files(documents: DataFrame, folder: str, path: str = bpe.RANKS, separator: int = SEPARATOR, dtype: str = DTYPE) -> DataFrame:
    """Writes a flat file for each partition; returns the listing (file, ordinal, doc_id) of who is where.

    ``folder`` is a URI that driver and executors share. The listing is kept apart from the
    files: the scan never sees it.
    """
    spark = documents.sparkSession

    def run(batches):
        fs, base = pyarrow.fs.FileSystem.from_uri(folder)
        name = f"tokens-{TaskContext.get().partitionId():06d}.bin"
        fs.create_dir(base, recursive=True)
        draft = f"{base}/.{name}.{uuid.uuid4().hex}"
        n = 0
        with fs.open_output_stream(draft) as out:
            for batch in batches:
                for text in batch.column(1):
                    ids = bpe.encode(text.as_py(), path)
                    ids.append(separator)
                    out.write(np.asarray(ids, dtype=dtype).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * batch.num_rows, pa.string()),
                        pa.array(range(n, n + batch.num_rows), pa.int64()),
                        batch.column(0),
                    ],
                    ["file", "ordinal", "doc_id"],
                )
                n += batch.num_rows
        shared.publish(fs, draft, f"{base}/{name}")

    kind = dict(documents.dtypes)["doc_id"]
    listing = documents.select("doc_id", documents["text"].cast("string")).mapInArrow(run, f"file string, ordinal long, doc_id {kind}")
    return shared.stored(listing, "token-listing")


def blocks(spark: SparkSession, folder: str, dtype: str = DTYPE, block_ids: int = BLOCK_IDS) -> DataFrame:
    """file, block, start, ids: the ranges to read, from the files' lengths alone."""
    fs, base = pyarrow.fs.FileSystem.from_uri(folder)
    width = np.dtype(dtype).itemsize
    found = fs.get_file_info(pyarrow.fs.FileSelector(base, allow_not_found=True))
    rows = [(f.base_name, f.size // width) for f in found if f.is_file and not f.base_name.startswith((".", "_"))]
    files = spark.createDataFrame(rows, "file string, total long")
    ranges = files.where("total > 0").select("file", "total", F.explode(F.expr(f"sequence(0L, (total - 1) div {block_ids})")).alias("block"))
    ranges = ranges.select(
        "file", "block", (F.col("block") * block_ids).alias("start"), F.least(F.lit(block_ids), F.col("total") - F.col("block") * block_ids).alias("ids")
    )
    return ranges.repartition(shared.parallelism(spark), "file", "block")


def scan(spark: SparkSession, folder: str, separator: int = SEPARATOR, dtype: str = DTYPE, block_ids: int = BLOCK_IDS) -> DataFrame:
    """file, ordinal, n_tokens, ended: every document of every file, in file order."""
    width = np.dtype(dtype).itemsize

    def run(batches):
        fs, base = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(f"{base}/{row['file']}") as source:
                    raw = source.read_at(row["ids"] * width, row["start"] * width)
                at = np.flatnonzero(np.frombuffer(raw, dtype=dtype) == separator)
                first, last = (int(at[0]), int(at[-1])) if len(at) else (None, None)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["file"]], pa.string()),
                        pa.array([row["block"]], pa.int64()),
                        pa.array([row["start"] + row["ids"]], pa.int64()),
                        pa.array([len(at)], pa.int64()),
                        pa.array([None if first is None else row["start"] + first], pa.int64()),
                        pa.array([None if last is None else row["start"] + last], pa.int64()),
                        pa.array([np.diff(at) - 1], pa.list_(pa.int64())),
                    ],
                    ["file", "block", "stop", "found", "first", "last", "inner"],
                )

    seen = blocks(spark, folder, dtype, block_ids).mapInArrow(
        run, "file string, block long, stop long, found long, first long, last long, inner array<long>"
    )
    seen = shared.stored(seen, "token-blocks")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # The prefix scan needs no gaps: they are joined to its result, a few numbers a block.
    heads = seen.select(
        "file", "block", "stop", "found", "first",
        F.coalesce(F.sum("found").over(earlier), F.lit(0)).alias("before"),
        F.coalesce(F.max("last").over(earlier), F.lit(-1)).alias("behind"),
        F.coalesce(F.max("last").over(Window.partitionBy("file")), F.lit(-1)).alias("final"),
        F.max("stop").over(Window.partitionBy("file")).alias("length"),
        F.sum("found").over(Window.partitionBy("file")).alias("all_found"),
    )
    whole = seen.select("file", "block", "inner").join(heads.where("found > 0"), ["file", "block"])
    gaps = F.concat(F.array(F.col("first") - F.col("behind") - 1), "inner")
    ended = whole.select("file", "before", F.posexplode(gaps).alias("k", "n_tokens")).select(
        "file", (F.col("before") + F.col("k")).alias("ordinal"), "n_tokens", F.lit(True).alias("ended")
    )
    rest = heads.where("block = 0 and length > final + 1").select(
        "file", F.col("all_found").alias("ordinal"), (F.col("length") - F.col("final") - 1).alias("n_tokens"), F.lit(False).alias("ended")
    )
    return ended.unionByName(rest)


def count_tokens(documents: DataFrame, block_ids: int = BLOCK_IDS) -> DataFrame:
    """doc_id, file, ordinal, n_tokens of every document, by writing flat files and scanning them."""
    spark = documents.sparkSession
    folder = shared.scratch(spark, "token-files")
    listing = write_files(documents, folder)
    return listing.join(scan(spark, folder, block_ids=block_ids), ["file", "ordinal"]).select("doc_id", "file", "ordinal", "n_tokens", "ended")


def query(spark, sf_dir: str) -> DataFrame:
    return count_tokens(shared.read(spark, sf_dir, "documents")).select("doc_id", "n_tokens", "ordinal", "ended")
