"""Benchmark decontamination by size-partitioned MinHash containment search.

An item and a document are sets of five-word shingles (ASCII lower case, words between
white space; an item of k < 5 words is one shingle of k words, looked for in the k-word
shingles of every document). A document is contaminated by an item if it holds at least
``CONTAINMENT`` of the item's shingles.

Jaccard similarity says nothing about a short item in a long document, so the search is for
containment: a document that holds a share t of an item's n shingles misses at most
``n - ceil(t n)`` of them, hence holds at least one of the item's ``n - ceil(t n) + 1``
smallest shingle hashes, however long it is. Items are partitioned by size, and each
partition keeps minima enough for its largest item. These minima are an exact MinHash
filter: no leak is lost to chance. Documents are scanned once for each block of items;
their shingles are looked up in the block's sorted minima, and whatever meets is verified
by exact containment of the words themselves, not of hashes.

Items are read block by block (``BLOCK_ITEMS`` and ``BLOCK_CHARS`` bound what is broadcast);
beyond one block further scans follow, so a larger benchmark costs scans, not memory (the stage
writes its rows between two blocks, so that one block's index is held at a time). Documents are
never shuffled, however hot a passage is.

Defined cases: null or empty texts and items have no shingles and link with nothing;
repeated rows, and rows with null ids, are each reported; ids are of any type; ties are all
reported; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cinderspark.llm import shared, words

SHINGLE = 5
CONTAINMENT = 0.8
#: Bounds of one broadcast block of items.
BLOCK_ITEMS = 50_000
BLOCK_CHARS = 4_000_000


class Index:
    """Minima of a block of items, by partitions of size, and their whole shingles."""

    def __init__(self, items: list[tuple[int, str]], width: int = SHINGLE, share: float = CONTAINMENT):
        self.width, self.share = width, share
        self.items, short = [], []
        for key, text in items:
            own = words.tokens(text)
            if own:
                self.items.append((key, own))
                if len(own) < width:
                    short.append(len(own))
        #: Items of fewer words than a shingle are one run of their own length.
        self.lengths = sorted({*short, *([width] if any(len(w) >= width for _, w in self.items) else [])})
        self.shingles = [{tuple(w[i : i + k]) for i in range(len(w) - k + 1)} for _, w in self.items for k in (min(width, len(w)),)]
        self.need = [math.ceil(share * len(s) - 1e-9) for s in self.shingles]
        self.minima = {}
        for k in self.lengths:
            hashes, owners = [], []
            for i, s in enumerate(self.shingles):
                if len(next(iter(s))) == k:
                    kept = np.unique(np.array([words.hash_run(run) for run in s], np.uint64))[: self._kept(len(s))]
                    hashes.extend(kept.tolist())
                    owners.extend([i] * len(kept))
            order = np.argsort(np.array(hashes, np.uint64), kind="stable")
            self.minima[k] = (np.array(hashes, np.uint64)[order], np.array(owners, np.int64)[order])

    def _kept(self, n: int) -> int:
        """Minima enough for the largest size of the partition of n (sizes from 2^(j/2) to 2^((j+1)/2))."""
        top = math.ceil(2 ** ((math.floor(2 * math.log2(n)) + 1) / 2))
        return max(size - math.ceil(self.share * size - 1e-9) + 1 for size in range(n, max(n, top) + 1))

    def search(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item, shingles held, shingles) of every item that ``text`` holds."""
        own = words.tokens(text)
        if not own or not self.items:
            return []
        hashed, found = words.hashes(own), set()
        for k in self.lengths:
            if len(own) < k:
                continue
            runs = words.run_hashes(hashed, k)
            hashes, owners = self.minima[k]
            low = np.searchsorted(hashes, runs)
            low[low == len(hashes)] = 0
            for value in np.unique(runs[hashes[low] == runs]):
                a, b = np.searchsorted(hashes, [value, value], side="left")[0], np.searchsorted(hashes, value, side="right")
                found.update(owners[a:b].tolist())
        out, runs_of = [], {}
        for i in sorted(found):
            k = len(next(iter(self.shingles[i])))
            if k not in runs_of:
                # Only runs whose hash some candidate has are spelt out.
                wanted = np.array(sorted({words.hash_run(run) for j in found if len(next(iter(self.shingles[j]))) == k for run in self.shingles[j]}), np.uint64)
                at = np.flatnonzero(np.isin(words.run_hashes(hashed, k), wanted))
                runs_of[k] = {tuple(own[p : p + k]) for p in at.tolist()}
            held = len(self.shingles[i] & runs_of[k])
            if held >= self.need[i]:
                out.append((self.items[i][0], held, len(self.shingles[i])))
        return out


def _blocks(items: DataFrame):
    """Items block by block, each within the bounds."""
    block, chars = [], 0
    for row in items.select("item_id", "text").where("text is not null").toLocalIterator():
        if block and (len(block) >= BLOCK_ITEMS or chars + len(row["text"]) > BLOCK_CHARS):
            yield block
            block, chars = [], 0
        block.append((row["item_id"], row["text"]))
        chars += len(row["text"])
    if block:
        yield block


def leaks(documents: DataFrame, items: DataFrame, width: int = SHINGLE, share: float = CONTAINMENT) -> DataFrame:
    """doc_id, item_id, n_held, n_shingles, containment of every contaminated pair."""
    spark = documents.sparkSession
    kinds = (dict(documents.dtypes)["doc_id"], dict(items.dtypes)["item_id"])
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, n_held int, n_shingles int"
    found, id_type = None, to_arrow_type(items.schema["item_id"].dataType)
    for block in _blocks(items):
        held = spark.sparkContext.broadcast(Index(block, width, share))

        def run(batches, held=held):
            for batch in batches:
                rows = [(i, hit) for i, text in enumerate(batch.column(1)) for hit in held.value.search(text.as_py())]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([i for i, _ in rows], pa.int64())),
                        pa.array([hit[0] for _, hit in rows], id_type),
                        pa.array([hit[1] for _, hit in rows], pa.int32()),
                        pa.array([hit[2] for _, hit in rows], pa.int32()),
                    ],
                    ["doc_id", "item_id", "n_held", "n_shingles"],
                )

        part = documents.select("doc_id", documents["text"].cast("string")).mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], schema)
    return found.withColumn("containment", F.col("n_held") / F.col("n_shingles"))


def contaminated_flag(documents: DataFrame, items: DataFrame) -> DataFrame:
    """All columns of ``documents`` and ``_leak`` (true if some item is held); rows stay where they are."""
    spark, at = documents.sparkSession, documents.columns.index("text")
    flagged, written = documents.withColumn("_leak", F.lit(False)), []
    for number, block in enumerate(_blocks(items)):
        if number:
            # The scans of two blocks in one stage would hold both indexes.
            flagged = shared.stored(flagged, "leak-flags")
            written.append(flagged)
            if number > 1:
                shared.discard(written.pop(0))
        held = spark.sparkContext.broadcast(Index(block))

        def run(batches, held=held):
            for batch in batches:
                leak = [was or bool(held.value.search(text.as_py())) for text, was in zip(batch.column(at), batch.column(batch.num_columns - 1).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(leak, pa.bool_())], batch.schema.names)

        flagged = flagged.mapInArrow(run, flagged.schema)
    return flagged


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark item go."""
    flagged = contaminated_flag(shared.packed(docs, "text"), shared.read(spark, sf_dir, "benchmark"))
    return flagged.where(~F.col("_leak")).select("_row.*")


def query(spark, sf_dir: str) -> DataFrame:
    return leaks(shared.read(spark, sf_dir, "documents"), shared.read(spark, sf_dir, "benchmark"))
