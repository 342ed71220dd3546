"""N-gram Jaccard join over a count-vector R-tree.

A document is the set of its distinct word shingles. Documents with equal sets are one
class; the join is among classes, and two link when
``100 * |A and B| >= share * |A or B|``.

1. *Groups.* Shingles are hashed into G groups. Linked sets differ in at most
   ``D = (|A| + |B|) (100 - share) / (100 + share)`` shingles, hence in at most D groups. G
   is fixed for each class of sizes, and a set takes part in its own size class and in those
   its larger partners may be in. Groups of few shingles say little (a common passage, or nothing at
   all), so a set hands on its D + 1 largest groups only, ties in order of place: as in any
   prefix filter, with one order for all, two sets that differ in D groups at most have one
   of these in common. A set with fewer groups of ``FULL`` shingles than that hands on all
   of them and goes on to a further grouping by other hashes, as do the partners that it has not met;
   the last grouping hands on every group. Equal groups (by hash of their whole content) are the partitions of the join.
   In each partition one set is paired with the others, and no others are: pairs are linear
   in the rows. Sets that such pairs connect are a family: all links are inside families.
2. *R-tree.* In each family an R-tree is packed over the vectors of group counts (how many
   shingles of a set fall into each of ``COORDINATES`` groups); ``sum of min(x, node's maximum)`` bounds the
   overlap with anything below a node, and ``sum of min(x, y)`` that with a set. First the
   vectors alone are searched; the contents of the sets with a possible partner follow, and
   pairs that pass are verified exactly until the two are connected. Small families share a task.
3. *Hot families.* One of more than ``CHUNK`` sets first has its own pairs of step 1
   verified (those that the bound lets pass), which connects most of it, and is then cut into
   chunks; the R-tree joins each pair of chunks. The largest connected part is never joined
   with itself, so copies of one text, however many, cost no more than their pairs.
4. Links become components with ``shared.connected``; copies join their class.

Only pairs inside one component are ever left unverified, so no link between components
is lost, and nothing is emitted for each pair of a group.

Defined cases: null text and text without words give an empty set, linked with nothing;
fewer words than a shingle make the whole sequence one shingle; rows with equal or null ``doc_id``
are documents of their own, each judged by its own text (such tables are written once more, with a
number for each row), and a component without any ``doc_id`` has null; of linked rows the stage keeps one,
the first of equal ``doc_id``; an empty table gives no rows; other columns are ignored. Whole texts are read.
"""

from __future__ import annotations

import functools
import itertools
import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderspark.llm import shared, words

COORDINATES = 256
#: Sets of a chunk of a hot family, which has more; rows of a cell of small families.
CHUNK = 512
CELL_ROWS = 1024
LEAF = 16
#: Size classes are [RATIO^c, RATIO^(c+1)).
RATIO = 1.25
GROUPINGS = 5
#: Least size of a group that tells sets apart.
FULL = 2


_HALF, _LOW = np.uint64(32), np.uint64(0xFFFFFFFF)


class Rule(NamedTuple):
    """Shingle width, and the least similarity in hundredths."""

    width: int = 5
    share: int = 80

    def linked(self, both: int, a: int, b: int) -> bool:
        return 100 * both >= self.share * (a + b - both)

    def need(self, a, b):
        """Least overlap of linked sets of sizes a and b."""
        return -(-self.share * (a + b) // (100 + self.share))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    own = words.tokens(text)
    return np.unique(words.run_hashes(words.hashes(own), width)) if own else np.zeros(0, np.uint64)


def size_class(n: int) -> int:
    return int(math.log(n) / math.log(RATIO) + 1e-9)


def _differ(a: int, b: int, rule: Rule) -> int:
    """In how many shingles linked sets of sizes a and b differ at most: a + b less twice their overlap."""
    return (a + b) * (100 - rule.share) // (100 + rule.share)


@functools.cache
def class_groupings(c: int, rule: Rule) -> tuple[int, list[tuple[int, int]]]:
    """(greatest size, [(groups, least size of a full one) of each grouping]) of size class c.

    The first grouping has few enough groups that nearly all sets of the class find more full
    ones than can differ; where two shingles a group are too many to ask, and in the later groupings, one will do.
    """
    top, low = math.ceil(RATIO ** (c + 1) + 1e-6), max(1, math.floor(RATIO**c) * rule.share // 100)
    need = _differ(low, top, rule) + 1

    def found(groups: int, full: int) -> float:
        """Full groups to be expected in the class's smallest set."""
        mean = low / groups
        return groups * (1 - math.exp(-mean) * (1 + mean * (full - 1)))

    out = []
    for full, slack in ((FULL, 1.04), *[(1, 1.2)] * (GROUPINGS - 1)):
        sizes = sorted({max(1, round(need * x / 20)) for x in range(20, 81)})
        out.append((next((g for g in sizes if found(g, full) >= slack * need), max(sizes, key=lambda g: found(g, full))), full))
    return top, out


def group_keys(shingles: np.ndarray, rule: Rule) -> np.ndarray:
    """Keys of the set's groups, over its size classes and as many groupings as it needs."""
    n, out = len(shingles), []
    if not n:
        return np.zeros(0, np.uint64)
    for c in range(size_class(n), size_class(n * 100 // rule.share) + 1):
        top, groupings = class_groupings(c, rule)
        least = _differ(n, top, rule) + 1
        for grouping, (groups, full) in enumerate(groupings):
            salt = np.uint64(xxhash.xxh3_64_intdigest(f"{rule.width}/{rule.share}/{c}/{grouping}".encode()))
            spread = words.mix(shingles ^ salt)
            place = ((spread >> _HALF) * np.uint64(groups) >> _HALF).astype(np.int64)
            counts = np.bincount(place, minlength=groups)
            # Exact sums of the halves of a second hash: below 2^53 for any set that fits memory.
            inner = words.mix(spread + salt)
            low = np.bincount(place, (inner & _LOW).astype(np.float64), groups).astype(np.uint64)
            high = np.bincount(place, (inner >> _HALF).astype(np.float64), groups).astype(np.uint64)
            with np.errstate(over="ignore"):
                content = words.mix(words.mix(low + salt) + words.mix(high ^ salt) + np.arange(groups, dtype=np.uint64))
            # One order for all sets: the largest groups first, equal ones by place.
            order = np.argsort(-counts, kind="stable")
            enough = int((counts >= full).sum())
            if enough >= least:
                out.append(content[order[:least]])
                break
            out.append(content[order[:enough]] if grouping < GROUPINGS - 1 else content)
    return np.concatenate(out)


def count_vector(shingles: np.ndarray) -> np.ndarray:
    return np.bincount((shingles >> np.uint64(56)).astype(np.int64), minlength=COORDINATES).astype(np.int32)


class RTree:
    """Packed over count vectors: sets in order of size, then of counts; nodes keep maxima and sizes."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points, sizes
        self.order = np.lexsort((*points.T[::-1], sizes)) if len(points) else np.zeros(0, np.int64)
        self.levels = []
        top, low, high = points[self.order], sizes[self.order], sizes[self.order]
        while len(top) > 1 or not self.levels:
            starts = np.arange(0, len(top), LEAF)
            top, low, high = np.maximum.reduceat(top, starts), np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
            self.levels.append((top, low, high))
        self.levels.reverse()

    def search(self, x: np.ndarray, size: int, rule: Rule) -> np.ndarray:
        """Positions whose overlap with x may suffice, the likeliest first."""
        nodes = np.zeros(1, np.int64)
        for depth, (top, low, high) in enumerate(self.levels):
            if depth:
                nodes = (nodes[:, None] * LEAF + np.arange(LEAF)).ravel()
                nodes = nodes[nodes < len(top)]
            least = rule.need(size, np.maximum(low[nodes], -(-rule.share * size // 100)))
            fits = (high[nodes] * 100 >= rule.share * size) & (low[nodes] * rule.share <= 100 * size)
            nodes = nodes[fits & (np.minimum(top[nodes], x).sum(axis=1) >= least)]
        at = (nodes[:, None] * LEAF + np.arange(LEAF)).ravel()
        at = self.order[at[at < len(self.order)]]
        bound = np.minimum(self.points[at], x).sum(axis=1)
        ok = bound >= rule.need(size, self.sizes[at])
        at, bound = at[ok], bound[ok]
        return at[np.argsort(-bound, kind="stable")]


class Chunk(NamedTuple):
    """Sets on one side of a join: their documents, connected parts, sizes, count vectors and, at last, contents."""

    nodes: list[int]
    parts: list[int]
    sizes: np.ndarray
    points: np.ndarray
    sets: list[np.ndarray] | None = None


def possible(left: Chunk, right: Chunk, rule: Rule) -> set[int]:
    """Documents with a partner on the other side that the bound allows and that is not connected to them."""
    tree, parts, out = RTree(right.points, right.sizes), np.array(right.parts), set()
    for i, node in enumerate(left.nodes):
        at = tree.search(left.points[i], int(left.sizes[i]), rule)
        at = at[parts[at] != left.parts[i]]
        if len(at):
            out.add(node)
            out.update(right.nodes[j] for j in at.tolist())
    return out


def tree_links(left: Chunk, right: Chunk, rule: Rule) -> list[tuple[int, int]]:
    """Links of documents across that connect different parts; a part is connected once."""
    root = {p: p for p in (*left.parts, *right.parts)}

    def find(p):
        while root[p] != p:
            root[p] = root[root[p]]
            p = root[p]
        return p

    tree, out = RTree(right.points, right.sizes), []
    for i, node in enumerate(left.nodes):
        for j in tree.search(left.points[i], int(left.sizes[i]), rule).tolist():
            if (a := find(left.parts[i])) != (b := find(right.parts[j])):
                both = len(np.intersect1d(left.sets[i], right.sets[j], assume_unique=True))
                if rule.linked(both, int(left.sizes[i]), int(right.sizes[j])):
                    root[max(a, b)] = min(a, b)
                    out.append((node, right.nodes[j]))
    return out


def _sets(documents: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, set_id, set: the binary set of each document."""

    def run(batches):
        for batch in batches:
            sets = [shingle_set(t.as_py(), rule.width).astype("<u8").tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(xxhash.xxh3_128_digest, sets), pa.binary()), pa.array(sets, pa.binary())], ["doc_id", "set_id", "set"]
            )

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, set_id binary, set binary")


#: What a task gathers before it hands its keys on; bounds its memory.
KEYS_AT_ONCE = 1_000_000
_DIGEST = pa.schema(
    [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.binary()), ("vector", pa.binary())]
    + [("bucket", pa.int32()), ("keys", pa.binary()), ("docs", pa.binary()), ("runs", pa.binary())]
)
_DIGEST_SQL = "doc_id long, n_shingles long, set_id binary, vector binary, bucket int, keys binary, docs binary, runs binary"
#: Keys are handed on without their bucket's share, as five bytes: equal ones by chance cost a pair to verify.
_KEY = np.dtype([("low", "<u4"), ("high", "u1")])


def _short(keys: np.ndarray) -> bytes:
    out = np.empty(len(keys), _KEY)
    out["low"], out["high"] = keys & _LOW, (keys >> _HALF) & np.uint64(255)
    return out.tobytes()


def _long(raw: bytes) -> np.ndarray:
    got = np.frombuffer(raw, _KEY)
    return got["low"].astype(np.uint64) | got["high"].astype(np.uint64) << _HALF


def _vector(counts: np.ndarray) -> bytes:
    return counts.astype("<u2" if counts.max(initial=0) < 65536 else "<u4").tobytes()


def _counts(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * COORDINATES else "<u4").astype(np.int32)


def _digests(documents: DataFrame, rule: Rule, buckets: int) -> DataFrame:
    """Rows of documents (doc_id, n_shingles, set_id, vector), and rows of keys packed by bucket.

    Copies of a set within a task hand on one document's keys, and equal keys within it are
    tied there (rows of bucket -1: pairs), so a bucket gets a key once from each task.
    """

    def packed(keys: list, docs: list):
        keys, docs = np.concatenate(keys), np.repeat(np.array([d for d, _ in docs], np.int64), [n for _, n in docs])
        order = np.lexsort((docs, keys))
        keys, docs = keys[order], docs[order]
        new = np.r_[True, keys[1:] != keys[:-1]]
        starts = np.flatnonzero(new)
        heads = np.repeat(docs[starts], np.diff(np.r_[starts, len(keys)]))
        tied = np.unique(np.stack([heads, docs])[:, ~new & (heads != docs)], axis=1)
        rows = [(-1, tied[0].astype("<i8").tobytes(), tied[1].astype("<i8").tobytes(), b"")] if tied.size else []
        keys, docs = keys[starts], docs[starts]
        # In order of document, which packs well.
        order = np.lexsort((keys, docs))
        keys, docs = keys[order], docs[order]
        bucket = ((keys >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for k in range(buckets):
            if edges[k] < edges[k + 1]:
                at = order[edges[k] : edges[k + 1]]
                own, runs = np.unique(docs[at], return_counts=True)
                rows.append((k, _short(keys[at]), own.astype("<i8").tobytes(), runs.astype("<u4").tobytes()))
        n = len(rows)
        none = [pa.nulls(n, kind) for kind in _DIGEST.types[:4]]
        return pa.RecordBatch.from_arrays([*none, *(pa.array([r[c] for r in rows], _DIGEST.types[4 + c]) for c in range(4))], schema=_DIGEST)

    def run(batches):
        keys, docs, held, met = [], [], 0, set()
        for batch in batches:
            sizes, ids, vectors = [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = shingle_set(text.as_py(), rule.width)
                sizes.append(len(own))
                vectors.append(_vector(count_vector(own)))
                ids.append(xxhash.xxh3_128_digest(own.astype("<u8").tobytes()))
                if doc is not None and len(own) and ids[-1] not in met:
                    met.add(ids[-1])
                    keys.append(group_keys(own, rule))
                    docs.append((doc, len(keys[-1])))
                    held += len(keys[-1])
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(vectors, pa.binary()), *(pa.nulls(n, k) for k in _DIGEST.types[4:])], schema=_DIGEST
            )
            if held >= KEYS_AT_ONCE:
                yield packed(keys, docs)
                keys, docs, held, met = [], [], 0, set()
        if held:
            yield packed(keys, docs)

    return documents.select("doc_id", "text").mapInArrow(run, _DIGEST_SQL)


def _met(table: pa.Table) -> pa.Table:
    """A document of each key in a bucket with each other one."""
    keys = np.concatenate([_long(k.as_py()) for k in table["keys"]])
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    del ordered
    if not len(twice):
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    # Most keys are one document's: only the others need their documents.
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    use = np.flatnonzero(twice[at] == keys)
    keys = at[use]
    del at
    docs = np.concatenate([np.repeat(np.frombuffer(d.as_py(), "<i8"), np.frombuffer(n.as_py(), "<u4")) for d, n in zip(table["docs"], table["runs"], strict=True)])[use]
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order]
    new = np.r_[True, keys[1:] != keys[:-1]]
    starts = np.flatnonzero(new)
    heads = np.repeat(docs[starts], np.diff(np.r_[starts, len(keys)]))
    tied = np.unique(np.stack([heads, docs])[:, ~new & (heads != docs)], axis=1)
    return pa.table({"a": pa.array(tied[0], pa.int64()), "b": pa.array(tied[1], pa.int64())})


def _pairs(table: pa.Table) -> pa.Table:
    """Pairs packed by the tasks that tied them."""
    a, b = (np.concatenate([np.frombuffer(x.as_py(), "<i8") for x in table[c]]) for c in ("keys", "docs"))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _numbers(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u8")


def _verified(pairs: DataFrame, rule: Rule) -> DataFrame:
    """a, b of the pairs (a, b, left, right: binary sets) that are linked."""

    def run(batches):
        for batch in batches:
            keep = []
            for i, (left, right) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                x, y = _numbers(left.as_py()), _numbers(right.as_py())
                keep.append(rule.linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def _bounded(pairs: DataFrame, rule: Rule) -> DataFrame:
    """a, b of the pairs (a, b, m, n: sizes, x, y: vectors) whose overlap may suffice."""

    def run(batches):
        for batch in batches:
            keep = [
                int(np.minimum(_counts(x), _counts(y)).sum()) >= rule.need(m, n) and 100 * min(m, n) >= rule.share * max(m, n)
                for m, n, x, y in zip(*(batch.column(c).to_pylist() for c in range(2, 6)), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "m", "n", "x", "y").mapInArrow(run, "a long, b long")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()


def _contents(documents: DataFrame, members: DataFrame, rule: Rule, label: str) -> DataFrame:
    """doc_id, set of the members (doc_id, set_id), from their whole texts."""
    members = shared.stored(members, f"{label}-ids")
    small = shared.checked_broadcast(members.select("doc_id"), members.count())
    sets = _sets(documents.join(small, "doc_id", "left_semi"), rule).join(members, ["doc_id", "set_id"], "left_semi")
    # Rows that repeat a document have one set.
    return shared.stored(sets.dropDuplicates(["doc_id"]).select("doc_id", "set"), f"{label}-sets")


def _cells(state: DataFrame, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of families in more than one part, as the tasks need them: cell, l, r, side, and state's columns; and a table to discard.

    Small families are dealt whole to cells of some thousand rows (side 0); the rows of a hot one go to
    each pair of its chunks that they are in, on the left (1) or the right (2). The few families with more than an eighth of a
    partition's share of the rows (at most 8 a partition, whatever the input) are broadcast: their rows stay where they are.
    """
    parts = state.groupBy("family", "part").agg(F.count(F.lit(1)).alias("n"))
    families = parts.groupBy("family").agg(F.sum("n").alias("n"), F.max(F.struct("n", "part")).alias("main"), F.count(F.lit(1)).alias("parts"))
    families = families.where("parts > 1").join(hot.select("family", F.lit(True).alias("hot")), "family", "left").select(
        "family", F.col("main.part").alias("main"), F.coalesce("hot", F.lit(False)).alias("hot"),
        F.ceil((F.col("n") - F.col("main.n")) / CHUNK).cast("int").alias("lefts"), F.ceil(F.col("n") / CHUNK).cast("int").alias("rights"),
    )
    families, n = shared.stored(families, "jaccard-cells"), state.count()
    large = F.greatest("rights", F.lit(1)) * CHUNK > max(CHUNK, n // (8 * shared.parallelism(state.sparkSession)))
    few = F.broadcast(families.where(large))
    rows = state.join(few, "family").unionByName(state.join(few.select("family"), "family", "left_anti").join(families.where(~large), "family"))
    number = -(-n // CELL_ROWS) or 1
    zero = F.lit(0)
    small = rows.where(~F.col("hot")).withColumns({"cell": F.pmod(F.xxhash64("family"), F.lit(number)), "l": zero, "r": zero, "side": zero})
    hashed, large = F.xxhash64("node"), rows.where("hot").withColumn("cell", -1 - F.pmod(F.xxhash64("family"), F.lit(1 << 40)))
    right = large.withColumn("r", F.pmod(hashed, "rights").cast("int")).withColumn("l", F.explode(F.sequence(zero, F.col("lefts") - 1))).withColumn("side", F.lit(2))
    left = large.where("part <> main").withColumn("l", F.pmod(hashed, "lefts").cast("int")).withColumn("r", F.explode(F.sequence(zero, F.col("rights") - 1))).withColumn("side", F.lit(1))
    return small.unionByName(right).unionByName(left).drop("main", "hot", "lefts", "rights"), families


def _chunks(table: pa.Table):
    """(left, right) of each family in a cell; a small family is both."""
    def chunk(rows: list) -> Chunk:
        return Chunk(
            [r["node"] for r in rows], [r["part"] for r in rows], np.array([r["n_shingles"] for r in rows], np.int64),
            np.array([_counts(r["vector"]) for r in rows]).reshape(len(rows), COORDINATES),
            [_numbers(r["set"]) for r in rows] if "set" in table.column_names else None,
        )

    rows = sorted(table.to_pylist(), key=lambda r: (r["family"], r["side"], r["node"]))
    for _, family in itertools.groupby(rows, key=lambda r: r["family"]):
        sides = {side: chunk(list(own)) for side, own in itertools.groupby(family, key=lambda r: r["side"])}
        if 0 in sides:
            yield sides[0], sides[0]
        elif len(sides) == 2:
            yield sides[1], sides[2]


def _named(rows: DataFrame, rule: Rule) -> DataFrame:
    """_n, doc_id, n_shingles, component (least _n of it) of the numbered rows."""
    found = _components(rows.select(F.col("_n").alias("doc_id"), "text"), rule).toDF("_n", "n_shingles", "component")
    return rows.select("_n", "doc_id").join(found, "_n")


def components(documents: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, n_shingles, component_id: one row for each of ``documents``."""
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if (rows := shared.numbered(documents, "doc_id", "jaccard-rows")) is None:
        return _components(documents, rule)
    named = shared.stored(_named(rows, rule), "jaccard-named")
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return named.join(least, "component").select("doc_id", "n_shingles", "component_id")


def _components(documents: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, n_shingles, component_id of documents with distinct ids."""
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spark = documents.sparkSession
    # A bucket takes the keys of about three shuffle partitions: sets that meet do so once in each bucket.
    buckets = -(-shared.parallelism(spark) // 3)
    digests = shared.stored(_digests(documents, rule, buckets), "jaccard-digests")
    # One row for each doc_id; then the first document of each set stands for it.
    single = digests.where("bucket is null").groupBy("doc_id").agg(F.min(F.struct("set_id", "n_shingles", "vector")).alias("d"))
    single = shared.stored(single.select("doc_id", "d.*"), "jaccard-documents")
    full = single.where("doc_id is not null and n_shingles > 0")
    heads = shared.stored(full.groupBy("set_id").agg(F.min("doc_id").alias("head")), "jaccard-heads")

    keyed = digests.where("bucket is not null").select("bucket", "keys", "docs", "runs")
    ties = keyed.where("bucket >= 0").groupBy("bucket").applyInArrow(_met, "a long, b long")

    def unpack(batches):
        for batch in batches:
            if batch.num_rows:
                yield from _pairs(pa.Table.from_batches([batch])).to_batches()

    ties = ties.unionByName(keyed.where("bucket < 0").select("keys", "docs").mapInArrow(unpack, "a long, b long"))
    # Pairs of documents become pairs of the sets' heads.
    head_of = full.select("doc_id", "set_id").join(heads, "set_id").select("doc_id", "head")
    met = ties.join(head_of.toDF("a", "x"), "a").join(head_of.toDF("b", "y"), "b")
    met = met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("a <> b").distinct()
    met = shared.stored(met, "jaccard-met")
    shared.discard(digests)
    vectors = shared.stored(full.join(_ends(met), "doc_id", "left_semi"), "jaccard-vectors")

    ids = vectors.select("doc_id", "set_id")
    families = shared.connected(met, "jaccard-families").withColumnRenamed("component", "family")
    hot = shared.stored(families.groupBy("family").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CHUNK), "jaccard-hot")
    star = spark.createDataFrame([], "a long, b long")
    if hot.count():
        # At most one family in CHUNK sets is hot; a family's own pairs connect most of it.
        own = families.join(hot.select("family"), "family", "left_semi").select(F.col("node").alias("a"))
        pairs = met.join(own, "a", "left_semi")
        pairs = pairs.join(vectors.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("n"), F.col("vector").alias("y")), "b")
        pairs = pairs.join(vectors.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("m"), F.col("vector").alias("x")), "a")
        likely = shared.stored(_bounded(pairs, rule), "jaccard-likely")
        sets = _contents(documents, _ends(likely).join(ids, "doc_id"), rule, "jaccard-stars")
        pairs = likely.join(sets.toDF("b", "right"), "b").join(sets.toDF("a", "left"), "a")
        star = shared.stored(_verified(pairs, rule), "jaccard-linked")
        shared.discard(sets, likely)
    linked = shared.connected(star, "jaccard-parts")
    state = families.join(linked, "node", "left").select("node", "family", F.coalesce("component", "node").alias("part"))
    state = shared.stored(state.join(vectors.withColumnRenamed("doc_id", "node").drop("set_id"), "node"), "jaccard-state")
    shared.discard(met)

    def search(table: pa.Table) -> pa.Table:
        found = set().union(*(possible(left, right, rule) for left, right in _chunks(table)))
        return pa.table({"node": pa.array(sorted(found), pa.int64())})

    def join(table: pa.Table) -> pa.Table:
        found = [link for left, right in _chunks(table) for link in tree_links(left, right, rule)]
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    cells, dealt = _cells(state, hot)
    open_ = shared.stored(cells.groupBy("cell", "l", "r").applyInArrow(search, "node long").distinct(), "jaccard-open")
    shared.discard(dealt)
    sets = _contents(documents, open_.join(ids.withColumnRenamed("doc_id", "node"), "node").select(F.col("node").alias("doc_id"), "set_id"), rule, "jaccard-open")
    # Cells are dealt again for what is left of the families, with the contents.
    rest = state.join(sets.withColumnRenamed("doc_id", "node"), "node")
    cells, dealt = _cells(rest, hot)
    more = shared.stored(cells.groupBy("cell", "l", "r").applyInArrow(join, "a long, b long"), "jaccard-tree")
    shared.discard(dealt)
    final = shared.connected(star.unionByName(more), "jaccard-final")
    shared.discard(more, state, open_, sets, vectors, hot)
    heads = heads.join(final, heads["head"] == final["node"], "left").select("set_id", F.coalesce("component", "head").alias("component_id"))
    return single.select("doc_id", "set_id", "n_shingles").join(heads, "set_id", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def stage(spark, docs: DataFrame, sf_dir: str, rule: Rule = Rule()) -> DataFrame:
    """Pipeline stage: of linked documents the one with the least doc_id stays."""
    keyed = shared.packed(docs, "text").select(F.col("_row.doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "_row")
    if (rows := shared.numbered(keyed, "doc_id", "jaccard-rows")) is None:
        found = _components(docs, rule).where("doc_id = component_id").select("doc_id")
        return docs.join(found, "doc_id", "left_semi").select(*docs.columns)
    first = _named(rows, rule).groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_n")).alias("first"))
    return rows.join(first.select(F.col("first._n").alias("_n")), "_n", "left_semi").select("_row.*")


def query(spark, sf_dir: str) -> DataFrame:
    return components(shared.read(spark, sf_dir, "documents"), Rule(width=4, share=85))
