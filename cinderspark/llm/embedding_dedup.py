"""Near-duplicate vectors by int8 tile products with rigorous error bounds.

Vectors are dealt into tiles by hash of their id and every pair of tiles is one task. In it
unit vectors x are quantised to ``s q``, q in [-127, 127], one scale s for each vector; the
error ``e = x - s q`` is measured, not estimated. Since ``x.y = (s q).(t r) + e.y + (s q).d``
for y = t r + d, the product of the quantised vectors is within ``|e| + |s q| |d|`` of the
cosine (Cauchy-Schwarz; |y| = 1), plus ``SLACK`` for rounding. Products of int8 values
are exact in float32 up to ``EXACT_DIMS`` dimensions at a time. Pairs that cannot reach the
threshold are left, pairs that cannot miss it are taken, and only the rest is computed
again in double precision.

A task returns its vectors' link counts and a spanning forest of its links, never the links
themselves: a dense group costs a row for each vector and pair of tiles, not one for each pair.
Components of the forests are found by ``shared.connected``. A vector is replicated once
for each tile, packed in binary rows.

Defined cases: null, empty and zero vectors, and those with null or non-finite components,
link with nothing, nor do vectors of different lengths; rows with equal or null ``vec_id`` are
vectors of their own (such tables are written once more, with a number for each row); a component
without any ``vec_id`` has null and is kept; an empty table gives no rows; labels and other
columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderspark.llm import shared

THRESHOLD = 0.9
#: Tiles have at least so many rows, and at most so many numbers; between, some four pairs of tiles a partition.
TILE_ROWS = 4096
TILE_NUMBERS = 4_000_000
#: Numbers in a block of products.
BLOCK_NUMBERS = 2_000_000
#: 1040 * 127 * 127 < 2 ** 24, the integers that float32 holds exactly.
EXACT_DIMS = 1040
SLACK = 2e-5


class Tile:
    """Unit vectors of a tile in double precision, and quantised."""

    def __init__(self, ids: np.ndarray, raw: np.ndarray):
        with np.errstate(over="ignore"):
            norm = np.sqrt(np.einsum("ij,ij->i", raw, raw))
        if len(odd := np.flatnonzero(~np.isfinite(norm) | (norm < 1e-140))):
            raw = raw.copy()
            raw[odd] /= np.abs(raw[odd]).max(axis=1)[:, None]
            norm[odd] = np.linalg.norm(raw[odd], axis=1)
        self.ids, self.raw, self.norm = ids, raw, norm
        unit = raw / self.norm[:, None]
        self.scale = np.abs(unit).max(axis=1) / 127
        self.q = np.rint(unit / self.scale[:, None]).astype(np.int8)
        back = self.q * self.scale[:, None]
        self.error = np.linalg.norm(unit - back, axis=1)
        self.size = np.linalg.norm(back, axis=1)
        self.wide = self.q.astype(np.float32)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 values held in float32."""
    if a.shape[1] <= EXACT_DIMS:
        return a @ b.T
    return sum((a[:, k : k + EXACT_DIMS] @ b[:, k : k + EXACT_DIMS].T).astype(np.float64) for k in range(0, a.shape[1], EXACT_DIMS))


def links(a: Tile, b: Tile, same: bool, threshold: float = THRESHOLD):
    """Blocks (i, j) of positions in a and b of the pairs with cosine >= threshold; i < j if same."""
    worst = float(b.error.max(initial=0))
    step = max(1, BLOCK_NUMBERS // max(1, len(b.ids)))
    for start in range(0, len(a.ids), step):
        rows = slice(start, min(start + step, len(a.ids)))
        near = products(a.wide[rows], b.wide)
        near *= b.scale.astype(np.float32)
        least = (threshold - SLACK - a.error[rows] - a.size[rows] * worst) / a.scale[rows]
        i, j = np.nonzero(near >= least.astype(near.dtype)[:, None])
        if same:
            i, j = i[(up := start + i < j)], j[up]
        if not len(i):
            continue
        score = near[i, j].astype(np.float64) * a.scale[start + i]
        gap = a.error[start + i] + a.size[start + i] * b.error[j] + SLACK
        sure = score - gap >= threshold
        for k in np.array_split(open_ := np.flatnonzero(~sure & (score + gap >= threshold)), max(1, math.ceil(len(open_) * a.raw.shape[1] / 4_000_000))):
            x, y = start + i[k], j[k]
            sure[k] = np.einsum("ij,ij->i", a.raw[x], b.raw[y]) / (a.norm[x] * b.norm[y]) >= threshold
        yield start + i[sure], j[sure]


def forest(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``labels`` (least position of each one's group) after the groups of i and j are joined pairwise."""
    while True:
        a, b = labels[i], labels[j]
        if not (apart := a != b).any():
            return labels
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while (labels[labels] != labels).any():
            labels = labels[labels]


def _tile(row: dict) -> Tile:
    ids = np.frombuffer(row["ids"], "<i8")
    return Tile(ids, np.frombuffer(row["vectors"], row["kind"]).reshape(len(ids), -1).astype(np.float64))


def _pair(table: pa.Table) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda r: r["tile"])
    a = _tile(rows[0])
    same = len(rows) == 1 and rows[0]["alone"]
    none = pa.table({"vec_id": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
    if len(rows) == 1 and not same:
        return none  # the other tile is empty
    b = a if same else _tile(rows[1])
    ids = a.ids if same else np.concatenate([a.ids, b.ids])
    order = np.argsort(ids, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(ids))
    counts, labels, shift = np.zeros(len(ids), np.int64), np.arange(len(ids)), 0 if same else len(a.ids)
    for i, j in links(a, b, same):
        x, y = place[i], place[shift + j]
        counts += np.bincount(x, minlength=len(ids)) + np.bincount(y, minlength=len(ids))
        labels = forest(labels, x, y)
    hit, ids = np.flatnonzero(counts), ids[order]
    return pa.table({"vec_id": pa.array(ids[hit]), "n": pa.array(counts[hit]), "root": pa.array(ids[labels[hit]])}) if len(hit) else none


def near_duplicates(vectors: DataFrame, tile_rows: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row for each vector."""
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    if (rows := shared.numbered(vectors, "vec_id", "vector-rows")) is None:
        return _near_duplicates(vectors, tile_rows)
    found = _near_duplicates(rows.select(F.col("_n").alias("vec_id"), "embedding"), tile_rows).toDF("_n", "n_links", "component", "kept")
    named = shared.stored(rows.select("_n", "vec_id").join(found, "_n"), "vector-named")
    least = named.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull())
    return named.join(least, "component").select("vec_id", "n_links", "component_id", kept.alias("kept"))


def _near_duplicates(vectors: DataFrame, tile_rows: int | None) -> DataFrame:
    """The same for vectors with distinct ids."""
    spark = vectors.sparkSession
    kind = "<f8" if dict(vectors.dtypes)["embedding"] == "array<double>" else "<f4"
    element = "double" if kind == "<f8" else "float"
    base = vectors.select("vec_id", F.col("embedding").cast(f"array<{element}>").alias("embedding"))
    whole = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    sound = base.where(F.col("embedding").isNotNull() & whole & F.exists("embedding", lambda x: x != 0))
    sizes = sound.groupBy(F.size("embedding").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    # T tiles make T(T + 1) / 2 pairs and send each vector T times: no more of them than tasks need.
    spread = F.greatest(F.lit(TILE_ROWS), F.col("n") / (2 * math.sqrt(2 * shared.parallelism(spark))))
    rows = F.lit(tile_rows) if tile_rows else F.greatest(F.lit(1), F.least(spread, F.lit(TILE_NUMBERS) / F.col("dims")))
    sizes = sizes.select("dims", F.ceil(F.col("n") / rows).alias("tiles"))
    dealt = sound.withColumn("dims", F.size("embedding")).join(F.broadcast(sizes), "dims")
    dealt = dealt.withColumn("tile", F.pmod(F.xxhash64("vec_id"), "tiles"))

    def pack(table: pa.Table) -> pa.Table:
        ids = table["vec_id"].combine_chunks().to_numpy(zero_copy_only=False).astype("<i8")
        flat = table["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(kind)
        first = {k: table[k][:1] for k in ("dims", "tiles", "tile")}
        return pa.table({**first, "kind": [kind], "ids": [ids.tobytes()], "vectors": [flat.tobytes()]})

    tiles = dealt.groupBy("dims", "tile").applyInArrow(pack, "dims int, tiles long, tile long, kind string, ids binary, vectors binary")
    tiles = shared.stored(tiles, "vector-tiles")
    # Each tile meets itself and each other tile once, whichever of the two is named first.
    meets = tiles.withColumn("other", F.explode(F.expr("sequence(0L, tiles - 1)")))
    meets = meets.select(
        "dims", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), "tile", (F.col("tile") == F.col("other")).alias("alone"), "kind", "ids", "vectors"
    )
    found = meets.groupBy("dims", "a", "b").applyInArrow(_pair, "vec_id long, n long, root long")
    found = shared.stored(found, "vector-links")
    shared.discard(tiles)
    counts = found.groupBy("vec_id").agg(F.sum("n").alias("n_links"))
    groups = shared.connected(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")), "vector-groups")
    joined = base.select("vec_id").join(counts, "vec_id", "left").join(groups.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(shared.read(spark, sf_dir, "embeddings"))
