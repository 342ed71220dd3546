"""Hierarchical Pitman-Yor language model: seatings by Gibbs, averaged predictions.

Tokens are words (see ``words``) and one end token a text. The restaurant of a token is its
context, the token before it (the end token opens a text): every word of the corpus has its own.
Restaurants of contexts that end alike (one of ``CLASSES`` classes of the last two bytes) share a
parent, and these share the root, whose base is uniform over the V known types and one for all
unknown ones. ``p_u(w) = (c_uw - d t_uw + (theta + d T_u) p_parent(w)) / (theta + C_u)``.

The state is the number of customers and of tables of each dish in each restaurant; the sizes
of the tables are integrated out. A customer that leaves closes its table with probability
``S(c - 1, t - 1) / S(c, t)`` (generalised Stirling numbers: the chance that the last of c
exchangeable customers at t tables sits alone), and sits down again by the Chinese-restaurant rule;
closed and opened tables are customers that leave and enter the parent. A Gibbs sweep takes
every customer of every dish in every restaurant once (but a dish's only one, which can only open the same
table again): one by one up to ``TURNS`` customers, else in ``TURNS`` runs whose probabilities are
held. Predictions are averaged over ``SAMPLES`` sweeps after ``BURN_IN``. Discounts come from the counts of
dishes met once and twice at their level, where each dish in a restaurant below has one table.

Seatings of one dish touch, beyond its own customers and tables in all restaurants, only the
restaurants' totals. So dishes are dealt into buckets by hash, as many as the characters of the whole table
ask for (``BUCKET_CHARS``), whatever the partitions. Customers and distinct dishes of every
context are summed over the buckets exactly, dealt by context; while a bucket samples, the other
buckets' totals are these, moved in proportion to its own. No vocabulary and no restaurant is
gathered anywhere but in such shares; a hot word is one dish, summed up in the blocks first.

Texts are read once, in blocks of about ``BLOCK_CHARS`` characters. A block hands each bucket its
dishes and contexts with their counts, packed, and keeps its tokens in a file of the shared
folder. Buckets answer in the same order, and each block adds up its texts' scores. Texts are not shuffled.

Defined cases: null text is empty (one end token); a null ``doc_id`` is in training; rows
with equal ``doc_id`` are scored each; an empty table gives no rows; a text of any length is
whole in one block; without any training row every token is unknown; other columns are
ignored. Scores do not depend on the number of partitions.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.ipc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderspark.llm import shared, words

CLASSES = 64
BURN_IN, SAMPLES = 6, 4
#: A sweep moves the customers of a dish in so many runs.
TURNS = 16
THETA = 1.0
BLOCK_CHARS = 16_000_000
BUCKET_CHARS = 24_000_000
#: What other buckets' totals are moved by is one's own change, shrunk to the level's as if by so many more.
SHRINK = 8
#: Closing probabilities are tabulated up to so many customers and tables, and approximated beyond.
MOST_CUSTOMERS, MOST_TABLES = 2048, 256
#: No word holds white space.
END = b"\n"
SEED = 11

_HASH_BITS = np.uint64(34)
_HASH = np.uint64((1 << 34) - 1)


def context_ids(hashed: np.ndarray, known: list[bytes]) -> np.ndarray:
    """40 bits for the context that each word is for the next token: its class, then its hash."""
    ends = np.array([(w[-1], w[-2] if len(w) > 1 else 0) for w in known], np.uint64).reshape(len(known), 2)
    spread = words.mix(ends + np.uint64(1))
    # Eight classes of the last byte, eight of the one before.
    kind = (spread[:, 0] % np.uint64(8)) * np.uint64(8) + spread[:, 1] % np.uint64(8)
    return kind << _HASH_BITS | words.mix(hashed ^ np.uint64(SEED)) & _HASH


def packed(x: np.ndarray) -> bytes:
    """Numbers from 0 on, low bytes first, each byte's plane on its own, compressed."""
    x = np.ascontiguousarray(x, "<u8")
    width = max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + zstandard.compress(planes.tobytes(), 1)


def unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw[1:]), np.uint8).reshape(raw[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : raw[0]] = planes.T
    return out.view("<u8").ravel().astype(np.int64)


def packed_rising(x: np.ndarray) -> bytes:
    """The same for numbers that do not fall: their steps (64-bit numbers wrap around)."""
    x = np.asarray(x, np.uint64)
    return packed(np.diff(x, prepend=np.uint64(0)))


def unpacked_rising(raw: bytes) -> np.ndarray:
    return np.cumsum(unpacked(raw).astype(np.uint64), dtype=np.uint64)


# ---------------------------------------------------------------- restaurants


class Closing:
    """Probability that one of c exchangeable customers at t tables sits alone, for one discount."""

    def __init__(self, d: float):
        tables = np.arange(MOST_TABLES + 1)
        self.known = np.ones((MOST_CUSTOMERS + 1, MOST_TABLES + 1), np.float32)
        last = np.where(tables == 1, 0.0, -np.inf)
        for c in range(2, MOST_CUSTOMERS + 1):
            now = np.full(MOST_TABLES + 1, -np.inf)
            now[1:] = np.logaddexp(last[:-1], np.log(np.maximum(c - 1 - d * tables[1:], 1e-300)) + last[1:])
            upto = min(c, MOST_TABLES) + 1
            self.known[c, 1:upto] = np.exp(last[: upto - 1] - now[1:upto])
            last = now
        # Beyond: the saddle point of the tables' sizes, by their mean.
        s = np.geomspace(1e-6, 60, 2000)
        full, size = -np.expm1(-s), -np.expm1(-d * s) / d
        self.mean, self.alone = np.log(full * np.exp((1 - d) * s) / size), full / size

    def __call__(self, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        out = self.known[np.minimum(c, MOST_CUSTOMERS), np.minimum(t, MOST_TABLES)].astype(np.float64)
        if len(far := np.flatnonzero((c > MOST_CUSTOMERS) | (t > MOST_TABLES))):
            out[far] = (t[far] - 1) / c[far] * np.interp(np.log(c[far] / np.maximum(t[far], 1)), self.mean, self.alone)
        return out


class Level:
    """Dishes in the restaurants of one level: customers c and tables t.

    ``others`` are the other buckets' customers and tables of each restaurant where every dish in a
    restaurant below has one table; ``own`` are this bucket's.
    """

    def __init__(self, restaurant: np.ndarray, up: np.ndarray | None, customers: np.ndarray, others: tuple[np.ndarray, np.ndarray], discount: float):
        self.restaurant, self.up, self.discount = restaurant, up, discount
        self.others, self.closing = others, Closing(discount)
        n, known = len(others[0]), (customers > 0).astype(np.int64)
        self.own = [np.bincount(restaurant, x, n) for x in (customers, known)]
        # The first customer of each dish sits; the others are still to come.
        self.c, self.t, self.rest = known, known.copy(), customers - known
        self.sums = [self.own[1].copy(), self.own[1].copy()]
        self.beside = list(others)

    def refresh(self) -> None:
        """Moves the other buckets' totals in proportion to this one's."""
        self.beside = []
        for own, start, other in zip(self.sums, self.own, self.others, strict=True):
            whole = own.sum() / max(1.0, start.sum())
            self.beside.append(other * (own + SHRINK * whole) / (start + SHRINK))

    def move(self, own: np.ndarray, customers: np.ndarray, tables: np.ndarray, come_back: bool) -> None:
        """Adds to the distinct dishes ``own``; customers that ``come_back`` in the same turn stay in their restaurant's sum."""
        self.c[own] += customers
        self.t[own] += tables
        changes = [(1, np.flatnonzero(tables), tables)] if come_back else [(0, slice(None), customers), (1, np.flatnonzero(tables), tables)]
        for which, some, change in changes:
            np.add.at(self.sums[which], self.restaurant[own[some]], change[some].astype(np.float64))

    def fresh(self, own: np.ndarray) -> np.ndarray:
        """Weight of the parent in the restaurants of dishes ``own``."""
        r = self.restaurant[own]
        return THETA + self.discount * (self.sums[1][r] + self.beside[1][r])

    def predict(self, own: np.ndarray, base: np.ndarray) -> np.ndarray:
        """Probabilities of dishes ``own``, given those of their parents."""
        r = self.restaurant[own]
        return (self.c[own] - self.discount * self.t[own] + self.fresh(own) * base) / (THETA + self.sums[0][r] + self.beside[0][r])


def _summed_by(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``n`` for equal keys, which do not fall."""
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[at], np.add.reduceat(n, at)


class Whole(NamedTuple):
    """Sums over all buckets: tokens, types, discounts, and the parents' and the root's customers and tables."""

    tokens: int
    types: int
    discounts: tuple[float, float, float]
    parents: tuple[np.ndarray, np.ndarray]
    root: tuple[np.ndarray, np.ndarray]


class Seating:
    """The dishes of a bucket in all restaurants.

    Entries (dish, context) come in order of dish, then of the context's class. ``customers`` and
    ``tables`` are all buckets' totals of each context, the latter one for each dish in it.
    """

    def __init__(self, dish: np.ndarray, context: np.ndarray, kind: np.ndarray, counts: np.ndarray, customers: np.ndarray, tables: np.ndarray, whole: Whole, seed: int):
        self.random, self.types = np.random.default_rng([SEED, seed]), whole.types
        key = dish * CLASSES + kind[context]
        pair, up = np.unique(key, return_inverse=True)
        n = len(customers)
        own = (np.bincount(context, counts, n), np.bincount(context, counts > 0, n))
        leaf = Level(context, up, counts, (customers - own[0], tables - own[1]), whole.discounts[0])
        below = np.bincount(up, counts > 0, len(pair)).astype(np.int64)
        above = pair // CLASSES
        own = (np.bincount(pair % CLASSES, below, CLASSES), np.bincount(pair % CLASSES, below > 0, CLASSES))
        middle = Level(pair % CLASSES, above, below, tuple(w - o for w, o in zip(whole.parents, own, strict=True)), whole.discounts[1])
        below = np.bincount(above, below > 0, int(dish.max()) + 1).astype(np.int64)
        own = (np.array([below.sum()]), np.array([(below > 0).sum()]))
        root = Level(np.zeros(len(below), np.int64), None, below, tuple(w - o for w, o in zip(whole.root, own, strict=True)), whole.discounts[2])
        self.levels = [leaf, middle, root]
        for k in (2, 1, 0):
            self._settle(k)

    def _settle(self, k: int) -> None:
        """The customers still to come sit down one after the other, at frequent dishes in runs of a sixteenth of those seated."""
        level = self.levels[k]
        own = np.flatnonzero(level.rest)
        while len(own):
            n = np.minimum(level.rest[own], 1 + level.c[own] // TURNS)
            self.enter(k, own, n)
            level.rest[own] -= n
            own = own[level.rest[own] > 0]

    def _draw(self, n: np.ndarray, chance: np.ndarray) -> np.ndarray:
        out = (self.random.random(len(n)) < chance).astype(np.int64) * (n > 0)
        if len(many := np.flatnonzero(n > 1)):
            out[many] = self.random.binomial(n[many], np.clip(chance[many], 0, 1))
        return out

    def leave(self, k: int, own: np.ndarray, n: np.ndarray, come_back: bool = False) -> None:
        """``n`` customers of each of the distinct dishes ``own`` of level k leave."""
        level = self.levels[k]
        c, t = level.c[own], level.t[own]
        rest = c - n
        closed = np.clip(self._draw(n, level.closing(c, t)), np.maximum(0, t - rest), np.minimum(n, t - (rest > 0)))
        level.move(own, -n, -closed, come_back)
        if level.up is not None and len(some := np.flatnonzero(closed)):
            self.leave(k + 1, *_summed_by(level.up[own[some]], closed[some]))

    def enter(self, k: int, own: np.ndarray, n: np.ndarray, come_back: bool = False) -> None:
        """``n`` customers of each of the distinct dishes ``own`` of level k sit down; the first at an empty dish opens a table."""
        level = self.levels[k]
        c, t = level.c[own], level.t[own]
        first = (c == 0).astype(np.int64)
        new = level.fresh(own) * self.base(k, own)
        opened = first + self._draw(n - first, new / (new + np.maximum(c + first - level.discount * (t + first), 0)))
        level.move(own, n, opened, come_back)
        if level.up is not None and len(some := np.flatnonzero(opened)):
            self.enter(k + 1, *_summed_by(level.up[own[some]], opened[some]))

    def base(self, k: int, own: np.ndarray) -> np.ndarray:
        """The parent's probabilities of dishes ``own`` of level k."""
        if (up := self.levels[k].up) is None:
            return np.full(len(own), 1 / (self.types + 1))
        return self.levels[k + 1].predict(up[own], self.base(k + 1, up[own]))

    def sweep(self) -> None:
        """Every customer of every dish with more than one, in every restaurant, is seated anew."""
        for k, level in enumerate(self.levels):
            for each in self.levels:
                each.refresh()
            run, due = -(-level.c // TURNS), np.where(level.c > 1, level.c, 0)
            own = np.flatnonzero(due)
            while len(own):
                n = np.minimum(run[own], due[own])
                self.leave(k, own, n, come_back=True)
                self.enter(k, own, n, come_back=True)
                due[own] -= n
                own = own[due[own] > 0]

    def predictions(self) -> list[np.ndarray]:
        """Probabilities at the contexts, their parents and the root."""
        out = [np.full(len(self.levels[-1].c), 1 / (self.types + 1))]
        for level in reversed(self.levels):
            base = out[0] if level.up is None else out[0][level.up]
            out.insert(0, level.predict(np.arange(len(level.c)), base))
        return out[:-1]

    def averaged(self, burn_in: int = BURN_IN, samples: int = SAMPLES) -> np.ndarray:
        """Predictive probability of each entry, averaged over sampled seatings."""
        total = np.zeros(len(self.levels[0].c))
        for _ in range(burn_in):
            self.sweep()
        for _ in range(samples):
            self.sweep()
            for level in self.levels:
                level.refresh()
            total += self.predictions()[0]
        return total / samples


# --------------------------------------------------------------------- blocks

_FILE = pa.schema([("name", pa.string()), ("data", pa.binary())])


def _write(folder: str, name: str, parts: dict[str, bytes], *tables: tuple[str, pa.Table]) -> None:
    """A file of named bytes (tables as Arrow streams), moved into place when it is finished."""
    fs, base = pyarrow.fs.FileSystem.from_uri(folder)
    for key, table in tables:
        sink = pa.BufferOutputStream()
        with pyarrow.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        parts = {**parts, key: sink.getvalue().to_pybytes()}
    draft = f"{base}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(draft) as out, pyarrow.ipc.new_file(out, _FILE) as sink:
        for key, data in parts.items():
            sink.write_batch(pa.record_batch([[key], [data]], schema=_FILE))
    shared.publish(fs, draft, f"{base}/{name}")


def _read(folder: str, name: str) -> dict[str, bytes]:
    fs, base = pyarrow.fs.FileSystem.from_uri(folder)
    with fs.open_input_file(f"{base}/{name}") as source:
        table = pyarrow.ipc.open_file(source).read_all()
    return dict(zip(table["name"].to_pylist(), table["data"].to_pylist(), strict=True))


class _Block:
    """A block's words in the buckets' order (bucket, then hash), its contexts, and its distinct (word, context) entries."""

    def __init__(self, ids: np.ndarray, context: np.ndarray, lengths: np.ndarray, end: int):
        before = np.r_[end, ids[:-1]]
        before[np.r_[0, np.cumsum(lengths)[:-1]]] = end
        self.width = int(context.max()) + 1
        self.entries, self.codes = np.unique(ids * self.width + context[before], return_inverse=True)


def _blocks(documents: DataFrame, folder: str, buckets: int) -> DataFrame:
    """Blocks' dishes and contexts for each bucket: block, bucket, dishes, fan, contexts, at, counts (packed)."""
    names_of_parts = ("dishes", "fan", "contexts", "at", "counts")

    def told(block: int, names: dict, ids: list, train: list, doc_ids: pa.Array):
        known = list(names)
        hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, known), np.uint64, len(known))
        bucket = (words.mix(hashed) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((hashed, bucket))
        rank = np.empty(len(known), np.int64)
        rank[order] = np.arange(len(known))
        contexts, context = np.unique(context_ids(hashed, known)[order], return_inverse=True)
        lengths = np.array([len(x) for x in ids], np.int64)
        tokens = rank[np.concatenate(ids)]
        own = _Block(tokens, context, lengths, int(rank[names[END]]))
        counts = np.bincount(own.codes, np.repeat(np.array(train, bool), lengths), len(own.entries)).astype(np.int64)
        # Frequent words have low numbers in the file: they take fewer bytes.
        often = np.argsort(-np.bincount(tokens, minlength=len(known)), kind="stable")
        place = np.empty(len(known), np.int64)
        place[often] = np.arange(len(known))
        rows = pa.table({"doc_id": doc_ids, "train": pa.array(train, pa.bool_())})
        parts = {"tokens": packed(place[tokens]), "often": packed(often), "context": packed(context), "lengths": packed(lengths), "end": packed(rank[[names[END]]])}
        _write(folder, f"block-{block}.arrow", parts, ("rows", rows))
        dish, at = own.entries // own.width, own.entries % own.width
        edges = np.searchsorted(bucket[order][dish], np.arange(buckets + 1))
        for k in np.flatnonzero(np.diff(edges)).tolist():
            part = slice(edges[k], edges[k + 1])
            mine, fan = np.unique(dish[part], return_counts=True)
            met, number = np.unique(at[part], return_inverse=True)
            yield (
                block, k, packed_rising(hashed[order][mine]), packed(fan), packed_rising(contexts[met]), packed(number), packed(counts[part])
            )

    def run(batches):
        partition, number = TaskContext.get().partitionId(), 0
        kinds = (pa.int64(), pa.int32(), *[pa.binary()] * len(names_of_parts))

        def fresh():
            names: dict = defaultdict()
            names.default_factory = names.__len__
            names[END]
            return names, [], [], []

        def emit(names, ids, train, docs):
            rows = list(told(partition << 24 | number, names, ids, train, pa.concat_arrays(docs)))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], ["block", "bucket", *names_of_parts])

        names, ids, train, docs = fresh()
        chars = 0
        for batch in batches:
            begin = 0
            for i, (text, own) in enumerate(zip(batch.column(1), batch.column(2).to_pylist(), strict=True)):
                text = text.as_py()
                mine = words.tokens(text)
                mine.append(END)
                ids.append(np.fromiter(map(names.__getitem__, mine), np.int32, len(mine)))
                train.append(own)
                chars += len(text or "")
                if chars >= BLOCK_CHARS:
                    docs.append(batch.column(0)[begin : i + 1])
                    yield emit(names, ids, train, docs)
                    names, ids, train, docs = fresh()
                    begin, chars, number = i + 1, 0, number + 1
            docs.append(batch.column(0)[begin:])
        if ids:
            yield emit(names, ids, train, docs)

    return documents.mapInArrow(run, "block long, bucket int, " + ", ".join(f"{c} binary" for c in names_of_parts))


def _once_twice(n: np.ndarray) -> list[float]:
    return [float((n == 1).sum()), float((n == 2).sum())]


class _Bucket:
    """What all blocks handed a bucket, merged: distinct dishes, contexts and entries, and where each block's are."""

    def __init__(self, table: pa.Table):
        rows = sorted(table.to_pylist(), key=lambda r: r["block"])
        self.blocks = [r["block"] for r in rows]
        hashes, met = ([unpacked_rising(r[c]) for r in rows] for c in ("dishes", "contexts"))
        known, dish_of = np.unique(np.concatenate(hashes), return_inverse=True)
        self.contexts, context_of = np.unique(np.concatenate(met), return_inverse=True)
        dishes_at, contexts_at = (np.cumsum([0, *map(len, x)]) for x in (hashes, met))
        keys = []
        for k, r in enumerate(rows):
            own, around = dish_of[dishes_at[k] : dishes_at[k + 1]], context_of[contexts_at[k] : contexts_at[k + 1]]
            keys.append(np.repeat(own, unpacked(r["fan"])) * len(self.contexts) + around[unpacked(r["at"])])
        entries, place = np.unique(np.concatenate(keys), return_inverse=True)
        self.dish, self.context = entries // len(self.contexts), entries % len(self.contexts)
        self.counts = np.bincount(place, np.concatenate([unpacked(r["counts"]) for r in rows]), len(entries)).astype(np.int64)
        self.of_dish = np.bincount(self.dish, self.counts, len(known)).astype(np.int64)
        entries_at = np.cumsum([0, *map(len, keys)])
        self.places = [place[a:b] for a, b in zip(entries_at, entries_at[1:])]
        self.dishes = [dish_of[a:b] for a, b in zip(dishes_at, dishes_at[1:])]

    def sums(self) -> list[float]:
        """Tokens, types, dishes met once and twice at each level, and the parents' and the root's customers and tables."""
        known = self.counts > 0
        kind = (self.contexts >> _HASH_BITS).astype(np.int64)
        pair, below = np.unique(self.dish[known] * CLASSES + kind[self.context[known]], return_counts=True)
        above = np.bincount(pair // CLASSES, minlength=1)
        return [
            float(self.of_dish.sum()), float((self.of_dish > 0).sum()), *_once_twice(self.counts), *_once_twice(below), *_once_twice(above),
            *np.bincount(pair % CLASSES, below, CLASSES), *np.bincount(pair % CLASSES, minlength=CLASSES).astype(float), float(above.sum()), float((above > 0).sum()),
        ]

    def write(self, folder: str, bucket: int, part: np.ndarray) -> None:
        parts = {
            "dish": packed_rising(self.dish), "context": packed(self.context), "counts": packed(self.counts),
            "kind": packed(self.contexts >> _HASH_BITS), "part": packed(part),
        }
        blocks = pa.table(
            {
                "block": pa.array(self.blocks, pa.int64()),
                "places": pa.array([packed_rising(x) for x in self.places], pa.binary()),
                "dishes": pa.array([packed_rising(x) for x in self.dishes], pa.binary()),
            }
        )
        _write(folder, f"bucket-{bucket}.arrow", parts, ("blocks", blocks))


def _part(contexts: np.ndarray, parts: int) -> np.ndarray:
    return ((contexts & _HASH) * np.uint64(parts) >> _HASH_BITS).astype(np.int64)


def whole_of(sums: list[float]) -> Whole:
    tokens, types, *rest = sums
    discounts = tuple(float(np.clip(once / max(1.0, once + 2 * twice), 0.05, 0.95)) for once, twice in zip(rest[0:6:2], rest[1:6:2]))
    rest = np.array(rest[6:])
    return Whole(int(tokens), int(types), discounts, (rest[:CLASSES], rest[CLASSES : 2 * CLASSES]), (rest[-2:-1], rest[-1:]))


def score(documents: DataFrame, train) -> DataFrame:
    """doc_id, train, n_tokens, n_known, train_tokens, base_score, score; ``train`` is a boolean column."""
    spark = documents.sparkSession
    folder = shared.scratch(spark, "model-files")
    kind = dict(documents.dtypes)["doc_id"]
    documents = documents.select("doc_id", documents["text"].cast("string").alias("text"), F.coalesce(train, F.lit(True)).alias("train"))
    chars = documents.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(1, -(-chars // BUCKET_CHARS))

    # Round 1: a bucket's rows come together, are merged and kept; its contexts' sums go on, dealt by context.
    def merge(table: pa.Table) -> pa.Table:
        number = int(table["bucket"][0].as_py())
        bucket = _Bucket(table)
        n = len(bucket.contexts)
        customers, tables = np.bincount(bucket.context, bucket.counts, n).astype(np.int64), np.bincount(bucket.context, bucket.counts > 0, n).astype(np.int64)
        part = _part(bucket.contexts, buckets)
        bucket.write(folder, number, part)
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(buckets + 1))
        own = [(k, order[edges[k] : edges[k + 1]]) for k in np.flatnonzero(np.diff(edges)).tolist()]
        return pa.table(
            {
                "bucket": pa.array([number] * (len(own) + 1), pa.int32()),
                "part": pa.array([-1 - number, *(k for k, _ in own)], pa.int32()),
                "contexts": pa.array([None, *(packed_rising(bucket.contexts[at]) for _, at in own)], pa.binary()),
                "customers": pa.array([None, *(packed(customers[at]) for _, at in own)], pa.binary()),
                "tables": pa.array([None, *(packed(tables[at]) for _, at in own)], pa.binary()),
                "sums": pa.array([bucket.sums(), *[None] * len(own)], pa.list_(pa.float64())),
            }
        )

    # Round 2: sums of each context over the buckets that met it.
    def total(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        if rows[0]["sums"] is not None:
            return table.select(["bucket", "part", "customers", "tables", "sums"])
        met = [unpacked_rising(r["contexts"]) for r in rows]
        known, of = np.unique(np.concatenate(met), return_inverse=True)
        edges = np.cumsum([0, *map(len, met)])
        out = {}
        for c in ("customers", "tables"):
            whole = np.bincount(of, np.concatenate([unpacked(r[c]) for r in rows]), len(known)).astype(np.int64)[of]
            out[c] = pa.array([packed(whole[a:b]) for a, b in zip(edges, edges[1:])], pa.binary())
        none = pa.nulls(len(rows), pa.list_(pa.float64()))
        return pa.table({"bucket": table["bucket"], "part": table["part"], **out, "sums": none})

    blocks = _blocks(documents, folder, buckets)
    merged = blocks.groupBy("bucket").applyInArrow(merge, "bucket int, part int, contexts binary, customers binary, tables binary, sums array<double>")
    totals = merged.groupBy("part").applyInArrow(total, "bucket int, part int, customers binary, tables binary, sums array<double>")
    totals = shared.stored(totals, "model-totals")
    sums = totals.where("sums is not null").select(F.posexplode("sums").alias("k", "x")).groupBy("k").agg(F.sum("x").alias("x")).orderBy("k").collect()
    whole = whole_of([r["x"] for r in sums] or [0.0] * (2 * CLASSES + 10))

    # Round 3: each bucket is sampled, and answers its blocks.
    def sample(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        number = rows[0]["bucket"]
        held = _read(folder, f"bucket-{number}.arrow")
        kinds = unpacked(held["kind"])
        dish, context, counts = unpacked_rising(held["dish"]).astype(np.int64), unpacked(held["context"]), unpacked(held["counts"])
        # The rows hold the contexts in order of part, then as they are here.
        customers, tables = (np.empty(len(kinds), np.int64) for _ in range(2))
        order = np.argsort(unpacked(held["part"]), kind="stable")
        customers[order], tables[order] = (np.concatenate([unpacked(r[c]) for r in rows]) for c in ("customers", "tables"))
        seating = Seating(dish, context, kinds, counts, customers, tables, whole, number)
        logs = np.log10(seating.averaged()).astype("<f4").view("<u4")
        of_dish = np.bincount(dish, counts, int(dish.max()) + 1).astype(np.int64)
        answers = pa.ipc.open_stream(held["blocks"]).read_all().to_pylist()
        return pa.table(
            {
                "block": pa.array([r["block"] for r in answers], pa.int64()),
                "bucket": pa.array([number] * len(answers), pa.int32()),
                "counts": pa.array([packed(of_dish[unpacked_rising(r["dishes"]).astype(np.int64)]) for r in answers], pa.binary()),
                "logs": pa.array([packed(logs[unpacked_rising(r["places"]).astype(np.int64)]) for r in answers], pa.binary()),
            }
        )

    answers = totals.where("sums is null").drop("sums").groupBy("bucket").applyInArrow(sample, "block long, bucket int, counts binary, logs binary")

    def texts(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["bucket"])
        held = _read(folder, f"block-{rows[0]['block']}.arrow")
        tokens, lengths = unpacked(held["often"])[unpacked(held["tokens"])], unpacked(held["lengths"])
        own = _Block(tokens, unpacked(held["context"]), lengths, int(unpacked(held["end"])[0]))
        counts = np.concatenate([unpacked(r["counts"]) for r in rows])
        logs = np.concatenate([unpacked(r["logs"]).astype("<u4").view("<f4") for r in rows]).astype(np.float64)
        plain = np.log10((counts + 1) / (whole.tokens + whole.types + 1))
        starts = np.cumsum(lengths) - lengths
        total = lambda x: np.add.reduceat(x, starts)  # noqa: E731  every text has its end token
        texts_ = pa.ipc.open_stream(held["rows"]).read_all()
        n = len(texts_)
        return pa.table(
            {
                "doc_id": texts_["doc_id"], "train": texts_["train"], "n_tokens": pa.array(lengths, pa.int64()),
                "n_known": pa.array(total((counts[tokens] > 0).astype(np.int64)), pa.int64()), "train_tokens": pa.array(np.full(n, whole.tokens), pa.int64()),
                "base_score": pa.array(total(plain[tokens]), pa.float64()), "score": pa.array(total(logs[own.codes]), pa.float64()),
            }
        )

    return answers.groupBy("block").applyInArrow(
        texts, f"doc_id {kind}, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )


def query(spark, sf_dir: str) -> DataFrame:
    docs = shared.read(spark, sf_dir, "documents")
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    scored = score(docs, train)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
