"""Language identification: family first, then one-versus-one linear SVMs inside it.

A text's features are its letters' 1-, 2- and 3-byte n-grams, lower-cased, hashed into
``DIM`` counts, square-rooted and scaled to length one; whole texts are counted. Families
are learned, not listed: languages whose training centroids are closest are merged until
about the square root of the languages' number is left. One-versus-one linear support vector
machines (hinge loss, dual coordinate descent) choose the family, then those of the
family's languages choose the language, by votes, margins breaking ties.

Training texts are a sample bounded by ``SAMPLE_ROWS`` rows in all, an equal share for each
language, taken by least hash of ``doc_id`` from all labelled training rows; the driver
gets their feature counts only. Everything else runs on the executors without a shuffle.

Defined cases: a null text, or one with no letter (Unicode category L), is ``und`` with
score 0; with no labelled training row every text is ``und``; with one language every text
with a letter is that one, score 1. Ties of votes go to the larger margin, then to the
lesser name. Repeated rows get equal results; other columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinderspark.llm import shared

DIM = 4096
SAMPLE_ROWS = 1200
#: Bytes of a text whose n-grams are hashed at once.
BLOCK = 1 << 20
UNKNOWN = "und"
#: The pipeline's stage lets go what is ``und`` or scored below this.
LEAST_SCORE = 0.25

_LETTER = regex.compile(r"\p{L}")
_OTHER = regex.compile(r"[^\p{L}]+")


def features(text: str | None) -> np.ndarray | None:
    """Hashed counts as a unit vector; None if the text has no letter. Hashes of a very long text are made block by block."""
    if text is None or not _LETTER.search(text):
        return None
    whole = np.frombuffer((" " + _OTHER.sub(" ", text).lower() + " ").encode("utf-8", "replace"), np.uint8)
    counts = np.zeros(DIM, np.int64)
    for start in range(0, len(whole), BLOCK):
        raw = whole[start : start + BLOCK + 2].astype(np.uint32)  # n-grams that start in the block
        two = raw[:-1] * np.uint32(2654435761) + raw[1:] * np.uint32(40503)
        three = two[:-1] * np.uint32(2246822519) + raw[2:] * np.uint32(3266489917)
        grams = (raw[:BLOCK] * np.uint32(374761393) >> np.uint32(20), two[:BLOCK] >> np.uint32(20), (three ^ (three >> np.uint32(13))) * np.uint32(668265263) >> np.uint32(20))
        counts += np.bincount(np.concatenate(grams), minlength=DIM)
    found = np.sqrt(counts.astype(np.float32))
    return found / np.linalg.norm(found)


def svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 30, seed: int = 7) -> np.ndarray:
    """Weights (the last one the bias) of a linear hinge-loss SVM by dual coordinate descent; y in {-1, 1}."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    norms, alpha, w = np.einsum("ij,ij->i", x, x).astype(np.float64), np.zeros(len(x)), np.zeros(x.shape[1])
    order, random = np.arange(len(x)), np.random.default_rng(seed)
    for _ in range(rounds):
        random.shuffle(order)
        moved = 0.0
        for i in order:
            step = np.clip(alpha[i] - (y[i] * (w @ x[i]) - 1) / norms[i], 0, cost) - alpha[i]
            if step:
                alpha[i] += step
                w += step * y[i] * x[i]
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w


def families(centroids: dict[str, np.ndarray]) -> list[list[str]]:
    """Languages merged by closest mean centroid until about the root of their number is left."""
    groups = [[k] for k in sorted(centroids)]
    while len(groups) > max(1, round(len(centroids) ** 0.5)):
        means = [np.mean([centroids[k] for k in g], axis=0) for g in groups]
        means = [m / np.linalg.norm(m) for m in means]
        i, j = max(itertools.combinations(range(len(groups)), 2), key=lambda p: (float(means[p[0]] @ means[p[1]]), -p[0], -p[1]))
        groups[i] = sorted(groups[i] + groups.pop(j))
    return groups


class Contest:
    """One-versus-one machines among named classes."""

    def __init__(self, names: list[str], x: np.ndarray, labels: np.ndarray):
        self.names, self.pairs = names, list(itertools.combinations(range(len(names)), 2))
        rows = []
        for i, j in self.pairs:
            use = (labels == names[i]) | (labels == names[j])
            rows.append(svm(x[use], np.where(labels[use] == names[i], 1.0, -1.0)))
        self.w = np.array(rows).reshape(len(self.pairs), x.shape[1] + 1).astype(np.float32)

    def winner(self, x: np.ndarray) -> tuple[int, float]:
        """Its index, and the sigmoid of its least margin against another class."""
        if len(self.names) == 1:
            return 0, 1.0
        margins = self.w[:, :-1] @ x + self.w[:, -1]
        n = len(self.names)
        votes, sums, least = np.zeros(n), np.zeros(n), np.full(n, np.inf)
        for (i, j), m in zip(self.pairs, margins, strict=True):
            votes[i if m >= 0 else j] += 1
            for k, own in ((i, m), (j, -m)):
                sums[k] += own
                least[k] = min(least[k], own)
        best = max(range(n), key=lambda k: (votes[k], sums[k], -k))
        return best, float(1 / (1 + np.exp(-4 * np.clip(least[best], -20, 20))))


class Model:
    """Families, the machines between them, and those within each."""

    def __init__(self, x: np.ndarray, labels: np.ndarray):
        names = sorted(set(labels))
        self.families = families({k: x[labels == k].mean(axis=0) for k in names}) if names else []
        if not names:
            return
        tags = [str(i) for i in range(len(self.families))]
        of = {k: tags[i] for i, family in enumerate(self.families) for k in family}
        self.between = Contest(tags, x, np.array([of[k] for k in labels]))
        self.within = [Contest(f, x[np.isin(labels, f)], labels[np.isin(labels, f)]) for f in self.families]

    def predict(self, text: str | None) -> tuple[str, float]:
        x = features(text) if self.families else None
        if x is None:
            return UNKNOWN, 0.0
        family, sure = self.between.winner(x)
        language, surer = self.within[family].winner(x)
        return self.families[family][language], sure * surer


def sample(labelled: DataFrame, rows: int = SAMPLE_ROWS) -> list:
    """At most ``rows`` rows (lang, counts): an equal share for each language, by least hash of doc_id."""
    hashed = labelled.select("doc_id", "text", "lang").withColumn("h", F.xxhash64("doc_id"))
    counts = hashed.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    # At most `rows` languages are told apart: the most frequent ones.
    sizes = {r["lang"]: r["n"] for r in counts.orderBy(F.desc("n"), "lang").limit(rows).collect()}
    if not sizes:
        return []
    share = max(1, rows // len(sizes))
    # Cut by hash first, so that the ranking below holds a few shares a language, not all rows.
    odds = F.create_map(*[F.lit(v) for k, n in sizes.items() for v in (k, min(1.0, 2.0 * share / n + 20.0 / n))])
    near = hashed.where(shared.unit(F.col("h")) < odds[F.col("lang")])
    least = near.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id", F.xxhash64("text")))).where(F.col("k") <= share)

    def run(batches):
        for batch in batches:
            found = [features(t) for t in batch.column(1).to_pylist()]
            use = [i for i, x in enumerate(found) if x is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.column(0)[i].as_py() for i in use], pa.string()), pa.array([found[i].astype("<f4").tobytes() for i in use], pa.binary())], ["lang", "x"]
            )

    return least.select("lang", "text").mapInArrow(run, "lang string, x binary").collect()


def fit(labelled: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    got = sorted(((r["lang"], bytes(r["x"])) for r in sample(labelled.where("lang is not null and text is not null"), rows)))
    x = np.array([np.frombuffer(b, "<f4") for _, b in got], np.float32).reshape(len(got), DIM)
    return Model(x, np.array([k for k, _ in got], dtype=object))


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """All columns of ``documents`` with lang_pred and score (names of theirs in the way are replaced)."""
    held = documents.sparkSession.sparkContext.broadcast(model)  # DIM floats for each pair of a bounded number of languages
    rest = [c for c in documents.columns if c not in ("lang_pred", "score")]
    at = rest.index("text")

    def run(batches):
        for batch in batches:
            found = [held.value.predict(text) for text in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([k for k, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], [*rest, "lang_pred", "score"]
            )

    plain = documents.select(*rest)
    return plain.mapInArrow(run, plain.withColumn("lang_pred", F.lit("")).withColumn("score", F.lit(0.0)).schema)


def training(documents: DataFrame) -> DataFrame:
    """The labelled rows to learn from: crc32 of doc_id as text is not 2 modulo 4."""
    return documents.where((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2) & F.col("lang").isNotNull())


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without a recognisable language go."""
    judged = predict(shared.packed(docs, "text"), fit(training(docs)))
    return judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("_row.*")


def query(spark, sf_dir: str) -> DataFrame:
    docs = shared.read(spark, sf_dir, "documents")
    model = fit(training(docs))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return predict(docs.select("doc_id", "text"), model).select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score")
