"""Joins, near duplicates, leaks and line dedup against plain versions."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import Row as SparkRow
from pyspark.sql import functions as F

from cinderspark.llm import decontaminate, embedding_dedup, jaccard_join, line_dedup, oracles, shared
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
Row = SparkRow("vec_id", "n_links", "component_id", "kept")


def rows_of(name, columns):
    return duckdb.sql(f"select {columns} from '{SMALL}/{name}.parquet'").fetchall()


def varied(seed=5, n=160, vocabulary=60):
    """Families of texts that differ in a few words, short texts, copies and empties."""
    rnd = random.Random(seed)
    word = lambda: "w%d" % rnd.randrange(vocabulary)
    texts = []
    for _ in range(n // 8):
        base = [word() for _ in range(rnd.choice([1, 3, 5, 8, 12, 40, 120]))]
        for _ in range(rnd.randrange(1, 9)):
            own = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
                at = rnd.randrange(len(own))
                own[at : at + rnd.choice([0, 1])] = [word()] * rnd.choice([0, 1])
                own = own or [word()]
            texts.append(" ".join(own) if rnd.random() < 0.7 else " ".join(own).upper())
    texts += [None, "", "  \t\n", "one", "one", "ONE"]
    rnd.shuffle(texts)
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("width,share", [(4, 85), (5, 80)])
@pytest.mark.parametrize("chunk", [512, 3])
def test_jaccard_components(spark, monkeypatch, width, share, chunk):
    monkeypatch.setattr(jaccard_join, "CHUNK", chunk)
    monkeypatch.setattr(jaccard_join, "KEYS_AT_ONCE", 200)
    rows = varied(n=400)
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, component_id string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.components(docs, jaccard_join.Rule(width, share)).collect()}
    assert got == brute.jaccard(rows, width, share)


def test_jaccard_on_documents(spark):
    rows = rows_of("documents", "doc_id, text")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.query(spark, SMALL).collect()}
    assert got == brute.jaccard(rows, 4, 85)


def test_jaccard_odd_rows(spark):
    """Rows of equal or null doc_id are judged each by its own text."""
    docs = spark.createDataFrame(
        [(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (2, None), (3, "A B c d E"), (3, "v w x y z"), (None, "q r s t u"), (4, "v w x y z"), (None, None)], "doc_id long, text string"
    ).withColumn("component", F.lit("x"))
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.components(docs, jaccard_join.Rule()).collect()), key=str)
    assert got == sorted([(1, 1, 1), (1, 1, 1), (None, 1, 1), (2, 0, 2), (3, 1, 1), (3, 1, 3), (None, 1, None), (4, 1, 3), (None, 0, None)], key=str)
    assert jaccard_join.components(docs.limit(0), jaccard_join.Rule()).count() == 0
    kept = jaccard_join.stage(spark, docs, SMALL)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted([(1, "a b c d e"), (2, None), (3, "v w x y z"), (None, "q r s t u"), (None, None)], key=str)


def test_group_keys_meet():
    rnd = np.random.default_rng(3)
    rule = jaccard_join.Rule(4, 85)
    for _ in range(300):
        n = int(rnd.integers(1, 80))
        a = np.unique(rnd.integers(0, 2**63, n).astype(np.uint64))
        b = a.copy()
        while True:
            c = b[1:] if rnd.random() < 0.5 and len(b) > 1 else np.unique(np.r_[b, rnd.integers(0, 2**63, 1).astype(np.uint64)])
            if not rule.linked(len(np.intersect1d(a, c)), len(a), len(c)):
                break
            b = c
            rnd.shuffle(b)
            b = np.array(b)
        assert set(jaccard_join.group_keys(a, rule)) & set(jaccard_join.group_keys(np.sort(b), rule))


def test_rtree_finds_all_that_fit():
    rnd = np.random.default_rng(1)
    rule = jaccard_join.Rule(4, 85)
    points = rnd.poisson(3, (300, 64)).astype(np.int32)
    points[150:] = points[:150]
    points[150:, 0] += 1
    sizes = points.sum(axis=1)
    tree = jaccard_join.RTree(points, sizes)
    for i in range(0, 300, 7):
        fit = {j for j in range(300) if np.minimum(points[i], points[j]).sum() >= rule.need(int(sizes[i]), int(sizes[j]))}
        assert set(tree.search(points[i], int(sizes[i]), rule).tolist()) == fit


@pytest.mark.parametrize("kind", ["float", "double"])
def test_embedding_links(spark, kind):
    rnd = np.random.default_rng(9)
    base = rnd.normal(size=(60, 16))
    x = np.vstack([base, base + rnd.normal(size=base.shape) * rnd.uniform(0, 0.6, (60, 1)), base[:9], 3 * base[:4]])
    x = x.astype(np.float32 if kind == "float" else np.float64)
    rows = [(int(i * 2 + 1), [float(v) for v in r], 0) for i, r in enumerate(x)]
    odd = [(1000, None, 1), (1001, [0.0] * 16, 1), (1002, [float("nan")] * 16, 1), (1003, [None] * 16, 1), (1004, [1.0, 2.0], 1), (1005, [], 1), (1006, [1.0] * 16, 1)]
    table = spark.createDataFrame(rows + odd, f"vec_id long, embedding array<{kind}>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_duplicates(table, tile_rows=20).collect()}
    y = x.astype(np.float64)
    norm = np.sqrt((y * y).sum(axis=1))
    near = (y @ y.T) / np.outer(norm, norm) >= 0.9
    ids = [r[0] for r in rows]
    linked = [(ids[i], ids[j]) for i, j in zip(*np.nonzero(near)) if i < j]
    group = brute.components(ids, linked)
    want = {d: (int(near[i].sum()) - 1, group[d], group[d] == d) for i, d in enumerate(ids)}
    want |= {d: (0, d, True) for d in range(1000, 1007)}
    assert got == want
    # Rows of equal or null ids are vectors of their own.
    twice = table.where("vec_id in (1, 1000)").unionByName(table.where("vec_id = 1").select(F.lit(None).cast("long").alias("vec_id"), "embedding", "label"))
    found = embedding_dedup.near_duplicates(twice.unionByName(table.where("vec_id = 1"))).collect()
    assert sorted(map(str, found)) == sorted(map(str, [Row(1, 2, 1, True), Row(1, 2, 1, True), Row(None, 2, 1, False), Row(1000, 0, 1000, True)]))
    assert embedding_dedup.near_duplicates(table.limit(0)).count() == 0


def test_quantised_bounds_are_rigorous():
    rnd = np.random.default_rng(2)
    t = embedding_dedup.Tile(np.arange(200), rnd.normal(size=(200, 64)))
    exact = (t.raw / t.norm[:, None]) @ (t.raw / t.norm[:, None]).T
    rough = embedding_dedup.products(t.wide, t.wide) * np.outer(t.scale, t.scale)
    assert (np.abs(exact - rough) <= t.error[:, None] + t.size[:, None] * t.error[None] + embedding_dedup.SLACK).all()
    wide = rnd.integers(-127, 128, (3, 3000)).astype(np.float32)
    assert (embedding_dedup.products(wide, wide) == wide.astype(np.int64) @ wide.astype(np.int64).T).all()


def test_leaks(spark):
    rnd = random.Random(4)
    items = [(i, " ".join("t%d" % rnd.randrange(50) for _ in range(rnd.choice([2, 5, 9, 30])))) for i in range(25)] + [(90, None), (91, ""), (92, "t1")]
    rows = []
    for d in range(120):
        text = ["t%d" % rnd.randrange(50) for _ in range(rnd.randrange(0, 90))]
        own = (rnd.choice(items)[1] or "").split()
        for _ in range(rnd.randrange(3)):
            if own:
                own[rnd.randrange(len(own))] = "changed"
        at = rnd.randrange(len(text) + 1)
        rows.append((d, " ".join(text[:at] + own + text[at:])))
    rows += [(200, None), (201, ""), (202, "t1"), (203, items[0][1].upper())]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r)[:4] for r in decontaminate.leaks(docs, bench).collect()}
    assert got == brute.leaks(rows, items)
    clean = {r["doc_id"] for r in decontaminate.contaminated_flag(docs, bench).where("not _leak").collect()}
    assert clean == {d for d, _ in rows} - {x[0] for x in got}


def test_short_items_in_long_documents(spark):
    rows = [(1, "what is truth exactly"), (2, "some words ahead of WHAT is\ttruth exactly and after it"), (3, "what is the truth exactly"), (None, "x what is truth exactly"), (None, "x what is truth exactly")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([("a", "What is truth exactly"), ("b", None), (None, "one two three four five six")], "item_id string, text string")
    got = sorted(((r["doc_id"], r["item_id"], r["n_held"]) for r in decontaminate.leaks(docs, items).collect()), key=str)
    assert got == [(1, "a", 1), (2, "a", 1), (None, "a", 1), (None, "a", 1)]
    assert [r["doc_id"] for r in decontaminate.contaminated_flag(docs, items).where("not _leak").collect()] == [3]


def test_leaks_in_blocks(spark, monkeypatch):
    whole = {tuple(r) for r in decontaminate.query(spark, SMALL).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 7)
    assert whole == {tuple(r) for r in decontaminate.query(spark, SMALL).collect()}
    docs, bench = (shared.read(spark, SMALL, t) for t in ("documents", "benchmark"))
    assert {r["doc_id"] for r in decontaminate.contaminated_flag(docs, bench).where("_leak").collect()} == {r[0] for r in whole}
    assert {r[:4] for r in whole} == brute.leaks(rows_of("documents", "doc_id, text"), rows_of("benchmark", "item_id, text"))
    none = shared.read(spark, SMALL, "benchmark").limit(0)
    assert decontaminate.leaks(shared.read(spark, SMALL, "documents"), none).count() == 0


def lines(seed, n):
    rnd = random.Random(seed)
    bases = [["v%d" % rnd.randrange(12) for _ in range(rnd.choice([3, 4, 5, 6, 9, 20]))] for _ in range(14)]
    out = []
    for d in range(n):
        text = []
        for _ in range(rnd.randrange(1, 7)):
            own = list(rnd.choice(bases))
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                at = rnd.randrange(len(own))
                own[at : at + rnd.choice([0, 1])] = ["v%d" % rnd.randrange(12)] * rnd.choice([0, 1, 1])
            text.append(" ".join(own))
        out.append((d, "\n".join(text)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_line_dedup(spark, seed, monkeypatch):
    rows = lines(seed, 60) + [(900, None), (901, ""), (902, "\n\n"), (903, "     "), (904, "a  b  c  d"), (905, "a  b  c  e\nx")]
    rows += [(906, "k l\tm n  o\n\tk l m n o p "), (907, "k l m n o\n    one two\none two"), (908, "\x0bq r s t u\r\nq\x0cr s t u w\r\nq\tr")]
    docs = spark.createDataFrame([(d, t, "k") for d, t in rows], "doc_id long, text string, lid string").repartition(3)
    want = brute.line_dedup(rows)
    for limit in (1_000_000, 0):
        monkeypatch.setattr(shared, "BROADCAST_ROWS", limit)
        monkeypatch.setattr(shared.checked_broadcast, "__defaults__", (limit,))
        found = line_dedup.dedup_lines(docs)
        got = {r["doc_id"]: (r["text"], r["n_exact"], r["n_near"]) for r in found.collect()}
        assert got == want
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_line_dedup_on_documents(spark):
    rows = rows_of("documents", "doc_id, text")
    got = {r["doc_id"]: (r["text"], r["n_exact"], r["n_near"]) for r in line_dedup.query(spark, SMALL).collect()}
    assert got == brute.line_dedup(rows)


def test_line_dedup_same_id(spark):
    text = "one two three four five six"
    docs = spark.createDataFrame([(1, text), (1, text + " seven"), (None, text)], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["text"]) for r in line_dedup.dedup_lines(docs).collect())
    assert got == [("1", ""), ("1", ""), ("None", text)]


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_line_dedup_of_repeated_rows(spark, limit, monkeypatch):
    monkeypatch.setattr(shared.checked_broadcast, "__defaults__", (limit,))
    one = "alpha beta gamma delta epsilon\n\nalpha beta gamma delta zeta\nshort\n \t"
    rows = [(7, one)] * 3 + [(None, one)] * 2 + [(None, None)] * 2 + [(8, "short"), (9, "other\nother"), (9, "other\nother"), (10, ""), (10, "")]
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, n_lines int, _t string").repartition(3)
    found = line_dedup.dedup_lines(docs)
    assert sorted(found.columns) == sorted(["doc_id", "text", "_t", "n_lines", "n_exact", "n_near"])
    got = sorted(((r["doc_id"], r["text"], r["n_exact"], r["n_near"]) for r in found.collect()), key=str)
    assert got == sorted(((d, *rest) for (d, _), rest in zip(rows, brute.line_dedup_rows(rows))), key=str)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert sorted(((r[0], r[1], r[3], r[4]) for r in con.execute(oracles.LINES).fetchall()), key=str) == got


def test_components(spark):
    rnd = random.Random(8)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 430)]
    frame = spark.createDataFrame(edges + [(None, 3), (5, None)], "a long, b long")
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    want = {n: c for n, c in brute.components(nodes, [e for e in edges if e[0] != e[1]]).items()} if nodes else {}
    got = {r["node"]: r["component"] for r in shared.connected(frame, "test").collect()}
    assert got == want
    assert shared.connected(frame.limit(0), "test").count() == 0
