"""Scoring, extraction, sharding, tokenizers and language identification on small inputs."""

import hashlib
import itertools
import math
import random
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cinderspark.llm import bpe, html_text, langid, pitman_yor, queries, shared, sharding, token_counts, words
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(columns="doc_id, text"):
    return duckdb.sql(f"select {columns} from '{SMALL}/documents.parquet' order by doc_id").fetchall()


def odd_rows(spark):
    """Nulls in every column, empties, ties, repeats and a very long text."""
    long = "word " * 60_000 + "x" * 50_000
    rows = [(None, None, None, None, None), (1, None, "en", "s", 0), (2, "", "en", None, 0), (3, " \n\t", None, "s", 3), (4, "one", "en", "s", 3), (4, "one", "en", "s", 3), (5, long, "en", "t", None), (6, "12 34 !!", "de", "t", 8)]
    return spark.createDataFrame(rows, DOCS)


# --------------------------------------------------------------------- words


def test_words_are_the_contract_s():
    for text in ["A B\tc\x0bD\x0cE\rF\nG", "\x1cÄ\xa0b C", "", " ", "ÉÀ Zz\x85y", "a　b"]:
        assert [w.decode() for w in words.tokens(text)] == brute.WORD.findall(brute.lower(text))
    assert words.tokens(None) == []


# ---------------------------------------------------------------------- op 1


def by_hand(rows, train):
    tokens = {i: [*words.tokens(t), pitman_yor.END] for i, t in rows}
    c = Counter(x for i, own in tokens.items() if train(i) for x in own)
    n, v = sum(c.values()), len(c)
    return {i: (len(own), sum(c[x] > 0 for x in own), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in own)) for i, own in tokens.items()}


def test_scores(spark, monkeypatch):
    rows = documents()
    train = lambda i: zlib.crc32(str(i).encode()) % 7 != 2
    monkeypatch.setattr(pitman_yor, "BLOCK_CHARS", 40_000)
    got = {r["doc_id"]: r for r in pitman_yor.query(spark, SMALL).collect()}
    want = by_hand(rows, train)
    assert set(got) == set(want)
    for i, (n, known, total, base) in want.items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (n, known, total, not train(i))
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and -math.inf < r["score"] < 0
    held = [got[i] for i in want if not train(i)]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_scores_of_odd_rows(spark):
    got = pitman_yor.score(odd_rows(spark), F.lit(True)).collect()
    assert len(got) == 8 and sum(r["n_tokens"] for r in got) == 1 + 1 + 1 + 1 + 2 + 2 + 60_002 + 4
    assert pitman_yor.score(odd_rows(spark).limit(0), F.lit(True)).count() == 0
    none = pitman_yor.score(odd_rows(spark), F.lit(False)).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["score"] == 0 for r in none)


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(pitman_yor, "BUCKET_CHARS", 150_000)
    docs = shared.read(spark, SMALL, "documents")
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    for partitions, parts, chars in (("4", 2, 16_000_000), ("16", 5, 60_000)):
        monkeypatch.setattr(pitman_yor, "BLOCK_CHARS", chars)
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        rows = pitman_yor.score(docs.repartition(parts, "doc_id"), F.col("doc_id") % 3 != 0).collect()
        found.append({r["doc_id"]: (r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6)) for r in rows})
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def seating(dish, context, counts, kind, discounts=None, types=None, seed=0):
    """A bucket that holds everything."""
    n = len(kind)
    customers, tables = np.bincount(context, counts, n).astype(np.int64), np.bincount(context, counts > 0, n).astype(np.int64)
    known = counts > 0
    pair, below = np.unique(dish[known] * pitman_yor.CLASSES + kind[context[known]], return_counts=True)
    above = np.unique(pair // pitman_yor.CLASSES, return_counts=True)[1]
    kinds = pair % pitman_yor.CLASSES
    parents = (np.bincount(kinds, below, pitman_yor.CLASSES), np.bincount(kinds, minlength=pitman_yor.CLASSES))
    whole = pitman_yor.Whole(int(counts.sum()), types or len(above), discounts or (0.6, 0.5, 0.4), parents, (np.array([above.sum()]), np.array([len(above)])))
    return pitman_yor.Seating(dish, context, kind, counts, customers, tables, whole, seed)


def entries(seed, dishes=40, contexts=30):
    rng = np.random.default_rng(seed)
    kind = np.sort(rng.integers(0, 5, contexts))
    pairs = sorted({(int(rng.integers(dishes)), int(rng.integers(contexts))) for _ in range(300)} | {(d, 0) for d in range(dishes)})
    dish, context = (np.array(c) for c in zip(*pairs))
    return dish, context, rng.poisson(rng.exponential(6, len(dish))).astype(np.int64), kind


@pytest.mark.parametrize("seed", range(3))
def test_seatings_stay_whole(seed):
    dish, context, counts, kind = entries(seed)
    s = seating(dish, context, counts, kind, seed=seed)
    for _ in range(12):
        assert np.array_equal(s.levels[0].c, counts)
        for below, above in itertools.pairwise(s.levels):
            # A table is a customer of the parent.
            assert np.array_equal(np.bincount(below.up, below.t, len(above.c)).astype(int), above.c)
        for level in s.levels:
            assert ((level.t <= level.c) & ((level.t > 0) == (level.c > 0))).all()
            n = len(level.others[0])
            assert np.array_equal(level.sums[0], np.bincount(level.restaurant, level.c, n)) and np.array_equal(level.sums[1], np.bincount(level.restaurant, level.t, n))
            assert not level.others[0].any() and not level.others[1].any()
        s.sweep()


def test_predictions_sum_to_one():
    """In one bucket that holds all known dishes in every restaurant, with one more for what is unknown."""
    known, contexts = 30, 20
    dish, context = (x.ravel() for x in np.meshgrid(np.arange(known + 1), np.arange(contexts), indexing="ij"))
    counts = np.random.default_rng(0).poisson(2, len(dish)).astype(np.int64)
    counts[dish == known] = 0
    p = seating(dish, context, counts, np.arange(contexts) // 4, types=known).averaged(2, 3)
    assert np.allclose(np.bincount(context, p), 1)


@pytest.mark.parametrize("d", [0.2, 0.7])
def test_closing_probabilities(d):
    """Against all ways to part customers, and near the edge of the table against what is used beyond it."""
    def weight(sizes):
        return math.prod(math.prod(j - d for j in range(1, n)) for n in sizes)

    def partitions(n):
        if n == 0:
            yield []
            return
        for rest in partitions(n - 1):
            yield [*rest, 1]
            for i in range(len(rest)):
                yield [x + (i == k) for k, x in enumerate(rest)]

    known = pitman_yor.Closing(d)
    for n in range(2, 8):
        total, alone = Counter(), Counter()
        for parts in partitions(n):
            total[len(parts)] += weight(parts)
        for parts in partitions(n - 1):
            alone[len(parts) + 1] += weight(parts)
        for t in range(1, n + 1):
            assert known(np.array([n]), np.array([t]))[0] == pytest.approx(alone[t] / total[t], rel=1e-5)
    at = np.array([2, 10, 60, 250])
    c = np.full(4, pitman_yor.MOST_CUSTOMERS)
    assert np.allclose(known(c + 1, at), known(c, at), rtol=0.07)


def test_sweep_reseats_every_customer(monkeypatch):
    """Each customer of a dish with more than one leaves its table once a sweep, however many there are."""
    dish, context = np.array([0, 0, 1, 2]), np.array([0, 9, 0, 5])
    counts = np.array([20_000, 37, 2, 1])
    s = seating(dish, context, counts, np.arange(10) // 3)
    left = np.zeros(4, np.int64)
    leave = s.leave

    def watched(k, own, n, come_back=False):
        if k == 0:
            left[own] += n
        leave(k, own, n, come_back)

    monkeypatch.setattr(s, "leave", watched)
    s.sweep()
    assert left.tolist() == [20_000, 37, 2, 0] and s.levels[0].c.tolist() == counts.tolist()


def test_sampling_agrees_with_a_plain_model():
    """Averaged predictions against a sampler that keeps every table and moves one customer at a time."""
    dish, context, counts, kind = entries(5, dishes=12, contexts=8)
    counts = np.minimum(counts, 9)
    plain = brute.pitman_yor(dish, context, counts, kind, (0.6, 0.5, 0.4), pitman_yor.THETA, int(len(set(dish[counts > 0]))), 60, 400)
    gap = np.log10(seating(dish, context, counts, kind).averaged(60, 900)) - np.log10(plain)
    # Two runs of the plain sampler with other seeds differ by 0.06 at most.
    assert np.abs(gap).max() < 0.09 and abs(gap.mean()) < 0.01 and abs((gap * counts).sum() / counts.sum()) < 0.005


# ---------------------------------------------------------------------- op 4

ARTICLE = "<h1>The &amp; title</h1><p>First paragraph with some words in it,  and\nmore.</p><p>Second <b>paragraph<br>goes</b> on for a while with text.</p><p>Ok.</p>"
WANT = "The & title First paragraph with some words in it, and more. Second paragraph goes on for a while with text. Ok."
FRAME = "<html><head><title>T</title><style>p{{}}</style><script>var t=\"</p><article>\";</script></head><body>{}</body></html>"


@pytest.mark.parametrize(
    "body",
    [
        "<nav><ul><li><a href='/a'>Menu entry</a></li></ul></nav><article>{}</article><footer>&copy; Somebody with a long imprint that has text</footer>",
        "<div class='ad'>Buy this thing now and be happy</div><article>{}</article><footer>x",
        "<header><h2>Site</h2></header><main>{}</main><aside>A sidebar with a good deal of text inside it, more than one would like</aside>",
        "<div id='cookie-notice'>We use cookies for many purposes that are listed here</div><div class='content'>{}</div><div class='comments'><p>I liked this article very much, thank you for writing all this down</p></div>",
        "<article>{}<form><label>Your mail address here</label><input type=text></form><section id=comments><h3>Comments</h3><article class=comment><p>What a long and wonderful comment this is, is it not</p></article></section></article>",
        "<table><tr><td><a href=x>Home page</a><br><a href=y>Other page</a></td><td>{}</td></tr></table><div>All rights reserved by someone</div>",
        "<div>Home | About | Contact us now</div><div>{}</div><div>Somebody's imprint stands here with an address</div>",
        "<div class='layout sidebar-left'>{}</div>",
        "<div><div class='sidebar-widget'><p>Other text of the site in a widget</p></div><div class='post-body'>{}</div></div><div class='related'><a href=x>Another story that you may like a lot</a></div>",
    ],
)
def test_extraction(body):
    assert html_text.main_text(FRAME.format(body.format(ARTICLE))) == WANT


def test_extraction_keeps_all_runs():
    """Without an article element: noise inside, one long paragraph among short lines, a paragraph of links."""
    lines = [f"Line {i} of the article " + "x" * 80 for i in range(10)]
    prose = ["".join(f"<p>{x}</p>" for x in half) for half in (lines[:5], lines[5:])]
    noise = "".join(f"<div class='ad'>Buy this {i}</div>" for i in range(3))
    for frame in ("<div>{}</div>", "{}", "<div><div>{}</div></div><footer>Imprint</footer>"):
        assert html_text.main_text(FRAME.format(frame.format(noise.join(prose)))) == " ".join(lines)
    short = ["a" * 10_000, *(f"{i:03}" + "b" * 197 for i in range(40))]
    for tag in ("<br>", "</div><div>"):
        assert html_text.main_text(FRAME.format(f"<div><div>{tag.join(short)}</div></div>")) == " ".join(short)
    linked = f"<div><p>{lines[0]}</p><p><a href=x>A paragraph that is a link</a></p><p>{lines[1]}</p></div>"
    assert html_text.main_text(FRAME.format(linked)) == f"{lines[0]} A paragraph that is a link {lines[1]}"


def test_extraction_of_odd_pages(spark):
    for page in (None, "", "   ", "<html></html>", "<!-- only -->", "<script>x</script>", "<p", "<<>><", "</p></div>"):
        html_text.main_text(page)
    assert html_text.main_text("just text & more") == "just text & more"
    assert html_text.main_text("<p>One paragraph<p>and another one") == "One paragraph and another one"
    deep = "<div>" * 5000 + "deep text" + "</div>" * 5000
    assert html_text.main_text(deep) == "deep text"
    assert html_text.main_text('<div><p class="a>Odd quotes here</p><p>and "others"</p></div>') == 'Odd quotes here and "others"'
    assert html_text.main_text("<p class='a>An open quote here</p><p>and more of it</p>") == "An open quote here and more of it"
    df = spark.createDataFrame([(1, "u", None, 5), (1, "u", None, 5), (None, None, "<p>A</p>", 5)], "page_id long, url string, html string, n_chars int")
    assert sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in html_text.extract(df).collect()) == [("1", "", 0), ("1", "", 0), ("None", "A", 1)]
    assert html_text.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("broken", ['<p class="a', "<p class='a ", "</ a <b", "<!", "<p>x</b>", '<a "b> ', "<script", "<script></script"])
def test_extraction_is_linear_on_broken_markup(broken):
    """A megabyte of it takes a second or so."""
    page = "<div><p>Some text of an article</p>" + broken * (1_000_001 // len(broken)) + "</div>"
    start = time.perf_counter()
    html_text.main_text(page)
    assert time.perf_counter() - start < 10


def test_extraction_of_pages(spark):
    """The test pages' articles, read by their known frame."""
    import html
    import re

    pages = dict(duckdb.sql(f"select page_id, html from '{SMALL}/pages.parquet'").fetchall())
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_text.query(spark, SMALL).collect()}
    assert set(got) == set(pages)
    for i, page in pages.items():
        article = re.search(r"<article>(.*)</article>", page, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<[^>]+>", " ", article)).split())
        assert got[i] == (want, len(want))


# ---------------------------------------------------------------------- op 6


def check_shards(rows, docs, shards=40):
    n = len(docs)
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    counts = [len(by.get(k, [])) for k in range(shards)]
    assert sum(counts) == n and max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    want = Counter((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in docs)
    assert want == Counter((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows)


def test_sharding(spark):
    rows = sharding.query(spark, SMALL).collect()
    check_shards(rows, documents())
    assert {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}


@pytest.mark.parametrize("ranges", [1, 7, 64])
def test_sharding_keeps_the_mixture(spark, ranges):
    rnd = random.Random(1)
    docs = [(i, "t", rnd.choice("aaaaabbbc")) for i in range(900)]
    rows = sharding.interleave(spark.createDataFrame(docs, "doc_id long, text string, source string"), shards=9, ranges=ranges).collect()
    share = Counter(s for _, _, s in docs)
    for k in range(9):
        own = Counter(r["source"] for r in rows if r["shard"] == k)
        assert all(abs(own[s] - share[s] / 9) <= 2 for s in share)
    assert sorted(r["position"] for r in rows) == list(range(900))
    again = sharding.interleave(spark.createDataFrame(docs[::-1], "doc_id long, text string, source string"), shards=9, ranges=13)
    assert {(r["doc_id"], r["position"]) for r in rows} == {(r["doc_id"], r["position"]) for r in again.collect()}


def test_sharding_of_odd_rows(spark):
    df = odd_rows(spark)
    check_shards(sharding.interleave(df).collect(), [(r["doc_id"], r["text"]) for r in df.collect()])
    assert sharding.interleave(df.limit(0)).count() == 0


def test_native_operators_run_no_python(spark):
    from cinderspark.llm import line_dedup

    for df in (sharding.query(spark, SMALL), line_dedup.query(spark, SMALL)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


# ----------------------------------------------------------------- op 7, op 10


def test_parts_are_safe():
    rnd = random.Random(2)
    alphabet = ["a", "B", "é", " ", "  ", "\n", "\t", "1", "22", "!", "'s", "'", "ö", "　", "\x1c", "\x85", "中", "🙂", " \n "]
    whole = bpe.encoding().encode_ordinary
    for _ in range(150):
        text = "".join(rnd.choice(alphabet) for _ in range(300))
        cut = list(bpe.parts(text, 7))
        assert "".join(cut) == text
        assert sum((whole(p) for p in cut), []) == whole(text)


def test_bpe(spark):
    got = {r["doc_id"]: r for r in bpe.query(spark, SMALL).collect()}
    for i, text in documents():
        ids = bpe.encoding().encode_ordinary(text)
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    odd = bpe.round_trip(odd_rows(spark)).collect()
    assert len(odd) == 8 and sorted(r["n_bytes"] for r in odd)[-1] == 350_000
    assert bpe.round_trip(odd_rows(spark).limit(0)).count() == 0
    assert {r["doc_id"]: len(r["ids"]) for r in bpe.encoded(odd_rows(spark)).collect()}[4] == len(bpe.encode("one"))
    assert "<|endoftext|>" == bpe.decode(bpe.encode("<|endoftext|>")).decode()


@pytest.mark.parametrize("block", [1, 7, 100, 1 << 20])
def test_token_scan(spark, tmp_path, block):
    rnd = np.random.default_rng(4)
    want = set()
    for f in range(3):
        ids = rnd.integers(0, 9, 400 * f).astype("<u2")
        ids[rnd.random(len(ids)) < 0.05] = token_counts.SEPARATOR
        if f == 2:
            ids = np.r_[ids, [token_counts.SEPARATOR] * 3].astype("<u2")
        (tmp_path / f"f{f}.bin").write_bytes(ids.tobytes())
        n, k = 0, 0
        for x in ids:
            if x == token_counts.SEPARATOR:
                want.add((f"f{f}.bin", k, n, True))
                n, k = 0, k + 1
            else:
                n += 1
        if n:
            want.add((f"f{f}.bin", k, n, False))
    got = token_counts.scan(spark, f"file://{tmp_path}", block_ids=block).collect()
    assert len(got) == len(want) and {(r["file"], r["ordinal"], r["n_tokens"], r["ended"]) for r in got} == want


def test_token_counts(spark):
    found = token_counts.count_tokens(shared.read(spark, SMALL, "documents").repartition(3), block_ids=1000).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in found} == {i: len(bpe.encode(t)) for i, t in documents()}
    odd = token_counts.count_tokens(odd_rows(spark)).collect()
    assert len(odd) == 8 and {r["n_tokens"] for r in odd if r["doc_id"] in (1, 2)} == {0}
    assert token_counts.count_tokens(odd_rows(spark).limit(0)).count() == 0


# ---------------------------------------------------------------------- op 8


def test_language_held_out(spark):
    path = "/root/testdata/sf0.01"
    truth = dict(duckdb.sql(f"select doc_id, lang from '{path}/documents.parquet'").fetchall())
    rows = langid.query(spark, path).collect()
    assert {r["doc_id"] for r in rows} == set(truth)
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_rows(spark):
    model = langid.fit(shared.read(spark, SMALL, "documents"), rows=80)
    assert sorted(sum(model.families, [])) == ["de", "en", "es", "fr"] and len(model.families) == 2
    got = langid.predict(odd_rows(spark).withColumn("score", F.lit("x")), model).collect()
    und = [r for r in got if r["lang_pred"] == "und"]
    assert len(got) == 8 and sorted(str(r["doc_id"]) for r in und) == ["1", "2", "3", "6", "None"] and all(r["score"] == 0 for r in und)
    assert langid.predict(odd_rows(spark).limit(0), model).count() == 0
    empty = langid.fit(odd_rows(spark).limit(0))
    assert empty.predict("some words") == ("und", 0.0)
    one = langid.fit(spark.createDataFrame([(1, "some words", "en")], "doc_id long, text string, lang string"))
    assert one.predict("other words") == ("en", 1.0)
    assert langid.fit(odd_rows(spark)).predict("one")[0] in ("en", "de")


def test_sample_is_bounded(spark):
    many = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"), F.when(F.col("id") % 10 == 0, "a").otherwise("b").alias("lang"))
    got = Counter(r["lang"] for r in langid.sample(many, 100))
    assert got == {"a": 50, "b": 50}


# ------------------------------------------------------------------ pipeline


def plain_pipeline(spark, rows, items):
    model = langid.fit(langid.training(spark.createDataFrame(rows, DOCS)))
    kept = [r for r in rows if (p := model.predict(r[1]))[0] != "und" and p[1] >= langid.LEAST_SCORE]
    lines = brute.line_dedup([(r[0], r[1]) for r in kept])
    kept = [(r[0], lines[r[0]][0]) for r in kept]
    kept = [(i, t) for i, t in kept if lines[i][1] + lines[i][2] == 0 or t.replace("\n", "").strip(" ")]
    group = brute.jaccard(kept, 5, 80)
    kept = [(i, t) for i, t in kept if group[i][1] == i]
    leaky = {i for i, *_ in brute.leaks(kept, items)}
    return {i: len(bpe.encode(t)) for i, t in kept if i not in leaky}


def test_pipeline(spark):
    rows = documents("doc_id, text, lang, source, n_chars")
    items = duckdb.sql(f"select item_id, text from '{SMALL}/benchmark.parquet'").fetchall()
    got = {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert got == plain_pipeline(spark, rows, items) and 0 < len(got) < len(rows)


def test_stages_take_anything(spark):
    docs = odd_rows(spark).withColumn("bucket", F.lit(1)).withColumn("shard", F.lit("x"))
    for name, stage in corpus_pipeline.STAGES:
        for table in (docs, docs.limit(0)):
            out = stage(spark, table, SMALL)
            if name != "byte_bpe":
                assert out.columns == docs.columns
            assert out.count() <= 8


def test_stages_keep_columns_whose_names_are_theirs(spark):
    names = ["score", "lang_pred", "_leak", "_t", "_id", "_row", "n_lines", "n_exact", "lid", "keys", "component_id", "doc"]
    docs = shared.read(spark, SMALL, "documents").withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        odd = out.where(" or ".join(f"`{c}` is null or `{c}` <> concat('{c}', doc_id)" for c in names))
        assert out.count() > 0 and odd.count() == 0, name


def test_registered(spark):
    names = queries.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert [k for k, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_duplicates", "decontamination", "byte_bpe"]
    assert set(queries.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, name):
    import os

    con = duckdb.connect()
    for file in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SMALL}/{file}'")
    found = queries.queries()[name](spark, SMALL)
    result = con.execute(queries.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(found.columns)
    want = Counter(tuple(map(str, (row[names.index(c)] for c in sorted(names)))) for row in result.fetchall())
    assert Counter(tuple(str(r[c]) for c in sorted(names)) for r in found.collect()) == want


def test_language_features_are_counted_grams(monkeypatch):
    """Against plain counting, and the same whatever the block."""
    random_ = random.Random(3)
    texts = ["a", "Ab", "abc", "Ärger, 12 straße!", "".join(random_.choice("abcdé .\n") for _ in range(500))]

    def plain(text):
        raw = (" " + "".join(c if c.isalpha() else "\0" for c in text) + " ").lower()
        raw = " ".join(p for p in raw.replace("\0", " ").split(" ") if p)
        raw = f" {raw} " if text[-1:].isalpha() else f" {raw}  "
        if not text[:1].isalpha():
            raw = " " + raw
        raw, counts = raw.encode(), [0] * langid.DIM
        for k in range(len(raw)):
            counts[(raw[k] * 374761393 & 0xFFFFFFFF) >> 20] += 1
            two = lambda at: (raw[at] * 2654435761 + raw[at + 1] * 40503) & 0xFFFFFFFF
            if k + 1 < len(raw):
                counts[two(k) >> 20] += 1
            if k + 2 < len(raw):
                three = (two(k) * 2246822519 + raw[k + 2] * 3266489917) & 0xFFFFFFFF
                counts[((three ^ three >> 13) * 668265263 & 0xFFFFFFFF) >> 20] += 1
        roots = np.sqrt(np.array(counts, float))
        return roots / np.linalg.norm(roots)

    whole = [langid.features(t) for t in texts]
    for text, found in zip(texts, whole, strict=True):
        assert np.allclose(found, plain(text), atol=1e-6)
    for block in (1, 2, 3, 7):
        monkeypatch.setattr(langid, "BLOCK", block)
        assert all(np.array_equal(langid.features(t), w) for t, w in zip(texts, whole, strict=True))


def test_sharding_against_a_plain_order(spark):
    """Ranks, fractions and cuts found by sorting everything in one list."""
    docs = shared.read(spark, SMALL, "documents")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", "source", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("crc"))
    rows = rows.withColumn("stratum", F.concat(F.when(F.col("source").isNull(), "0").otherwise("1"), F.coalesce("source", F.lit(""))))
    seed = F.lit(sharding.SEED)
    rows = rows.select("*", F.shiftrightunsigned(F.xxhash64(seed, "doc_id", "crc", "size"), 1).alias("h"), F.xxhash64(seed, "stratum").alias("tie")).collect()
    placed = []
    for _, group in itertools.groupby(sorted(rows, key=lambda r: (r["stratum"], r["h"], r["doc_id"])), key=lambda r: r["stratum"]):
        group = list(group)
        placed += [((k + 0.5) / len(group), r["tie"], r["stratum"], r["h"], r["doc_id"]) for k, r in enumerate(group)]
    want, slots = {}, Counter()
    for position, (*_, doc) in enumerate(sorted(placed)):
        shard = position * 40 // len(placed)
        want[doc] = (shard, slots[shard])
        slots[shard] += 1
    got = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.query(spark, SMALL).collect()}
    assert len(want) == len(rows) and got == want
