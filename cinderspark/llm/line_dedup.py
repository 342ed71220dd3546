"""Near-duplicate lines by a deletion-neighbourhood join; DataFrame functions only.

A line is one ``\\n``-separated part of a text, its words are what white space of any length separates,
and an edit inserts, deletes or replaces one word. A line goes if an earlier line (in
``(doc_id, line number)`` order) equals it or, both having ``MIN_WORDS`` words or more, is at most one
edit apart: one edit then always leaves a similarity of 0.8 or more. Lines that differ in white space
alone are no edit apart. Shorter lines go as equal ones only. Lines of nothing but white space stay.

1. Equal lines meet by hash; only the first place of each distinct line goes on.
2. A line one edit away shares the first or the last half of its words with it. Lines
   that share no half with another distinct line need no variants.
3. The rest emit every variant with one word deleted, and themselves split at every place,
   as keys ``(words left, place, hash of both sides)``. Sides are running sums of hashes of
   (word, place from the near end), so a line of n words costs n keys, not n squared.
   All lines of one key are within one edit of each other: each is tied to the key's
   earliest line alone, never to all others, and the tie is verified on the words.
4. Lines with an earlier near copy, and later copies of equal lines, leave the texts.

Defined cases: null and empty texts stay as they are; a null ``doc_id`` sorts first; rows with
equal ``doc_id`` are judged one after the other, those with different texts in order of the texts' hashes;
of equal rows, which are told apart by place, all but one lose all their lines; an empty table
gives no rows; other columns are carried along untouched, but ``n_lines``, ``n_exact`` and ``n_near``
are replaced.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinderspark.llm import shared

MIN_WORDS = 5
#: Hashes are cut to 42 bits so that the sums of a million of them stay within a long.
MASK = (1 << 42) - 1
WHITE = " \t\x0b\x0c\r"


def _blank(line) -> F.Column:
    return F.btrim(line, F.lit(WHITE)) == ""


def _plain(line) -> F.Column:
    """The words with one space between; lines that are so already are only searched for other white space."""
    rare = functools.reduce(operator.or_, (F.contains(line, F.lit(c)) for c in WHITE[1:]))
    spaced = F.when(rare, F.translate(line, WHITE[1:], " " * len(WHITE[1:]))).otherwise(line)
    spaced = F.btrim(spaced)
    return F.when(F.contains(spaced, F.lit("  ")), F.regexp_replace(spaced, " +", " ")).otherwise(spaced)


def _lines(documents: DataFrame) -> DataFrame:
    """doc, line_no, line, plain (its words), n (words) of all lines that are not blank; doc tells rows of equal ids and different texts apart."""
    split = documents.select(
        F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("t")).alias("doc"),
        F.posexplode(F.split("text", "\n")).alias("line_no", "line"),
    )
    plain = split.where(~_blank(F.col("line"))).withColumn("plain", _plain(F.col("line")))
    return plain.withColumn("n", F.length("plain") - F.length(F.replace(F.col("plain"), F.lit(" "), F.lit(""))) + 1)


def _halves(first: DataFrame) -> DataFrame:
    """Keys of the line's outer halves for its own length and the next shorter one; none of a line too short for near copies."""
    keys = []
    for less in (1, 2):
        k = ((F.col("n") - less) / 2).cast("int")
        keys.append(F.xxhash64(F.lit("p"), k, F.call_function("substring_index", F.col("plain"), F.lit(" "), k)))
        keys.append(F.xxhash64(F.lit("s"), k, F.call_function("substring_index", F.col("plain"), F.lit(" "), -k)))
    return F.when(F.col("n") >= MIN_WORDS, F.array_distinct(F.array(*keys))).otherwise(F.array().cast("array<bigint>"))


def _word_gap(a, b) -> F.Column:
    """True if the word lists are at most one edit apart."""
    def gap(short: str, long: str) -> str:
        place = f"array_position(zip_with({short}, {long}, (x, y) -> x <=> y), false)"
        # Past the first difference, the rest must agree once the differing word is left out.
        return (
            f"({place} = 0 or slice({short}, int({place}) + int(size({short}) = size({long})), size({long}))"
            f" = slice({long}, int({place}) + 1, size({long})))"
        )

    return F.expr(
        f"case when abs(size({a}) - size({b})) > 1 then false"
        f" when size({a}) <= size({b}) then {gap(a, b)} else {gap(b, a)} end"
    )


def near_copies(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(places, ties): every compared line's place with its hash, and line -> earlier near copy."""
    lines = _lines(documents)
    places = shared.stored(
        lines.select(F.xxhash64("line").alias("lid"), "doc", "line_no", _halves(lines).alias("halves")), "line-places"
    )
    # Least and greatest line of each half: copies of a line are summed up before the shuffle.
    halves = places.select("lid", F.explode("halves").alias("half"))
    shared_halves = shared.stored(_shared_keys(halves, "half"), "line-halves")
    kin = halves.join(shared.checked_broadcast(shared_halves, shared_halves.count()), "half", "left_semi").select("lid").distinct()
    kin = shared.stored(kin, "line-kin")
    small = shared.checked_broadcast(kin, kin.count())
    first = shared.stored(
        places.join(small, "lid", "left_semi").groupBy("lid").agg(F.min(F.struct("doc", "line_no")).alias("at")), "line-first"
    )
    text = lines.select(F.xxhash64("line").alias("lid"), F.col("plain").alias("line")).join(small, "lid", "left_semi")
    text = shared.stored(text.groupBy("lid").agg(F.min("line").alias("line")), "line-text")

    keys = shared.stored(_variants(text), "line-keys")
    meeting = shared.stored(_shared_keys(keys, "key"), "line-meeting")
    close = keys.join(shared.checked_broadcast(meeting, meeting.count()), "key", "left_semi")
    close = shared.stored(close.join(first, "lid"), "line-close")
    heads = close.groupBy("key").agg(F.min(F.struct("at", "lid")).alias("head")).select("key", F.col("head.lid").alias("earlier"))
    ties = close.select("key", "lid").join(heads, "key").where("lid <> earlier").select("lid", "earlier").distinct()
    mine = text.select("lid", F.split("line", " ").alias("own_words"))
    theirs = text.select(F.col("lid").alias("earlier"), F.split("line", " ").alias("their_words"))
    ties = ties.join(mine, "lid").join(theirs, "earlier").where(_word_gap("own_words", "their_words"))
    ties = shared.stored(ties.select("lid", "earlier"), "line-ties")
    shared.discard(shared_halves, kin, first, text, keys, meeting, close)
    return places, ties


def _shared_keys(keyed: DataFrame, key: str) -> DataFrame:
    """The keys that more than one distinct line has."""
    return keyed.groupBy(key).agg(F.min("lid").alias("lo"), F.max("lid").alias("hi")).where("lo <> hi").select(key)


def _variants(text: DataFrame) -> DataFrame:
    """lid, key of every line less one word, and of the line itself split at every place."""
    # The lines are dealt out before they become words; no window shuffles again.
    words = text.repartition("lid").select("lid", F.posexplode(F.split("line", " ")).alias("i", "w"))
    line = Window.partitionBy("lid")
    forward = line.orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    words = words.withColumn("n", F.count(F.lit(1)).over(line))
    ahead = F.xxhash64("w", "i").bitwiseAND(F.lit(MASK))
    back = F.xxhash64("w", F.col("i") - F.col("n")).bitwiseAND(F.lit(MASK))
    words = words.select("lid", "i", "n", ahead.alias("f"), back.alias("g"))
    words = words.withColumn("all_g", F.sum("g").over(line))
    words = words.withColumn("left_to", F.sum("f").over(forward)).withColumn("right_of", F.col("all_g") - F.sum("g").over(forward))
    before = F.col("left_to") - F.col("f")
    without = F.xxhash64(F.col("n") - 1, "i", before, "right_of")
    split_before = F.xxhash64("n", "i", before, F.col("right_of") + F.col("g"))
    split_after = F.xxhash64("n", F.col("i") + 1, "left_to", F.lit(0).cast("long"))
    last = F.col("i") == F.col("n") - 1
    return words.select("lid", F.explode(F.when(last, F.array(without, split_before, split_after)).otherwise(F.array(without, split_before))).alias("key"))


def dropped_lines(documents: DataFrame) -> DataFrame:
    """doc (id, text hash), line_no of each line that goes, and whether an equal one stays."""
    all_places, ties = near_copies(documents)
    near = ties.select("lid").distinct().withColumn("near", F.lit(True))
    head = all_places.groupBy("lid").agg(F.min(F.struct("doc", "line_no")).alias("head"), F.count(F.lit(1)).alias("copies"))
    judged = shared.stored(head.join(near, "lid", "left").where("near or copies > 1"), "line-judged")
    # Lines with more than an eighth of a partition's share of copies: at most 8 a partition exist, whatever
    # the input, so these few are broadcast and their copies stay where they are.
    parts = shared.parallelism(documents.sparkSession)
    hot = judged.where(F.col("copies") > max(1, all_places.count() // (8 * parts)))
    places = all_places.select("lid", "doc", "line_no")
    usual = places.join(F.broadcast(hot.select("lid")), "lid", "left_anti").join(judged.join(F.broadcast(hot.select("lid")), "lid", "left_anti"), "lid")
    found = usual.unionByName(places.join(F.broadcast(hot), "lid"))
    found = found.where("near or doc <> head.doc or line_no <> head.line_no")
    found = shared.stored(found.select("doc", "line_no", F.coalesce("near", F.lit(False)).alias("near")), "line-found")
    shared.discard(all_places, ties, judged)
    return found


def _told_apart(rows: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """``rows`` (_id, _t, text, ...) with ``_later``: true for all but one of equal rows; and tables to discard.

    Only rows that are there more than once are written and numbered, if there are any.
    """
    equal = rows.where("text is not null").groupBy("_t", "_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_t", "_id")
    equal = shared.stored(equal, "line-equal-rows")
    if not (n := equal.count()):
        shared.discard(equal)
        return rows.withColumn("_later", F.lit(False)), []
    some = shared.checked_broadcast(equal, n).toDF("_ft", "_fid")
    of = (F.col("_t") == F.col("_ft")) & F.col("_id").eqNullSafe(F.col("_fid")) & F.col("text").isNotNull()
    placed = shared.stored(rows.join(some, of, "left_semi").withColumn("_place", F.monotonically_increasing_id()), "line-placed-rows")
    first = placed.groupBy("_t", "_id").agg(F.min("_place").alias("_first")).toDF("_ft", "_fid", "_first")
    placed_ = placed.join(shared.checked_broadcast(first, n), of).withColumn("_later", F.col("_place") != F.col("_first"))
    return rows.join(some, of, "left_anti").withColumn("_later", F.lit(False)).unionByName(placed_.drop("_place", "_first", "_ft", "_fid")), [equal, placed]


def dedup_lines(documents: DataFrame) -> DataFrame:
    """All columns of ``documents`` with ``text`` less its repeated lines, and n_lines, n_exact, n_near.

    ``n_lines`` counts the lines before, ``n_exact`` and ``n_near`` those that went.
    """
    found = dropped_lines(documents)
    gone = found.groupBy("doc").agg(
        F.collect_set(F.when(~F.col("near"), F.col("line_no"))).alias("_exact"),
        F.collect_set(F.when(F.col("near"), F.col("line_no"))).alias("_near"),
    )
    gone = shared.stored(gone.select(F.col("doc.t").alias("_gt"), F.col("doc.id").alias("_gid"), "_exact", "_near"), "line-gone")
    shared.discard(found)
    rows = shared.packed(documents.withColumn("text", F.col("text").cast("string")), "doc_id", "text")
    rows, _ = _told_apart(rows.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_t"), "text", "_row"))
    joined = rows.join(gone, (F.col("_t") == F.col("_gt")) & F.col("_id").eqNullSafe(F.col("_gid")), "left")
    lines, later = F.split("text", "\n"), F.col("_later")
    exact, near = (F.coalesce(F.col(c), F.array().cast("array<int>")) for c in ("_exact", "_near"))
    kept = F.filter(lines, lambda line, i: ~F.array_contains(exact, i) & ~F.array_contains(near, i))
    text = F.when(later, F.array_join(F.filter(lines, _blank), "\n")).when(F.size(exact) + F.size(near) == 0, F.col("text")).otherwise(F.array_join(kept, "\n"))
    n_exact = F.when(later, F.size(F.filter(lines, lambda line: ~_blank(line))) - F.size(near)).otherwise(F.size(exact))
    return joined.select(
        *[text.alias("text") if c == "text" else F.col(f"_row.`{c}`") for c in documents.columns if c not in ("n_lines", "n_exact", "n_near")],
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        n_exact.cast("long").alias("n_exact"),
        F.size(near).cast("long").alias("n_near"),
    )


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: texts without repeated lines; a text of which no line is left goes."""
    clean = dedup_lines(shared.packed(docs, "doc_id", "text"))
    kept = clean.where((F.col("n_exact") + F.col("n_near") == 0) | (F.trim(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) != ""))
    return kept.select(F.col("_row").withField("text", F.col("text")).alias("_row")).select("_row.*")


def query(spark, sf_dir: str) -> DataFrame:
    docs = shared.read(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs)
