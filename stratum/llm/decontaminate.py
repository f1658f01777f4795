"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact verification.

All in DataFrame operations.  Texts become hashes of their runs of five words
(shingles).  For a benchmark item of n words, a document's windows of n words that
begin with one of the item's shingles get a 64-bit SimHash of their shingles, each
weighted by how often it occurs: the n-th occurrence of a shingle counts as a vector of its own
(:func:`unit_cells`), so that a run of one word cannot outvote the rest.  (Other windows are not needed: moved right to its
first shingle of the item, a window keeps all it shares with the item, so its similarity does not
fall.)  The 64 bits are cut into RADIUS + 1 blocks; two fingerprints that differ in at most RADIUS
bits agree in one block at least, so an equi-join on (item, window size, block number,
block) finds every item within the radius; a window is compared with the items whose shingle it
begins with, no others.  What is within the radius is verified by the
exact weighted Jaccard similarity of the shingles.

An item of one to four words is one shingle of its own length: a run of words in a document either is
that shingle, or shares nothing with it.  Such items are found by an equi-join on their words.

At the similarity asked for, 0.8, a bit differs with probability 0.15, so fingerprints are about
10 bits apart, and within 19 with probability 0.9997.

Work is per distinct text (a 128-bit key), so copies cost nothing but their
row in the result.  Positions of all texts meet the items' shingles by a hash join with the small
side broadcast after its rows are counted (:func:`small_side`), and by a shuffle join beyond.

Defined results: a NULL or empty text matches nothing, as does an item without a word; an item of fewer than five
words matches where its words stand in a row (similarity 1); repeated rows give repeated results;
items that share an id count as one; empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import small_side, stored

SHINGLE, SIMILARITY = 5, 0.8
BITS, RADIUS = 64, 19
WORDS = r"regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+', 0)"


def text_key(text: str | Column) -> Column:
    """128 bits of a text, NULL as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def with_shingles(rows: DataFrame) -> DataFrame:
    """``rows`` with ``n_words`` and ``hashes``, the text's shingles in order (NULL: too short for one).

    No filter follows here: Spark would push it below, and work the words out again for each run.
    """
    worded = rows.withColumn("words", F.expr(WORDS))
    run = ", ".join(f"words[i + {d}]" for d in range(SHINGLE))
    return worded.select(*[c for c in rows.columns if c != "text"], F.size("words").alias("n_words"), F.expr(
        f"if(size(words) >= {SHINGLE}, transform(sequence(0, size(words) - {SHINGLE}), i -> xxhash64({run})), null)"
    ).alias("hashes"))


def simhash(hashes: str) -> Column:
    """64 bits: each one the majority of that bit over the shingles, repeats counted."""
    return F.expr(f"""
        aggregate(sequence(0, {BITS - 1}), 0L, (bits, b) -> bits | shiftleft(
            if(2 * size(filter({hashes}, h -> shiftright(h, b) & 1 = 1)) > size({hashes}), 1L, 0L), b))""")


def unit_cells(hashes: str) -> Column:
    """The shingles with their repeats told apart: the first occurrence as it is, a later one hashed with its number.
    Two arrays share as many cells as their weighted intersection counts."""
    return F.expr(f"""
        if(size(array_distinct({hashes})) = size({hashes}), {hashes}, transform({hashes}, (h, i) ->
            if(array_position({hashes}, h) = i + 1, h, xxhash64(h, size(filter(slice({hashes}, 1, i), x -> x = h))))))""")


def blocks(fingerprint: str) -> Column:
    """The fingerprint cut into RADIUS + 1 blocks, each with its number."""
    n = RADIUS + 1
    cuts = [BITS * i // n for i in range(n + 1)]
    return F.array(*[F.struct(F.lit(i).alias("block"), F.expr(
        f"shiftrightunsigned({fingerprint}, {a}) & {(1 << (b - a)) - 1}L").alias("bits"))
        for i, (a, b) in enumerate(zip(cuts, cuts[1:]))])


def weighted_similarity(a: str, b: str) -> Column:
    """Weighted Jaccard similarity of two arrays of shingles."""
    both = f"""aggregate(array_intersect({a}, {b}), 0, (n, x) -> n + least(
        size(filter({a}, y -> y = x)), size(filter({b}, y -> y = x))))"""
    return F.expr(f"{both} / (size({a}) + size({b}) - {both})")


def candidates(windows: DataFrame, bench: DataFrame) -> DataFrame:
    """Windows and items that agree in a block, item by item: a row for each such block."""
    index = (bench.select("item_id", "n_words", F.col("hashes").alias("item"), unit_cells("hashes").alias("cells"))
             .select("item_id", "n_words", "item", simhash("cells").alias("item_print")))
    asked = windows.select("key", "start", "n_words", "print", F.explode("items").alias("of"), blocks("print").alias("bs")).select(
        "key", "start", "n_words", "print", "of.item_id", F.explode("bs").alias("b"))
    given = index.select("item_id", "item", "n_words", "item_print", F.explode(blocks("item_print")).alias("b"))
    # an item id may be NULL, as any other value: one item
    on = asked["item_id"].eqNullSafe(given["item_id"]) & (asked["n_words"] == given["n_words"]) & (asked["b"] == given["b"])
    return asked.join(given, on).select("key", "start", asked["n_words"], asked["item_id"], "print", "item", "item_print")


def short_matches(texts: DataFrame, named: DataFrame) -> DataFrame:
    """(key, item_id, similarity, start, n_words): the first place of every item of one to four words in each text."""
    worded = named.select("item_id", F.expr(WORDS).alias("item")).withColumn("n_words", F.size("item"))
    short = stored(worded.where(f"n_words between 1 and {SHINGLE - 1}").distinct(), "bench-short")
    out = "key binary, item_id {}, similarity double, start int, n_words int".format(named.schema["item_id"].dataType.simpleString())
    parts = [texts.sparkSession.createDataFrame([], out)]
    for n in sorted(r["n_words"] for r in short.select("n_words").distinct().collect()):  # four sizes at most
        # words hold no space, so runs are equal where their words joined by spaces are
        run = ", ".join(f"words[i + {d}]" for d in range(n))
        runs = texts.select("key", F.expr(WORDS).alias("words")).select("key", F.expr(
            f"if(size(words) >= {n}, transform(sequence(0, size(words) - {n}), i -> concat_ws(' ', {run})), null)").alias("runs"))
        asked = stored(short.where(f"n_words = {n}").select("item_id", F.array_join("item", " ").alias("run")), "bench-short-asked")
        hit = runs.select("key", F.posexplode_outer("runs").alias("start", "run")).join(small_side(asked), "run")
        parts.append(hit.groupBy("key", "item_id").agg(F.min("start").alias("start")).select(
            "key", "item_id", F.lit(1.0).alias("similarity"), "start", F.lit(n).alias("n_words")))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    return found


def matches(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
            item_text: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """(key, item_id, similarity, start_word, n_words): per distinct text and item the most similar window,
    the first of equals; ``key`` is the text's :func:`text_key`."""
    named = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    bench = stored(with_shingles(named).distinct(), "bench-items").where("hashes is not null")
    seeds = stored(bench.select(F.explode("hashes").alias("hash"), "n_words", "item_id").distinct(), "bench-seeds")
    texts = docs.select(text_key(docs[text_col]).alias("key"), docs[text_col].alias("text"))
    places = with_shingles(texts).select("key", F.posexplode_outer("hashes").alias("start", "hash"))
    begun = places.join(small_side(seeds), "hash").groupBy("key", "start", "n_words").agg(F.collect_set(F.struct("item_id")).alias("items"))
    hits = stored(begun.groupBy("key").agg(F.collect_list(F.struct("start", "n_words", "items")).alias("at")), "bench-hits")
    # the texts with a hit are read again, and only they are shuffled, while their keys can be broadcast
    hit = small_side(stored(hits.select("key"), "bench-hit-keys"))
    found = texts.join(hit, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    windows = (with_shingles(found).drop("n_words").join(hits, "key")
               .select("key", "hashes", F.explode("at").alias("w"))
               .select("key", F.col("w.start").alias("start"), F.col("w.n_words").alias("n_words"), F.col("w.items").alias("items"),
                       F.expr(f"slice(hashes, w.start + 1, w.n_words - {SHINGLE - 1})").alias("window")))
    windows = stored(windows.withColumn("cells", unit_cells("window")).withColumn("print", simhash("cells")).drop("cells"),
                     "bench-windows")
    near = candidates(windows, bench).where(F.bit_count(F.expr("print ^ item_print")) <= RADIUS).select(
        "key", "start", "n_words", "item_id", "item").distinct()
    checked = (near.join(windows.select("key", "start", "n_words", "window"), ["key", "start", "n_words"])
               .withColumn("similarity", weighted_similarity("window", "item")).where(F.col("similarity") >= threshold))
    best = checked.select("key", "item_id", "similarity", "start", "n_words").unionByName(short_matches(texts, named)).groupBy(
        "key", "item_id").agg(F.max(F.struct("similarity", -F.col("start"), -F.col("n_words"))).alias("b"))
    return best.select("key", "item_id", F.col("b.similarity").alias("similarity"),
                       (-F.col("b.col2")).alias("start_word"), (-F.col("b.col3")).alias("n_words"))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, similarity, start_word, n_words."""
    found = stored(matches(docs, items, text_col, **options), "bench-matches")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(docs[text_col]).alias("key"))
    return rows.join(small_side(found), "key").drop("key")


def without_benchmark(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, in whose text no benchmark item is found."""
    found = stored(matches(docs, items, text_col, **options).select(F.col("key").alias("__key")).distinct(), "bench-keys")
    return docs.join(small_side(found), text_key(docs[text_col]) == found["__key"], "left_anti")
