"""Near-duplicate classes: DartMinHash signatures, banded joins, exact checks, connected components.

A text's elements are its runs of five words, weighted by how often they occur.
1. One pass over the texts gives each document a 128-bit key of its words and the
   keys of its bands (``BANDS`` bands of ``ROWS`` signature coordinates).  Documents with the
   same words are one node from here on: copies are never paired.
2. Nodes that share a band key stand in one bucket.  Each is checked against the
   bucket's least node, by the exact weighted similarity of their shingles: pairs grow with the
   members, not with their square.
3. Links make components.  A bucket whose members are now in one component is done.
   In the others no link may be lost, so their members are compared with each other,
   component against component: a bucket is dealt into blocks of bounded size, and
   each pair of blocks is one group whose similarities come from one matrix product.
   What leaves a group is a forest of links, not all of them.
4. The components of all links are the classes, named by their least id.

Nothing is capped: a bucket of any size is worked off in blocks.  Texts of 0.8 similarity share a band with
probability 1 - (1 - 0.8**4)**20 = 0.99997.

Defined results: texts without any word are in one class only with equal texts; a
text of one to four words has one shingle; rows of one id with the same words are one node, with different words
several, each in its own class; a row
without id is in no class (NULL); an empty table gives an empty result.  Only the id and
text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm import dart_minhash, shingles
from stratum.llm.common import mix64, small_side, stored, text_slices
from stratum.llm.components import components

BANDS, ROWS = 20, 4
SIMILARITY = 0.8
BLOCK_MEMBERS, BLOCK_CELLS = 512, 400_000


def _cells(texts: list[str], known: shingles.WordHashes):
    """(text number, cell) of the unit cells of all texts, and a key of each text's words."""
    words = [shingles.word_hashes(t, known) for t in texts]
    keys = [xxhash.xxh3_128_digest(w.tobytes() if len(w) else t.encode(), 1 if len(w) else 2)
            for w, t in zip(words, texts)]
    hashes = [shingles.shingle_hashes(w) for w in words]
    owner, element, weight = shingles.weighted(np.repeat(np.arange(len(texts)), list(map(len, hashes))),
                                               np.concatenate(hashes))
    return *dart_minhash.unit_cells(owner, element, weight), keys


def band_keys(signature: np.ndarray) -> np.ndarray:
    """(documents, BANDS) keys; the band's number is part of the key."""
    out = np.empty((len(signature), BANDS), np.uint64)
    for b in range(BANDS):
        key = np.full(len(signature), b, np.uint64)
        for r in range(ROWS):
            key = mix64(key * np.uint64(0x100000001B3) + signature[:, b * ROWS + r])
        out[:, b] = key
    return out


def sketches(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, words, bands): the key of a document's words, and its band keys (none without words)."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shingles.WordHashes()
        for part, texts in text_slices(batches, limit=1 << 20):
            owner, cell, filled, keys = _cells(texts, known)
            bands = band_keys(dart_minhash.signatures(owner, cell, filled, len(texts), BANDS * ROWS)).view(np.int64)
            some = np.bincount(owner, minlength=len(texts)) > 0
            ends = np.r_[0, np.cumsum(some * BANDS)].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(bands[some].reshape(-1)))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(keys, pa.binary()), lists],
                                             names=["doc_id", "words", "bands"])

    return rows.mapInArrow(run, f"doc_id {id_type}, words binary, bands array<long>")


def cell_sets(rows: DataFrame) -> DataFrame:
    """(node, cells) of (node, text): the sorted unit cells as bytes."""
    id_type = rows.schema["node"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shingles.WordHashes()
        for part, texts in text_slices(batches, limit=1 << 20):
            owner, cell, _, _ = _cells(texts, known)
            order = np.lexsort((cell, owner))
            ends = np.searchsorted(owner[order], np.arange(len(texts) + 1))
            cell = cell[order]
            payload = [cell[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(payload, pa.binary())], names=["node", "cells"])

    return rows.mapInArrow(run, f"node {id_type}, cells binary")


def similar_pairs(pairs: DataFrame, cells: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose cell sets are similar enough."""
    one, two = (cells.select(F.col("node").alias(x), F.col("cells").alias(f"cells_{x}")) for x in "ab")
    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "cells_a", "cells_b")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            good = []
            for i in range(batch.num_rows):
                a, b = (np.frombuffer(c[i].as_buffer(), np.uint64) for c in (x, y))
                if len(a) > len(b):
                    a, b = b, a
                both = 0
                if len(a) >= threshold * len(b):
                    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                    both = int((b[at] == a).sum())
                good.append(both >= threshold * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return joined.mapInArrow(run, joined.select("a", "b").schema)


def block_links(sets: list[np.ndarray], component: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """A forest of the similar pairs between different components, of members small enough for one matrix."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    owner, cell = np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets)
    _, column, often = np.unique(cell, return_inverse=True, return_counts=True)
    common = often[column] > 1  # cells of one member only are in no intersection
    owner, column = owner[common], column[common]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], np.unique(column[order], return_inverse=True)[1]
    both = np.zeros((len(sets), len(sets)), np.float32)
    width = max(1, (4 << 20) // max(1, len(sets)))  # 16 MB of matrix at a time
    columns = int(column.max(initial=-1)) + 1
    for at in range(0, columns, width):
        a, b = np.searchsorted(column, [at, at + width])
        m = np.zeros((len(sets), min(width, columns - at)), np.float32)  # most groups have few columns
        m[owner[a:b], column[a:b] - at] = 1
        both += m @ m.T
    similar = both >= threshold * (sizes[:, None] + sizes - both)
    similar &= (component[:, None] != component) & (sizes > 0)
    parent = {int(c): int(c) for c in component}

    def find(c: int) -> int:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    out = []
    for i, j in zip(*np.nonzero(np.triu(similar))):
        x, y = find(int(component[i])), find(int(component[j]))
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((int(i), int(j)))
    return out


def links_between(members: DataFrame, cells: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between components inside buckets; ``members``: (bucket, node, component)."""
    sized = members.join(cells.select("node", F.octet_length("cells").alias("size")), "node")
    blocks = stored(sized.groupBy("bucket").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK_MEMBERS), F.ceil(F.sum("size") / (8 * BLOCK_CELLS)), F.lit(1)).alias("blocks")),
        "near-blocks")
    dealt = (members.join(blocks, "bucket").withColumn("own", F.pmod(F.xxhash64("node"), "blocks"))
             .withColumn("other", F.explode(F.expr("sequence(0, int(blocks) - 1)")))
             .select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node",
                     "component"))
    rows = dealt.join(cells, "node").select("bucket", "i", "j", "node", "component", "cells")
    out = rows.select(F.col("node").alias("a"), F.col("node").alias("b"))

    def run(group: pa.Table) -> pa.Table:
        names = group.column("node")
        codes = {c: n for n, c in enumerate(group.column("component").unique().to_pylist())}
        component = np.array([codes[c] for c in group.column("component").to_pylist()])
        sets = [np.frombuffer(c.as_buffer(), np.uint64) for c in group.column("cells")]
        found = block_links(sets, component, threshold)
        return pa.table({"a": names.take(pa.array([i for i, _ in found], pa.int64())),
                         "b": names.take(pa.array([j for _, j in found], pa.int64()))})

    return rows.groupBy("bucket", "i", "j").applyInArrow(run, out.schema)


def text_key(text: Column) -> Column:
    """128 bits of a text, NULL as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def near_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = SIMILARITY) -> DataFrame:
    """One row per input row: (doc_id, class_id, kept); the least id of a class is its name and stays."""
    found = _classes(df, id_col, text_col, threshold)
    return found.select("doc_id", "class_id", "kept")


def _classes(df: DataFrame, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """(doc_id, class_id, kept, text_key): ``text_key`` is that of the row's text where ids repeat with different
    texts, else NULL."""
    ids = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("h"))
    twice = ids.groupBy("id").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a < b")
    if twice.isEmpty():
        return _by_id(df, id_col, text_col, threshold).withColumn("text_key", F.lit(None).cast("binary"))
    # every (id, text) gets a number of its own, in the order of the ids
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), text_key(F.col(text_col)).alias("text_key"))
    order = rows.where("id is not null").select("id", "text_key").distinct().orderBy("id", "text_key")
    numbers = stored(order.withColumn("number", F.monotonically_increasing_id()), "near-numbers")
    numbered = rows.join(numbers, ["id", "text_key"], "left").select("number", "text", "id", "text_key")
    classes = stored(_by_id(numbered, "number", "text", threshold).distinct(), "near-by-number")
    name = numbers.select(F.col("number").alias("class_id"), F.col("id").alias("class_name"))
    told = numbers.join(classes.withColumnRenamed("doc_id", "number"), "number").join(name, "class_id")
    found = stored(told.select("id", "text_key", F.col("class_name").alias("class_id"), "kept"), "near-named")
    out = rows.drop("text").join(found, ["id", "text_key"], "left")
    return out.select(F.col("id").alias("doc_id"), "class_id", F.coalesce("kept", F.lit(True)).alias("kept"), "text_key")


def _by_id(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = SIMILARITY) -> DataFrame:
    """:func:`near_classes` of a table whose ids have one text each."""
    sketch = stored(sketches(df, id_col, text_col), "near-sketches")
    # (node, bands) of each distinct word sequence: copies collapse in the map tasks
    nodes = sketch.groupBy("words").agg(F.min("doc_id").alias("node"), F.count("*").alias("n"),
                                        F.first("bands").alias("bands"))
    same = stored(nodes.where("n > 1").select("words", "node"), "near-same")
    placed = nodes.select("node", F.explode("bands").alias("bucket"))
    buckets = stored(placed.groupBy("bucket").agg(F.min("node").alias("least"), F.max("node").alias("most"))
                     .where("least < most").select("bucket", "least"), "near-buckets")
    members = stored(placed.join(buckets, "bucket"), "near-members")
    involved = stored(members.select("node").distinct(), "near-involved")
    texts = df.select(F.col(id_col).alias("node"), F.col(text_col).alias("text")).join(small_side(involved), "node")
    # rows with one id are one node: several texts of an id give several rows, any of which may link it
    cells = stored(cell_sets(texts.select("node", "text")).distinct(), "near-cells")
    pairs = members.where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
    first = stored(similar_pairs(pairs, cells, threshold), "near-first")
    labels = components(first)
    told = stored(members.select("bucket", "node").join(labels, "node", "left").select(
        "bucket", "node", F.coalesce("component", "node").alias("component")), "near-told")
    mixed = stored(told.groupBy("bucket").agg(F.min("component").alias("c"), F.max("component").alias("d"))
                   .where("c < d").select("bucket"), "near-mixed")
    second = links_between(told.join(mixed, "bucket"), cells, threshold)
    links = stored(first.unionByName(second), "near-links")
    classes = components(links)
    rows = df.select(F.col(id_col).alias("doc_id"))
    named = sketch.select("doc_id", "words").join(same, "words", "left").select(
        "doc_id", F.coalesce("node", "doc_id").alias("node"))
    out = named.join(classes, "node", "left").select("doc_id", F.coalesce("component", "node").alias("class_id"))
    return (out.unionByName(rows.where("doc_id is null").select("doc_id", F.col("doc_id").alias("class_id")))
            .select("doc_id", "class_id", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept")))


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                threshold: float = SIMILARITY) -> DataFrame:
    """The rows of ``df``, with all their columns, that stay."""
    gone = stored(_classes(df, id_col, text_col, threshold).where("not kept").select(
        F.col("doc_id").alias("__gone"), F.col("text_key").alias("__text")).distinct(), "near-gone")
    same = df[id_col] == gone["__gone"]
    if not gone.where("__text is not null").isEmpty():
        same = same & (text_key(df[text_col]) == gone["__text"])
    return df.join(small_side(gone), same, "left_anti")
