"""Ranked lexical search of a set of items over all documents, by a document FP-tree.

The items' terms are the only ones that count, so every document becomes a short vector of those it holds, with its
length; that table is written once and gives the corpus counts (documents, terms, documents a term) too.  Each task
then searches its own documents and gives the best ``k`` of each item; a window over these leaves the best of all.

* **Tree.**  Terms are numbered by falling document frequency, so that sorted vectors share long heads, as in an FP-tree:
  a node is a run of sorted vectors with a common head, its children are the runs that differ after it.
* **Bounds.**  A score rises with a term's count and falls with a document's ``m``.  The greatest counts of a node's
  documents with their least ``m`` therefore bound every score below it, for all items at once.  Walking depth first, a node
  that can reach no item's ``k``-th score so far is left out with all below it; small runs are scored document by document.
* **Whole and bounded.**  A task holds one tree of at most ``TREE_ENTRIES`` counts (or one document) at a time, and
  the best scores go on from tree to tree.  Items are taken in blocks of about ``BLOCK_TERMS`` terms, each of which
  reads the documents once; only one block's terms are on the driver.

Scores are integers (see :func:`weight` and :func:`gain`), so any order of work gives the same result.

Defined results: terms are the runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z
lower-cased; a NULL or empty text has none, such documents and items do not count.  Rows of one item id are one item
with the terms of all.  Every document row counts for itself, repeated ones too.  Equal scores go by ascending id, a NULL id
last; rows of one id and score stand side by side.  Items without a scoring document have no row; so have empty tables.
"""

from __future__ import annotations

import bisect
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import stored

#: Counts (document and term) in one tree.
TREE_ENTRIES = 500_000
#: A run of at most so many documents is scored as it is.
RUN = 4
#: Distinct (item, term) rows of a block of items, about.
BLOCK_TERMS = 50_000
#: Bytes of a long text that are split at once.
PIECE = 1 << 20
#: Rows whose texts a worker copies at once.
ROWS = 256

# every byte that no term holds becomes a space, A-Z become a-z; bytes of longer characters stay
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, some at a time."""
    text = text.translate(_TABLE)
    start = 0
    while len(text) - start > PIECE:
        cut = text.find(b" ", start + PIECE)
        if cut < 0:
            break
        yield text[start:cut].split()
        start = cut
    yield (text[start:] if start else text).split()


def weight(n_docs: int, n_with: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n_with + 1)))


def length_factor(n: int, n_docs: int, n_terms: int) -> int:
    return 100 - 90 + (90 * n * n_docs) // n_terms


def gain(w: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


# ---- vectors -------------------------------------------------------------------
def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """(ids, texts as bytes) of ``ROWS`` rows at a time; a NULL text reads as empty."""
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            part = whole.slice(at, ROWS)
            texts = part.column(1)
            as_bytes = texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary())
            yield part.column(0), [t or b"" for t in as_bytes.to_pylist()]


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct (item, term) of all items; terms as bytes."""
    id_type = items.schema[id_col].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _texts(batches):
            for i, text in enumerate(texts):
                found = {t for piece in pieces(text) for t in piece}
                if found:
                    own = ids.slice(i, 1).take(pa.array(np.zeros(len(found), np.int64)))
                    yield pa.RecordBatch.from_arrays([own, pa.array(sorted(found), pa.binary())], ["item", "term"])

    rows = items.select(F.col(f"`{id_col}`").alias("item"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(read, f"item {id_type}, term binary").distinct()


def _vector_reader(numbers: dict[bytes, int]):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _texts(batches):
            sizes, terms, counts = [], [], []
            for text in texts:
                n, found = 0, Counter()
                for piece in pieces(text):
                    n += len(piece)
                    found.update(piece)
                known = sorted((numbers[t], c) for t, c in found.items() if t in numbers)
                sizes.append(n)
                terms.append([t for t, _ in known])
                counts.append([c for _, c in known])
            out = pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                 pa.array(counts, pa.list_(pa.int64()))], ["id", "n", "terms", "counts"])
            yield out.filter(pa.array(np.array(sizes) > 0))
    return read


def term_vectors(docs: DataFrame, terms: list[bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, terms, counts) of every document that has a term: its length, and the given terms that it holds."""
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(_vector_reader({t: i for i, t in enumerate(terms)}),
                           f"id {id_type}, n long, terms array<int>, counts array<long>")


# ---- search --------------------------------------------------------------------
@dataclass(frozen=True)
class Asked:
    """A block of items: terms by rank (the most frequent first), their weights, and each item's ranks."""

    rank_of: np.ndarray      # term number -> rank
    weights: np.ndarray      # by rank
    ranks: list[np.ndarray]  # by item
    n_docs: int
    n_terms: int
    k: int


class Best:
    """The ``k`` best documents of every item so far, and the scores to beat."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.rows: list[list[tuple]] = [[] for _ in range(items)]
        self.least = np.ones(items, np.int64)  # a score below is of no use; an equal one may win by its id

    def offer(self, item: int, score: int, doc) -> None:
        rows = self.rows[item]
        bisect.insort(rows, (-score, doc is None, doc if doc is not None else 0))
        if len(rows) > self.k:
            rows.pop()
        if len(rows) == self.k:
            self.least[item] = -rows[-1][0]


class Tree:
    """Sorted vectors of a task's documents; nodes are runs of them, found on the way down."""

    def __init__(self, asked: Asked, ids: list, m: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]]):
        keyed = []
        for terms, counts in vectors:
            ranks = asked.rank_of[terms]
            order = np.argsort(ranks)
            keyed.append((ranks[order], counts[order]))
        heads = [r.astype(">u4").tobytes() for r, _ in keyed]
        order = sorted(range(len(ids)), key=heads.__getitem__)
        self.asked, self.ids, self.m = asked, [ids[i] for i in order], m[order]
        self.start = np.cumsum([0, *[len(keyed[i][0]) for i in order]])
        self.ranks = np.concatenate([keyed[i][0] for i in order])
        self.counts = np.concatenate([keyed[i][1] for i in order])
        self.shared = np.zeros(len(order), np.int64)  # length of the head that a vector shares with the one before
        for at in range(1, len(order)):
            a, b = keyed[order[at - 1]][0], keyed[order[at]][0]
            n = min(len(a), len(b))
            differ = np.flatnonzero(a[:n] != b[:n])
            self.shared[at] = differ[0] if len(differ) else n
        self.flat = np.concatenate(asked.ranks)
        self.item_start = np.cumsum([0, *[len(r) for r in asked.ranks[:-1]]])

    def children(self, lo: int, hi: int) -> list[tuple[int, int]]:
        """The runs that follow the common head of a run; neighbours of together at most ``RUN`` stay together."""
        head = self.shared[lo + 1:hi].min()
        cuts = [lo, *(np.flatnonzero(self.shared[lo + 1:hi] == head) + lo + 1).tolist(), hi]
        out: list[tuple[int, int]] = []
        for a, b in zip(cuts, cuts[1:]):
            if out and b - out[-1][0] <= RUN:
                out[-1] = (out[-1][0], b)
            else:
                out.append((a, b))
        return out

    def bound(self, lo: int, hi: int) -> np.ndarray:
        """For each item, a score that no document of the run exceeds."""
        inside = slice(self.start[lo], self.start[hi])
        most = np.zeros(len(self.asked.weights), np.int64)
        np.maximum.at(most, self.ranks[inside], self.counts[inside])
        return np.add.reduceat(gain(self.asked.weights, most, self.m[lo:hi].min())[self.flat], self.item_start)

    def scores(self, lo: int, hi: int, items: np.ndarray) -> np.ndarray:
        """Documents of the run x ``items``."""
        sizes = np.diff(self.start[lo:hi + 1])
        row = np.repeat(np.arange(hi - lo), sizes)
        inside = slice(self.start[lo], self.start[hi])
        ranks = self.ranks[inside]
        table = np.zeros((hi - lo, len(self.asked.weights)), np.int64)
        table[row, ranks] = gain(self.asked.weights[ranks], self.counts[inside], self.m[lo:hi][row])
        lists = [self.asked.ranks[i] for i in items]
        return np.add.reduceat(table[:, np.concatenate(lists)], np.cumsum([0, *[len(x) for x in lists[:-1]]]), axis=1)

    def search(self, best: Best) -> int:
        """Offer ``best`` every document that may be among them; how many were scored."""
        scored = 0
        todo = [(0, len(self.ids), self.bound(0, len(self.ids)))]
        while todo:
            lo, hi, bound = todo.pop()
            alive = np.flatnonzero(bound >= best.least)
            if not len(alive):
                continue
            if hi - lo > RUN:  # the child with most to win goes first, so that scores to beat rise early
                below = [(a, b, self.bound(a, b)) for a, b in self.children(lo, hi)]
                below.sort(key=lambda node: np.maximum(node[2] - best.least, 0).sum())
                todo += below
                continue
            scored += hi - lo
            found = self.scores(lo, hi, alive)
            for doc, at in zip(*np.nonzero(found >= best.least[alive])):
                score = int(found[doc, at])
                if score >= best.least[alive[at]]:
                    best.offer(int(alive[at]), score, self.ids[lo + doc])
        return scored


def _searcher(asked: Asked, id_type: pa.DataType):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(asked.ranks), asked.k)
        ids, lengths, vectors, held = [], [], [], 0

        def walk() -> None:
            nonlocal ids, lengths, vectors, held
            if ids:
                m = np.array([length_factor(n, asked.n_docs, asked.n_terms) for n in lengths], np.int64)
                Tree(asked, ids, m, vectors).search(best)
            ids, lengths, vectors, held = [], [], [], 0

        for batch in batches:
            terms, counts = batch.column(2), batch.column(3)
            ends = terms.offsets.to_numpy()
            flat_terms, flat_counts = terms.values.to_numpy(), counts.values.to_numpy()
            count_at = counts.offsets.to_numpy()
            for i, (doc, n) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                size = int(ends[i + 1] - ends[i])
                if not size:
                    continue
                if ids and held + size > TREE_ENTRIES:
                    walk()
                ids.append(doc)
                lengths.append(n)
                vectors.append((flat_terms[ends[i]:ends[i + 1]], flat_counts[count_at[i]:count_at[i] + size]))
                held += size
        walk()
        rows = [(item, doc if not null else None, -score) for item, found in enumerate(best.rows)
                for score, null, doc in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], id_type),
             pa.array([r[2] for r in rows], pa.int64())], ["item", "id", "score"])
    return read


def _search_block(docs: DataFrame, block: list, item_type: str, k: int, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    items = sorted({r["item"] for r in block}, key=lambda i: (i is None, i))
    terms = sorted({bytes(r["term"]) for r in block})
    number = {t: i for i, t in enumerate(terms)}
    vectors = stored(term_vectors(docs, terms, id_col, text_col), "lexical-vectors")
    total = vectors.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    held = np.zeros(len(terms), np.int64)
    for r in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        held[r["term"]] = r["count"]  # as many rows as the block has terms
    by_rank = np.argsort(-held, kind="stable")
    rank_of = np.empty(len(terms), np.int64)
    rank_of[by_rank] = np.arange(len(terms))
    of_item: dict = {i: [] for i in items}
    for r in block:
        of_item[r["item"]].append(rank_of[number[bytes(r["term"])]])
    asked = Asked(rank_of, np.array([weight(total["docs"], int(held[t])) for t in by_rank], np.int64),
                  [np.array(sorted(of_item[i]), np.int64) for i in items], total["docs"], total["terms"] or 1, k)
    id_type = vectors.schema["id"].dataType
    found = vectors.select("id", "n", "terms", "counts").mapInArrow(
        _searcher(asked, _arrow_type(id_type)), f"item int, id {id_type.simpleString()}, score long")
    names = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"item int, item_id {item_type}")
    return found.join(F.broadcast(names), "item").select("item_id", F.col("id").alias("doc_id"), "score")


def _arrow_type(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best documents with a score above 0."""
    asked = stored(item_terms(items, item_id, item_text), "lexical-items")
    item_type = items.schema[item_id].dataType.simpleString()
    n = asked.count()
    blocks = max(1, -(-n // BLOCK_TERMS))
    parts = []
    for b in range(blocks if n else 0):
        own = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect()  # one block of the items' terms
        if own:
            parts.append(stored(_search_block(docs, own, item_type, k, id_col, text_col), "lexical-found"))
    if not parts:
        id_type = docs.schema[id_col].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"item_id {item_type}, rank int, doc_id {id_type}, score long")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))
