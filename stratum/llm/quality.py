"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network.

Random indexing gives every word slot a fixed sparse random vector; a word's
vector is the sum of the random vectors of the words around it, over the whole
corpus.  Words share ``SLOTS`` slots by a hash of their spelling, so the table
of vectors has one size for any corpus: tasks add up integer sums for their own
rows, blocks of the table are added up after a shuffle by block, and
the finished table (``SLOTS`` x ``DIM`` floats, 2 MB) goes to every task.  A document is
the mean of its words' vectors, over its whole text, and a few measures of the
text.  A network with one hidden layer is trained in numpy on a bounded sample of
labelled rows, and its logits are divided by a temperature fitted on rows that
the training did not see, so that scores are probabilities.

Defined results: a NULL text counts as empty; an empty text is scored like any
other (all-zero vector); without any labelled row every score is 0.5; repeated
rows give repeated results; only the id and text columns are read; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import mix64, stored, text_slices

SLOTS, DIM, NONZERO, WINDOW = 8192, 64, 2, 2
BLOCK = 64  # slots that travel together
REPEAT = 0  # the slot of a word that equals the one before it
CACHE_ENTRIES = 200_000
MEASURES = 4
_WORDS = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")


def random_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Positions and signs of the non-zero entries of each slot's random vector."""
    h = mix64(np.arange(SLOTS * NONZERO, dtype=np.uint64) + np.uint64(0x5EED))
    place = (h % np.uint64(DIM)).astype(np.int64).reshape(SLOTS, NONZERO)
    sign = np.where(h >> np.uint64(63), 1, -1).astype(np.int64).reshape(SLOTS, NONZERO)
    return place, sign


class _Slots(dict):
    """The slot of each word, by a hash of its spelling; slot 0 is for repeats."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE_ENTRIES:
            self.clear()
        n = self[word] = 1 + zlib.crc32(word.encode()) % (SLOTS - 1)
        return n


def slots_of(text: str, slots: _Slots) -> np.ndarray:
    words = _WORDS.findall(text)
    out = np.fromiter(map(slots.__getitem__, words), np.int64, len(words))
    if len(out) > 1:
        out[1:][out[1:] == out[:-1]] = REPEAT
    return out


def add_contexts(sums: np.ndarray, ids: np.ndarray, breaks: np.ndarray, place: np.ndarray, sign: np.ndarray) -> None:
    """Add to each slot the random vectors of its neighbours; ``breaks`` numbers the document of each word."""
    flat = sums.reshape(-1)
    for gap in range(1, WINDOW + 1):
        same = breaks[gap:] == breaks[:-gap]
        a, b = ids[:-gap][same], ids[gap:][same]
        for to, of in ((a, b), (b, a)):
            for k in range(NONZERO):
                at = to * DIM + place[of, k]
                plus = sign[of, k] > 0
                flat += np.bincount(at[plus], minlength=flat.size) - np.bincount(at[~plus], minlength=flat.size)


def word_vectors(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """The (SLOTS, DIM) table of context vectors over all rows, each of unit length."""

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sign = random_vectors()
        slots, sums = _Slots(), np.zeros((SLOTS, DIM), np.int64)
        for _, texts in text_slices(batches, text_at=0):
            found = [slots_of(t, slots) for t in texts]
            ids = np.concatenate(found)
            add_contexts(sums, ids, np.repeat(np.arange(len(found)), list(map(len, found))), place, sign)
        blocks = np.flatnonzero(sums.reshape(SLOTS // BLOCK, -1).any(1))
        payload = [sums[b * BLOCK:(b + 1) * BLOCK].tobytes() for b in blocks]
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array(payload, pa.binary())],
                                         names=["block", "sums"])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}  # at most SLOTS / BLOCK blocks of one size
        for batch in batches:
            for block, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(payload, np.int64)
                total[block] = total[block] + part if block in total else part
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()),
                                          pa.array([v.tobytes() for v in total.values()], pa.binary())],
                                         names=["block", "sums"])

    schema = "block int, sums binary"
    parts = df.select(text_col).mapInArrow(gather, schema).repartition("block").mapInArrow(add, schema)
    sums = np.zeros((SLOTS, DIM))
    for block, payload in parts.collect():  # SLOTS x DIM numbers, whatever the corpus
        sums[block * BLOCK:(block + 1) * BLOCK] = np.frombuffer(payload, np.int64).reshape(BLOCK, DIM)
    size = np.linalg.norm(sums, axis=1, keepdims=True)
    return (sums / np.maximum(size, 1)).astype(np.float32)


def pooled(texts: list[str], vectors: np.ndarray, slots: _Slots) -> np.ndarray:
    """(documents, DIM + MEASURES): the mean vector, its length, the share of repeats, of capitals, and log words."""
    out = np.zeros((len(texts), DIM + MEASURES), np.float32)
    for i, text in enumerate(texts):
        ids = slots_of(text, slots)
        if len(ids):
            for s in range(0, len(ids), 1 << 16):
                out[i, :DIM] += vectors[ids[s:s + (1 << 16)]].sum(0)
            out[i, :DIM] /= len(ids)
            out[i, DIM] = np.linalg.norm(out[i, :DIM])
            out[i, DIM + 1] = (ids == REPEAT).mean()
            out[i, DIM + 2] = sum(map(str.isupper, text)) / len(text)
            out[i, DIM + 3] = np.log1p(len(ids)) / 10
    return out


@dataclass
class Network:
    """Standardised inputs, one hidden layer, one logit, and its temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x.astype(np.float64)) / self.temperature, -60, 60)))


def log_loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def train(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, rate: float = 0.005, decay: float = 1e-3,
          held: float = 0.2, seed: int = 11) -> Network | None:
    """Fit the network by Adam on most rows, and its temperature on the rest."""
    if not len(y):
        return None
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    cut = int(len(y) * held)
    fresh, fit = order[:cut], order[cut:]
    x, y = x.astype(np.float64), y.astype(np.float64)
    net = Network(x[fit].mean(0), x[fit].std(0) + 1e-3, rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)),
                  np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), 0.0)
    p = {"w1": net.w1, "b1": net.b1, "w2": net.w2, "b2": np.zeros(1)}
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v = {k: np.zeros_like(a) for k, a in p.items()}
    step = 0
    for _ in range(epochs):
        mixed = rng.permutation(fit)
        for s in range(0, len(mixed), 128):
            rows = mixed[s:s + 128]
            z = (x[rows] - net.mean) / net.scale
            h = np.tanh(z @ p["w1"] + p["b1"])
            d = (1 / (1 + np.exp(-(h @ p["w2"] + p["b2"]))) - y[rows]) / len(rows)
            back = np.outer(d, p["w2"]) * (1 - h * h)
            g = {"w1": z.T @ back + decay * p["w1"], "b1": back.sum(0), "w2": h.T @ d + decay * p["w2"],
                 "b2": np.array([d.sum()])}
            step += 1
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
                p[k] -= rate * m[k] / (1 - 0.9 ** step) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)
    net.b2 = float(p["b2"][0])
    if cut:
        logits = net.logits(x[fresh])
        net.temperature = float(min(np.geomspace(0.25, 8, 61), key=lambda t: log_loss(logits / t, y[fresh])))
    return net


@dataclass
class Model:
    vectors: np.ndarray
    network: Network | None


def fit(df: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = 6000, id_col: str = "doc_id",
        text_col: str = "text", **options) -> Model:
    """Word vectors from all rows of ``df``; the network from at most ``sample`` labelled rows, the first in a
    hash order of their ids; an id with several labels has the greatest."""
    vectors = word_vectors(df, text_col)
    some = (labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("y"))
            .orderBy(F.xxhash64("id"), "id").limit(sample))
    # the labelled ids are at most ``sample`` rows, so their join may be broadcast
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(some), "id")
    shape = f"array<float>"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = _Slots()
        for part, texts in text_slices(batches, text_at=2):
            x = pooled(texts, vectors, slots)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(list(x), pa.list_(pa.float32()))],
                                             names=["id", "y", "x"])

    y_type = rows.schema["y"].dataType.simpleString()
    id_type = rows.schema["id"].dataType.simpleString()
    got = rows.select("id", "y", "text").mapInArrow(run, f"id {id_type}, y {y_type}, x {shape}").orderBy("id", "x").collect()
    x = np.array([r.x for r in got], np.float32).reshape(-1, DIM + MEASURES)
    return Model(vectors, train(x, np.array([float(r.y) for r in got]), **options))


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score): the calibrated probability of the label 1, from the whole text."""
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = _Slots()
        for part, texts in text_slices(batches):
            s = model.network.scores(pooled(texts, model.vectors, slots)) if model.network else np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(s, pa.float64())], names=[id_col, "score"])

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, score double")


def keep(df: DataFrame, model: Model, at_least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``df``, with all their columns, whose score is ``at_least`` so much."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = _Slots()
        for part, texts in text_slices(batches, text_at=at):
            if model.network:
                good = model.network.scores(pooled(texts, model.vectors, slots)) >= at_least
                part = part.filter(pa.array(good))
            yield part

    at = df.columns.index(text_col)
    return df.mapInArrow(run, df.schema)
