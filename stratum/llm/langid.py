"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a word's bytes from both ends (two GRUs), gives every byte
position a distribution over the learned languages, and a document's
probabilities are the mean over its letter positions.  It is trained here, in
numpy, by backpropagation through time.  The recurrence starts anew at white
space and, in words of over ``SPAN`` bytes, between characters, so equal words have equal labels wherever they
stand: each worker runs the network once per distinct word and pools a document's
positions from those results, over its whole text.

Training takes a bounded sample: per language, the ``per_language`` labelled documents of
at most ``max_bytes`` bytes that come first in a hash order of their ids.

Defined results: a text that is NULL or has no letter is ``und`` with score 0, as
is every text when nothing could be learned; repeated rows give repeated
results; only the id and text columns are read for a prediction; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import text_slices

SPAN = 32
CACHE_ENTRIES = 300_000
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class BiGru:
    """Parameters: one GRU per direction (input rows per byte, recurrent weights), and the output layer."""

    langs: list[str]
    hidden: int
    params: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, langs: list[str], hidden: int, rng: np.random.Generator) -> "BiGru":
        h, k = hidden, len(langs)
        p = {}
        for d in "fb":
            p[f"x{d}"] = rng.normal(0, 0.3, (256, 3 * h)).astype(np.float32)
            p[f"h{d}"] = rng.normal(0, 1 / np.sqrt(h), (h, 3 * h)).astype(np.float32)
        p["o"] = rng.normal(0, 1 / np.sqrt(2 * h), (2 * h, k)).astype(np.float32)
        p["c"] = np.zeros(k, np.float32)
        return cls(langs, h, p)

    def run(self, data: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """Hidden states (steps, words, hidden) of one direction over (words, steps) bytes."""
        x, w, h = self.params[f"x{d}"], self.params[f"h{d}"], self.hidden
        state = np.zeros((len(data), h), np.float32)
        out = np.empty((data.shape[1], len(data), h), np.float32)
        for t in range(data.shape[1]):
            a, b = x[data[:, t]], state @ w
            gates = _sigmoid(a[:, :2 * h] + b[:, :2 * h])
            z, r = gates[:, :h], gates[:, h:]
            n = np.tanh(a[:, 2 * h:] + r * b[:, 2 * h:])
            if keep is not None:
                keep.append((state, z, r, n, b[:, 2 * h:]))
            state = n + z * (state - n)
            out[t] = state
        return out

    def logits(self, data: np.ndarray, sizes: np.ndarray, keep: tuple | None = None):
        """Scores (words, steps, languages) of left-aligned, zero-filled words; positions past a word's end mean nothing."""
        steps = data.shape[1]
        back = np.clip(sizes[:, None] - 1 - np.arange(steps), 0, None)
        rows = np.arange(len(data))[:, None]
        f = self.run(data, "f", keep[0] if keep else None).transpose(1, 0, 2)
        b = self.run(data[rows, back], "b", keep[1] if keep else None).transpose(1, 0, 2)[rows, back]
        both = np.concatenate([f, b], axis=2)
        return both @ self.params["o"] + self.params["c"], both, back

    def gradients(self, data: np.ndarray, sizes: np.ndarray, label: np.ndarray, mask: np.ndarray):
        """Mean cross entropy over the marked positions, and its gradient by backpropagation through time."""
        keep = ([], [])
        logits, both, back = self.logits(data, sizes, keep)
        e = np.exp(logits - logits.max(2, keepdims=True))
        p = e / e.sum(2, keepdims=True)
        rows, h, steps = np.arange(len(data)), self.hidden, data.shape[1]
        total = max(mask.sum(), 1.0)
        loss = -(np.log(p[rows, :, label] + 1e-9) * mask).sum() / total
        p[rows, :, label] -= 1
        p *= (mask / total)[:, :, None]
        g = {"o": both.reshape(-1, 2 * h).T @ p.reshape(-1, p.shape[2]), "c": p.sum((0, 1))}
        d_both = p @ self.params["o"].T
        d_back = np.zeros((len(data), steps, h), np.float32)
        inside = np.arange(steps) < sizes[:, None]
        i, t = np.nonzero(inside)
        d_back[i, back[i, t]] = d_both[i, t, h:]
        for d, d_out, seen, bytes_ in (("f", d_both[:, :, :h], keep[0], data),
                                       ("b", d_back, keep[1], data[rows[:, None], back])):
            w = self.params[f"h{d}"]
            gx, gw, carry = np.zeros_like(self.params[f"x{d}"]), np.zeros_like(w), np.zeros((len(data), h), np.float32)
            for t in reversed(range(steps)):
                state, z, r, n, b = seen[t]
                ds = d_out[:, t] + carry
                dn = ds * (1 - z) * (1 - n * n)
                dz = ds * (state - n) * z * (1 - z)
                dr = dn * b * r * (1 - r)
                into_x = np.concatenate([dz, dr, dn], axis=1)
                into_h = np.concatenate([dz, dr, dn * r], axis=1)
                np.add.at(gx, bytes_[:, t], into_x)
                gw += state.T @ into_h
                carry = ds * z + into_h @ w.T
            g[f"x{d}"], g[f"h{d}"] = gx, gw
        return loss, g

    def positions(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(indices, bytes, sizes, probabilities) of blocks of words of like length, none longer than SPAN."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        for at in range(0, len(words), 4096):
            block = order[at:at + 4096]
            size = sizes[block]
            data = packed([words[i] for i in block], int(size.max()))
            logits = self.logits(data, size)[0]
            e = np.exp(logits - logits.max(2, keepdims=True))
            yield block, data, size, e / e.sum(2, keepdims=True)


def packed(words: list[bytes], steps: int) -> np.ndarray:
    """Words as rows of bytes, left-aligned, zero-filled."""
    return np.frombuffer(b"".join(w.ljust(steps, b"\0") for w in words), np.uint8).reshape(len(words), steps)


def pieces(word: bytes) -> list[bytes]:
    """A word's bytes in runs of at most ``SPAN``, cut between characters; nothing is left out."""
    out, start = [], 0
    while len(word) - start > SPAN:
        end = start + SPAN
        while word[end] & 0xC0 == 0x80:  # inside a character
            end -= 1
        out.append(word[start:end])
        start = end
    return [*out, word[start:]]


def letter_mask(data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which bytes of packed words belong to a letter: ASCII letters, and all bytes of other characters that are letters."""
    mask = (np.arange(data.shape[1]) < sizes[:, None]) & ((data | 32) - np.uint8(97) < 26)
    for row in np.flatnonzero((data >= 128).any(1)):
        word = data[row, :sizes[row]].tobytes().decode()
        mask[row, :sizes[row]] = np.repeat([c.isalpha() for c in word], [len(c.encode()) for c in word])
    return mask


def train(texts: list[str], labels: list[str], hidden: int = 12, steps: int = 500, batch: int = 512,
          rate: float = 0.01, seed: int = 7) -> BiGru | None:
    """Fit the network on words of labelled texts, drawn with equal weight per language."""
    langs = sorted(set(labels))
    pools = [[p for t, l in zip(texts, labels) if l == lang for w in t.split() if _LETTER.search(w)
              for p in pieces(w.encode())] for lang in langs]
    langs, pools = [l for l, p in zip(langs, pools) if p], [p for p in pools if p]
    if not langs:
        return None
    rng = np.random.default_rng(seed)
    net = BiGru.fresh(langs, hidden, rng)
    m = {k: np.zeros_like(v) for k, v in net.params.items()}
    v = {k: np.zeros_like(x) for k, x in net.params.items()}
    for step in range(1, steps + 1):
        label = rng.integers(len(langs), size=batch)
        words = [pools[k][rng.integers(len(pools[k]))] for k in label]
        sizes = np.fromiter(map(len, words), np.int64, batch)
        data = packed(words, int(sizes.max()))
        mask = letter_mask(data, sizes).astype(np.float32)
        _, g = net.gradients(data, sizes, label, mask)
        lr = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, p in net.params.items():
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
            p -= (lr * m[k] / (1 - 0.9 ** step) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return net


class Pooled:
    """Per worker: sums of position probabilities of the words seen so far, and documents pooled from them."""

    def __init__(self, net: BiGru):
        self.net = net
        self.forget()

    def forget(self) -> None:
        self.index = _Index()
        self.sums = np.zeros((1024, len(self.net.langs) + 1), np.float32)

    def learn(self, new: list[str], at: int) -> None:
        """Enter the sums of ``new`` words, numbered from ``at`` on: probabilities, then letter positions."""
        need = at + len(new)
        if need > len(self.sums):
            grown = np.zeros((max(need, 2 * len(self.sums)), self.sums.shape[1]), np.float32)
            grown[:at] = self.sums[:at]
            self.sums = grown
        owners, words = [], []
        for i, w in enumerate(new):
            own = pieces(w.encode())
            owners += [at + i] * len(own)
            words += own
        owner = np.array(owners, np.int64)
        for block, data, size, p in self.net.positions(words):
            mask = letter_mask(data, size)
            np.add.at(self.sums[:, :-1], owner[block], (p * mask[:, :, None]).sum(1))
            np.add.at(self.sums[:, -1], owner[block], mask.sum(1))

    def documents(self, texts: list[str]) -> np.ndarray:
        """(documents, languages): mean probabilities over letter positions; zeros without any."""
        if len(self.index) > CACHE_ENTRIES:
            self.forget()
        known, ids, counts = len(self.index), [], []
        look = self.index.__getitem__
        for text in texts:
            words = text.split()
            ids.append(np.fromiter(map(look, words), np.int64, len(words)))
            counts.append(len(words))
        new = list(self.index)[known:] if len(self.index) > known else []
        if new:
            self.learn(new, known)
        out = np.zeros((len(texts), self.sums.shape[1]))
        for i, found in enumerate(ids):
            for s in range(0, len(found), 1 << 16):
                out[i] += self.sums[found[s:s + (1 << 16)]].sum(0, dtype=np.float64)
        return out[:, :-1] / np.maximum(out[:, -1:], 1)


class _Index(dict):
    """Words numbered in the order they are first seen."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


def training_sample(df: DataFrame, lang_col: str, per_language: int, max_bytes: int, id_col: str,
                    text_col: str) -> tuple[list[str], list[str]]:
    """Texts and languages of a bounded sample, by a hash order of ids, so that it does not depend on partitions.

    Counts per language give the share of its hash range that holds about twice the rows wanted; only
    those rows are ranked, so the ranking's size does not grow with the table.
    """
    rows = df.where(F.col(lang_col).isNotNull() & (F.octet_length(text_col) <= max_bytes)).select(
        F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    share = rows.groupBy("lang").agg(F.ceil((1 << 30) * F.least(F.lit(1.0), (2 * per_language + 50) / F.count("*")))
                                     .alias("until"))
    first = Window.partitionBy("lang").orderBy("place", "id", "text")
    picked = (rows.withColumn("place", place).join(F.broadcast(share), "lang").where("place < until")
              .withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_language)
              .orderBy("lang", "n").select("text", "lang").collect())
    return [r.text for r in picked], [r.lang for r in picked]


def fit(df: DataFrame, lang_col: str = "lang", per_language: int = 300, max_bytes: int = 20_000,
        id_col: str = "doc_id", text_col: str = "text", **options) -> BiGru | None:
    """Train on a bounded sample of the labelled rows; None when there is none."""
    return train(*training_sample(df, lang_col, per_language, max_bytes, id_col, text_col), **options)


def predict(df: DataFrame, net: BiGru | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score): the most probable language of each whole text and its pooled probability."""
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pooled = Pooled(net) if net else None
        for part, texts in text_slices(batches):
            p = pooled.documents(texts) if pooled else np.zeros((len(texts), 1))
            letters = [bool(pooled and _LETTER.search(t)) for t in texts]
            best = p.argmax(1)
            lang = [net.langs[k] if ok else UNDETERMINED for k, ok in zip(best, letters)]
            score = np.where(letters, np.clip(p[np.arange(len(p)), best], 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang, pa.string()), pa.array(score)],
                                             names=[id_col, "lang_pred", "score"])

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, lang_pred string, score double")


def label_positions(df: DataFrame, net: BiGru, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, runs): the language of every letter position as runs of UTF-8 byte offsets (end exclusive)."""
    id_type = df.schema[id_col].dataType.simpleString()
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, limit=1 << 20):
            runs = pa.array([position_runs(net, t) for t in texts], kind)
            yield pa.RecordBatch.from_arrays([part.column(0), runs], names=[id_col, "runs"])

    return df.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {id_type}, runs array<struct<start:int,end:int,lang:string>>")


def position_runs(net: BiGru, text: str) -> list[dict]:
    data = np.frombuffer(text.encode(), np.uint8)
    label = np.full(len(data), -1)
    words, starts = [], []
    at = 0
    for word in regex.splititer(r"(\s+)", text):
        b = word.encode()
        if word.strip():
            own = pieces(b)
            words += own
            starts += (at + np.cumsum([0, *map(len, own[:-1])])).tolist()
        at += len(b)
    for block, packed_words, size, p in net.positions(words):
        best = np.where(letter_mask(packed_words, size), p.argmax(2), -1)
        for row, i in enumerate(block):
            label[starts[i]:starts[i] + size[row]] = best[row, :size[row]]
    edges = np.flatnonzero(np.diff(label)) + 1
    return [{"start": int(s), "end": int(e), "lang": net.langs[label[s]]}
            for s, e in zip([0, *edges], [*edges, len(label)]) if e > s and label[s] >= 0]
