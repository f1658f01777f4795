"""Exact token counts at every prefix of a text, by prefix dynamic programming.

The vocabulary is a byte-pair encoding with word ends, in the ``tokenizers``
JSON format, whose path is a parameter.  Its encoding of a word has the prefix
property: taking the last token off a valid encoding leaves the valid encoding
of the rest.  So the last token at each prefix follows from the last tokens at
shorter prefixes: it is the one vocabulary entry that ends there and may stand
next to the last token before it.  One table row per prefix (last token, count)
then answers how long a text is in tokens, how many tokens a cut text has, and
where to cut for a budget, without encoding again.

A text splits into words by the vocabulary's own rules, so the count at a prefix
of a text is the sum over the whole words before it plus the count at a prefix
of the last word.  Tables of words are kept per worker and shared between
texts, and dropped when they outgrow ``CACHE_ENTRIES`` (they are only a memo).

Prefixes are prefixes of the normalised text (lower case, white space as in
the vocabulary's normaliser), which has one character per input character but
for rare compositions.  Defined results: NULL counts as the empty text, which has
no token; texts of any length are read whole; only the id and text columns are
read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stratum.llm.common import text_slices

CACHE_ENTRIES = 300_000
END = "</w>"

# Latin letters up to U+024F, digits and white space as the vocabulary's pattern sees them
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾", " \\t\\n\\x0b\\x0c\\r\\x85\\xa0"
_PLAIN_WORDS = re.compile(f"[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")
# outside these, normalisation and character classes are left to the vocabulary's own library
_UNUSUAL = re.compile("[^\x00-ɏ‐-‧‰-⁞]")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones stand for themselves."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


class PrefixCounter:
    """Token counts of a vocabulary at all prefixes of words and texts."""

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.ranks = {(a, b): i for i, (a, b) in enumerate(pairs)}
        self.made: dict[str, tuple[int, str, str]] = {}  # token: rank and parts of the merge that makes it
        for (a, b), i in self.ranks.items():
            self.made.setdefault(a + b, (i, a, b))
        self.special = [t["content"] for t in spec["added_tokens"]]
        self._special = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        vocab = [t for t in model["vocab"] if t not in self.special]
        self.inner = {t for t in vocab if not t.endswith(END)}
        self.last = {t[:-len(END)] for t in vocab if t.endswith(END)}
        self.longest = max(map(len, self.inner | self.last))
        self.letters = byte_letters()
        self.table = str.maketrans({chr(b): c for b, c in enumerate(self.letters) if b < 128 and chr(b) != c})
        self.forget()
        self.fits: dict[tuple[str, str], bool] = {}
        self.totals = _Totals(self)

    def forget(self) -> None:
        self.inside: dict[str, tuple[str, int]] = {"": ("", 0)}

    def fit(self, before: str, token: str, final: bool) -> bool:
        """Whether ``token`` may follow the token ``before`` ('': the word begins here)."""
        if final:
            token += END
        key = (before, token)
        if (known := self.fits.get(key)) is None:
            if len(self.fits) > CACHE_ENTRIES:
                self.fits.clear()
            known = self.fits[key] = self.apart(before, token) if before else True
        return known

    def apart(self, left: str, right: str) -> bool:
        """Whether two neighbouring tokens stay apart: run their own merges backwards, latest first, and
        see that no merge across the border would have come before the one just taken back."""
        ranks, made, never = self.ranks, self.made, -1
        until = len(ranks)
        while True:
            if ranks.get((left, right), until) < until:
                return False
            a, b = made.get(left), made.get(right)
            ra, rb = a[0] if a else never, b[0] if b else never
            if ra == rb == never:
                return True
            if ra > rb:  # left was made last: before that, its right part stood at the border
                until, left = ra, a[2]
            else:  # a merge over the border of the same rank comes first, being further left
                until, right = rb + 1, b[1]

    def step(self, word: str, end: int, final: bool) -> tuple[str, int]:
        """(last token, count) at the prefix of ``end`` letters; ``final``: the word ends there."""
        known, tokens = self.inside, self.last if final else self.inner
        before, n = known[word[:end - 1]]
        token = before + word[end - 1]  # most often the last token grows by the new letter, or the letter stands alone
        if token in tokens:
            older, m = known[word[:end - len(token)]]
            if self.fit(older, token, final):
                return token, m + 1
        token = word[end - 1]
        if before and self.fit(before, token, final):
            return token, n + 1
        for start in range(max(0, end - self.longest), end - 1):
            token = word[start:end]
            if token in tokens:
                before, n = known[word[:start]]
                if self.fit(before, token, final):
                    return token, n + 1
        raise ValueError(f"no encoding of {word[:end]!r}")

    def fill(self, word: str, upto: int) -> None:
        """Enter the prefixes of a word of up to ``upto`` letters into the shared table."""
        if len(self.inside) > CACHE_ENTRIES:
            self.forget()
        known = self.inside
        n = upto
        while word[:n] not in known:
            n -= 1
        for end in range(n + 1, upto + 1):
            known[word[:end]] = self.step(word, end, final=False)

    def spelled(self, word: str) -> str:
        """The word's bytes as letters of the vocabulary."""
        if word.isascii():
            return word.translate(self.table)
        letters = self.letters
        return "".join([letters[b] for b in word.encode()])

    def word_count(self, word: str) -> int:
        word = self.spelled(word)
        if len(word) > 512:  # a table of all prefixes of a very long word holds their characters only once
            return int(self.long_counts(word)[-1])
        self.fill(word, len(word) - 1)
        return self.step(word, len(word), final=True)[1]

    def long_counts(self, word: str) -> np.ndarray:
        """Counts at every prefix of a spelled word, by position instead of by prefix string."""
        last, counts, out = [""], [0], np.zeros(len(word) + 1, np.int32)
        for end in range(1, len(word) + 1):
            for final in (True, False):
                tokens = self.last if final else self.inner
                for start in range(max(0, end - self.longest), end):
                    token = word[start:end]
                    if token in tokens and (last[start] or not start) and self.fit(last[start], token, final):
                        if final:
                            out[end] = counts[start] + 1
                        else:
                            last.append(token)
                            counts.append(counts[start] + 1)
                        break
        return out

    def words(self, text: str) -> list[str]:
        """The words of a text after normalisation; special strings count as ordinary text."""
        if text.isascii() or not _UNUSUAL.search(text):
            text = text.lower()
            return (_WORDS if "'" in text else _PLAIN_WORDS).findall(text)
        text = self.library.normalizer.normalize_str(text)
        back = {c: b for b, c in enumerate(self.letters)}
        return [bytes(back[c] for c in w).decode("utf-8") for w, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def segments(self, text: str) -> list[tuple[str, str]]:
        """The text cut at its special strings, as they stand in it: (what is before, special string), the last without one.
        Only then is it normalised, so that a string that lower-casing makes look special is not."""
        if not self._special or "<|" not in text:
            return [(text, "")]
        return list(zip(self._special.split(text), [*self._special.findall(text), ""]))

    def count(self, text: str) -> int:
        return sum(sum(map(self.totals.__getitem__, self.words(part))) + bool(special) for part, special in self.segments(text))

    def normalised(self, text: str) -> str:
        return "".join(self.library.normalizer.normalize_str(part) + special for part, special in self.segments(text))

    def prefix_counts(self, text: str) -> np.ndarray:
        """Tokens of each prefix of the normalised text, at lengths 0 to its length.  A prefix that ends inside a special
        string ends in ordinary text."""
        tables, total = [], 0
        for part, special in self.segments(text):
            part = self.library.normalizer.normalize_str(part)
            table = total + self.plain_counts(part + special)
            total = int(table[len(part)]) + bool(special)
            tables.append(table[:-1] if special else table)  # the whole special string is the next table's first place
        return np.concatenate(tables)

    def plain_counts(self, text: str) -> np.ndarray:
        """Tokens of each prefix of a normalised text without special strings."""
        out, at, total = np.zeros(len(text) + 1, np.int32), 0, 0
        for word in self.words(text):
            start = text.index(word, at)
            out[at:start + 1] = total
            table = self.long_counts(self.spelled(word))
            ends = np.cumsum([len(c.encode()) for c in word])
            out[start + 1:start + len(word) + 1] = total + table[ends]
            if word in ("'re", "'ve", "'ll"):  # cut inside a contraction, the quote stands alone
                out[start + 2] = total + self.totals["'"] + self.totals[word[1]]
            at, total = start + len(word), total + int(table[-1])
        out[at:] = total
        return out

    def cut(self, text: str, budget: int) -> int:
        """The longest prefix (characters of the normalised text) of at most ``budget`` tokens that ends after a word or a
        special string; the whole text if it has no more."""
        done, spent = 0, 0
        for part, special in self.segments(text):
            words = self.words(part)
            totals = np.cumsum([self.totals[w] for w in words], dtype=np.int64)
            n = int(np.searchsorted(totals, budget - spent, side="right"))
            part = self.library.normalizer.normalize_str(part)
            if n < len(words) or special and spent + (int(totals[-1]) if n else 0) + 1 > budget:
                at = 0
                for w in words[:n]:
                    at = part.index(w, at) + len(w)
                return done + at
            spent += (int(totals[-1]) if n else 0) + bool(special)
            done += len(part) + len(special)
        return done


class _Totals(dict):
    """Counts of whole words, worked out when first asked for."""

    def __init__(self, counter: PrefixCounter):
        super().__init__()
        self.counter = counter

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE_ENTRIES:
            self.clear()
        n = self[word] = self.counter.word_count(word)
        return n


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    """One counter per worker and vocabulary."""
    return PrefixCounter(path)


def count_tokens(df: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row: id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens), and cut_chars: where the
    normalised text is to be cut to hold ``limit`` tokens at most (after a word; NULL where it need not be)."""
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for part, texts in text_slices(batches):
            n = np.fromiter(map(c.count, texts), np.int64, len(texts))
            cuts = pa.array([c.cut(t, limit) if m > limit else None for t, m in zip(texts, n.tolist())], pa.int64())
            size = pa.array([len(t) if t.isascii() else len(t.encode()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), size, pa.array(n), pa.array(n > limit), cuts],
                                             names=[id_col, "n_bytes", "n_tokens", "over_limit", "cut_chars"])

    return df.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {id_type}, n_bytes long, n_tokens long, over_limit boolean, cut_chars long")


def prefix_tables(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, the normalised text and its prefix counts, from which :func:`tokens_before` and
    :func:`longest_within` answer in SQL without encoding."""
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for part, texts in text_slices(batches, limit=1 << 20):
            norm = [c.normalised(t) for t in texts]
            counts = pa.array([c.prefix_counts(t) for t in texts], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(norm, pa.string()), counts],
                                             names=[id_col, "normalised", "prefix_counts"])

    return df.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {id_type}, normalised string, prefix_counts array<int>")


def tokens_before(chars: str, counts: str = "prefix_counts") -> str:
    """SQL: tokens of the first ``chars`` characters."""
    return f"{counts}[least({chars}, size({counts}) - 1)]"


def longest_within(budget: str, counts: str = "prefix_counts") -> str:
    """SQL: the longest prefix, in characters, whose token count is within ``budget``."""
    return f"aggregate({counts}, named_struct('at', -1, 'best', -1), " \
           f"(a, n) -> named_struct('at', a.at + 1, 'best', if(n <= {budget}, a.at + 1, a.best)), a -> a.best)"
