"""URL filters: host rules, and a weighted vocabulary counted by an Aho-Corasick automaton.

Rules are (host, path, verdict): one fits a URL whose host is the rule's or a subdomain of it and
whose path starts with the rule's; of several, the longest (host and path together, then host) decides.
They are bounded in number and become one expression beside the scan.

URLs without a fitting rule go by their words.  One automaton over the whole vocabulary walks the
URLs of a batch laid end to end, so a URL is read once however many terms there are.  A hit counts where
neither neighbour is an ASCII letter or digit (``bet`` is not in ``alphabet``).  A strict term rejects alone; soft
terms add their weights, each distinct term once, and reject from ``REJECT`` on; no soft term weighs that
much, so several different ones are needed.  Nothing is shuffled or collected.

Defined results: a NULL URL, or one without ``://``, has the empty host and path and fits no rule; a NULL or
empty URL has no hits and is allowed; only A-Z are lower-cased; percent escapes are not decoded; other
letters than ASCII ones are boundaries.  Rows are kept as they are, repeated and NULL ids too; all columns of the
input stay, and the result column replaces one of its name.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import SLICE_BYTES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWERED = str.maketrans(UPPER, LOWER)
#: A URL whose distinct terms weigh so much together is rejected; a strict term weighs that much.
REJECT = 4
MOST_RULES = 2_000


@dataclass(frozen=True)
class Term:
    text: str
    weight: int

    @property
    def strict(self) -> bool:
        return self.weight >= REJECT


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def terms(strict: str, firm: str, soft: str) -> tuple[Term, ...]:
    """A vocabulary from words: strict ones, and soft ones of weight 3 and 2."""
    return tuple(Term(w, n) for words, n in ((strict, REJECT), (firm, 3), (soft, 2)) for w in words.split())


VOCABULARY = terms(
    strict="adult casino escort hentai malware phishing pills porn spam viagra warez xxx",
    firm="betting bets gambling jackpot lottery poker slots",
    soft="ads bonus cheap click clickbait coupon deals discount free loans offer popup promo sale track tracker win winner")


def check_vocabulary(vocabulary: Sequence[Term]) -> None:
    seen = [t.text for t in vocabulary]
    if len(set(seen)) < len(seen) or any(not t or t != t.translate(_LOWERED) or "\n" in t for t in seen):
        raise ValueError("terms must be different, lower-case, of one line and not empty")
    if any(t.weight <= 0 for t in vocabulary):
        raise ValueError("weights must be positive")


# ---- rules: expressions ------------------------------------------------------
def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct (name, verdict), or NULL."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules fit into one expression")
    found = F.lit(None).cast("struct<name:string,verdict:string>")
    for r in sorted(set(rules), key=lambda r: (len(r.name), len(r.host), r.name, r.verdict)):
        if r.verdict not in ("allow", "block"):
            raise ValueError(f"unknown verdict {r.verdict!r}")
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


# ---- vocabulary: the automaton -------------------------------------------------
@lru_cache(maxsize=4)
def _automaton(words: tuple[str, ...]):
    import ahocorasick
    machine = ahocorasick.Automaton()
    for i, w in enumerate(words):
        machine.add_word(w, i)
    machine.make_automaton()
    return machine


def _word(c: str) -> bool:
    return c.isascii() and c.isalnum()


def find_terms(urls: Sequence[str], vocabulary: Sequence[Term]) -> list[list[tuple[int, int, int]]]:
    """Per URL its bounded hits (term number, start, end) in order; one walk over all of them."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in urls]
    if not vocabulary:
        return found
    text = "\n".join(urls).translate(_LOWERED)
    begins = np.cumsum([0, *[len(u) + 1 for u in urls[:-1]]])
    hits = [(last + 1 - len(vocabulary[i].text), last + 1, i)
            for last, i in _automaton(tuple(t.text for t in vocabulary)).iter(text)]
    inside = [h for h in hits if not (h[0] and _word(text[h[0] - 1]) or h[1] < len(text) and _word(text[h[1]]))]
    inside.sort()
    owners = np.searchsorted(begins, [h[0] for h in inside], side="right") - 1
    for row, (start, end, i) in zip(owners.tolist(), inside):
        found[row].append((i, start - int(begins[row]), end - int(begins[row])))
    return found


HITS = "array<struct<term:string,weight:int,start:int,end:int>>"


def _runs(sizes: Sequence[int]) -> Iterator[tuple[int, int]]:
    """Consecutive rows of at most ``SLICE_BYTES`` characters together, one at least."""
    start = held = 0
    for i, n in enumerate(sizes):
        if i > start and held + n > SLICE_BYTES:
            yield start, i
            start, held = i, 0
        held += n
    if sizes:
        yield start, len(sizes)


def term_hits(url: Column, vocabulary: Sequence[Term]) -> Column:
    """The bounded hits of a URL: array of (term, weight, start, end), positions in code points."""
    check_vocabulary(vocabulary)
    words = tuple(vocabulary)
    kind = pa.list_(pa.struct([("term", pa.string()), ("weight", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))

    @F.arrow_udf(HITS)
    def hits(urls: pa.Array) -> pa.Array:
        rows = [u or "" for u in urls.to_pylist()]
        out = []
        for a, b in _runs([len(u) for u in rows]):
            out += [[{"term": words[i].text, "weight": words[i].weight, "start": s, "end": e} for i, s, e in row]
                    for row in find_terms(rows[a:b], words)]
        return pa.array(out, type=kind)

    return hits(url)


def judge(df: DataFrame, rules: Sequence[Rule], vocabulary: Sequence[Term] = VOCABULARY, url_col: str = "url",
          out: str = "judged") -> DataFrame:
    """``df`` with a column ``out``: struct (host, path, rule, hits, n_strict, n_soft, weight, verdict).

    ``n_strict`` counts hits of strict terms, ``n_soft`` distinct soft terms, ``weight`` adds the weights of distinct
    terms; ``verdict`` is the rule's, else ``block`` from a weight of ``REJECT`` on, else ``allow``.
    """
    host, path = host_of(F.col(f"`{url_col}`")), path_of(F.col(f"`{url_col}`"))
    rule = fitting_rule(host, path, rules)
    hits = term_hits(F.col(f"`{url_col}`"), vocabulary)
    named = df.withColumn(out, F.struct(host.alias("host"), path.alias("path"), rule.alias("rule"), hits.alias("hits")))
    got = F.col(f"`{out}`")
    distinct = F.array_distinct(F.transform(got["hits"], lambda h: F.struct(h["term"], h["weight"])))
    weight = F.aggregate(distinct, F.lit(0), lambda n, h: n + h["weight"])
    return named.withColumn(out, F.struct(
        got["host"].alias("host"), got["path"].alias("path"), got["rule"]["name"].alias("rule"), got["hits"].alias("hits"),
        F.size(F.filter(got["hits"], lambda h: h["weight"] >= REJECT)).alias("n_strict"),
        F.size(F.filter(distinct, lambda h: h["weight"] < REJECT)).alias("n_soft"), weight.alias("weight"),
        F.coalesce(got["rule"]["verdict"], F.when(weight >= REJECT, "block").otherwise("allow")).alias("verdict")))


def allowed(df: DataFrame, rules: Sequence[Rule], vocabulary: Sequence[Term] = VOCABULARY, url_col: str = "url") -> DataFrame:
    """The rows of ``df`` (its own columns) whose URL is allowed."""
    judged = judge(df, rules, vocabulary, url_col, out="__judged")
    return judged.where("__judged.verdict = 'allow'").drop("__judged")
