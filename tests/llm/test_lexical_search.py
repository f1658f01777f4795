import math
import random
import re
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest

from stratum.llm import lexical_search as ls

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UP = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def terms_of(text):
    return TERM.findall((text or "").translate(UP))


def brute(docs, items, k=10):
    bags = [(i, Counter(terms_of(t)), len(terms_of(t))) for i, t in docs if terms_of(t)]
    n_docs, n_terms = len(bags), sum(n for *_, n in bags)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms_of(t))
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item, terms in asked.items():
        scores = []
        for i, bag, n in bags:
            m = 10 + 90 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
                        for t in terms if t in bag)
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, rank, None if null else i, -s) for rank, (s, null, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def search(spark):
    def run(docs, items, k=10, parts=3):
        d = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, score int, terms int").repartition(parts)
        q = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
        return sorted([tuple(r) for r in ls.search(d, q, k).collect()], key=str)
    return run


def corpus(n, seed, words=60, most=40):
    r = random.Random(seed)
    names = [f"w{i}" for i in range(words)] + ["É", "日本", "Ab", "x1"]
    odds = [1 / (i + 1) for i in range(len(names))]
    docs = [(i, " ".join(r.choices(names, odds, k=r.randint(0, most)))) for i in range(n)]
    return docs + [(n + i, docs[i % n][1]) for i in range(n // 5)]


@pytest.mark.parametrize("n,seed,k", [(40, 1, 10), (300, 2, 10), (300, 3, 1), (300, 4, 400)])
def test_equals_brute_force(search, n, seed, k):
    docs = corpus(n, seed)
    items = [(i, t) for i, t in corpus(12, seed + 9, most=15)]
    assert search(docs, items, k) == brute(docs, items, k)


def test_small_trees_and_blocks(search, monkeypatch):
    docs, items = corpus(200, 5), corpus(20, 6, most=15)
    want = brute(docs, items)
    monkeypatch.setattr(ls, "BLOCK_TERMS", 20)
    assert search(docs, items) == want


def test_awkward_rows(search):
    docs = [(1, None), (2, ""), (3, " .,!"), (None, "abc def"), (None, "abc def"), (4, "abc def"), (4, "abc def"), (4, "abc"),
            (5, "ABCÉ déf \x7f{}|~@[`:/"), (6, "abc " * 300_000), (7, "abcdef" * 200_000 + " def"), (8, "İ ı K")]
    items = [(1, "abc abc DEF"), (1, "déf"), (2, None), (3, "..."), (None, "abcÉ zzz"), (4, "İ"), (4, "İ")]
    assert search(docs, items) == brute(docs, items)


def test_empty_tables(search):
    assert search([], [(1, "a")]) == [] and search([(1, "a")], []) == [] and search([], []) == []
    assert search([(1, None)], [(1, "a")]) == []


def test_other_id_types_and_columns(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), ("c", "z")], "key string, body string")
    items = spark.createDataFrame([("q", "x")], "q string, ask string")
    got = ls.search(docs, items, 5, "key", "body", "q", "ask").orderBy("rank").collect()
    assert [(r.item_id, r.rank, r.doc_id) for r in got] == [("q", 1, "a"), ("q", 2, "b")]


def test_terms():
    for t in ("", "a", "A-Z a_b [x] {y} 0:9;é\x80ü ß", "日本 語　x y", "q" * 50 + " " + "r" * 50):
        assert [b.decode() for p in ls.pieces(t.encode()) for b in p] == terms_of(t)


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(ls, "PIECE", 7)
    t = "abcdefghijkl mn op qrstuvwxyz0123456789 a b c d e f g hijklmnopq"
    assert [b.decode() for p in ls.pieces(t.encode()) for b in p] == terms_of(t)


def tree_of(n, seed, items=8, asked=None):
    r = np.random.default_rng(seed)
    weights = np.sort(r.integers(1, 9000, 50))
    ranks = [np.sort(r.choice(50, r.integers(1, 12), replace=False)) for _ in range(items)]
    asked = asked or ls.Asked(np.arange(50), weights, ranks, n, n * 20, 5)
    vectors = []
    for _ in range(n):
        t = np.flatnonzero(r.random(50) < 3 / (np.arange(50) + 2)).astype(np.int32)
        vectors.append((t, r.integers(1, 9, len(t))))
    return asked, ls.Tree(asked, list(range(n)), r.integers(10, 300, n), vectors)


def test_nodes_part_the_documents_and_bounds_hold():
    asked, tree = tree_of(700, 1)
    todo, runs = [(0, 700)], []
    while todo:
        lo, hi = todo.pop()
        assert (tree.scores(lo, hi, np.arange(8)).max(axis=0) <= tree.bound(lo, hi)).all()
        if hi - lo <= ls.RUN:
            runs.append((lo, hi))
            continue
        below = tree.children(lo, hi)
        assert below[0][0] == lo and below[-1][1] == hi and all(a[1] == b[0] for a, b in zip(below, below[1:]))
        assert len(below) > 1
        todo += below
    assert sorted(runs)[0][0] == 0 and sum(hi - lo for lo, hi in runs) == 700


def test_branches_are_left_out():
    asked, _ = tree_of(4000, 2)
    asked = replace(asked, ranks=[np.array([3, 20, 30, 45])])
    tree = tree_of(4000, 2, asked=asked)[1]
    best = ls.Best(1, 5)
    scored = tree.search(best)
    every = tree.scores(0, 4000, np.arange(1))[:, 0]
    assert [-s for s, *_ in best.rows[0]] == sorted(every.tolist(), reverse=True)[:5]
    assert scored < 1000
