import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from conftest import SF_CHECK
from stratum.llm import components, dart_minhash, near_dedup, shingles
from stratum.llm.queries import op5_near_dedup


def cells_of(text):
    words = shingles._WORD.findall((text or "").lower())
    n = min(5, len(words))
    runs = Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) if words else Counter()
    return runs


def similarity(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both) if a and b else 0.0


def brute_classes(rows, threshold=0.8):
    """Classes by comparing all pairs that share a shingle."""
    cells = {i: cells_of(t) for i, t in rows}
    parent = {i: i for i in cells}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def link(a, b):
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)

    by, raw = defaultdict(list), {}
    for i, t in rows:
        for c in cells[i]:
            by[c].append(i)
        if not cells[i]:
            link(i, raw.setdefault(t or "", i))
    for ids in by.values():
        for x in ids:
            for y in ids:
                if x < y and find(x) != find(y) and similarity(cells[x], cells[y]) >= threshold:
                    link(x, y)
    return {i: find(i) for i in cells}


def test_signatures_agree_as_often_as_texts_are_similar():
    rnd = np.random.default_rng(1)
    for shared in (0.3, 0.6, 0.9):
        weights = rnd.integers(1, 4, 200).astype(float)
        other = weights.copy()
        other[: int(200 * (1 - shared))] *= rnd.random(int(200 * (1 - shared)))  # fractions of a cell too
        elements = np.arange(200, dtype=np.uint64) * np.uint64(7919)
        sets, cells, filled = dart_minhash.unit_cells(np.repeat([0, 1], 200), np.tile(elements, 2),
                                                      np.concatenate([weights, other]))
        sig = dart_minhash.signatures(sets, cells, filled, 2, 4000)
        want = np.minimum(weights, other).sum() / np.maximum(weights, other).sum()
        assert (sig[0] == sig[1]).mean() == pytest.approx(want, abs=0.03)


def test_signature_is_the_earliest_dart_of_all():
    """Against all darts up to a far rank, coordinate by coordinate."""
    cells = np.arange(1, 9, dtype=np.uint64) * np.uint64(12345)
    k = 16
    sig = dart_minhash.signatures(np.zeros(8, np.int64), cells, np.ones(8), 1, k)[0]
    best = {}
    for c in cells:
        rank, turn = 0.0, 0
        while rank < 5:
            turn += 1
            dart = dart_minhash.mix64(np.array([(int(c) + turn * int(dart_minhash._STEP)) % 2 ** 64], np.uint64))
            rank -= np.log(dart_minhash.uniform(dart))[0] / k
            more = int(dart_minhash.mix64(dart ^ dart_minhash._STEP)[0])
            j = (more & 0xFFFFFFFF) % k
            if rank < best.get(j, (9e9,))[0]:
                best[j] = (rank, int(dart[0]))
    assert [int(x) for x in sig] == [best[j][1] for j in range(k)]


def test_block_links_equal_brute_force():
    rnd = random.Random(4)
    base = [rnd.getrandbits(60) for _ in range(60)]
    sets = [np.unique(np.array(rnd.sample(base, rnd.randint(45, 60)), np.uint64)) for _ in range(40)]
    component = np.array([rnd.randint(0, 30) for _ in range(40)])

    def close(component_of_links):
        parent = {int(c): int(c) for c in component}

        def find(c):
            while parent[c] != c:
                c = parent[c]
            return c
        for i, j in component_of_links:
            a, b = find(int(component[i])), find(int(component[j]))
            parent[max(a, b)] = min(a, b)
        return [find(int(c)) for c in component]

    every = [(i, j) for i in range(40) for j in range(i)
             if len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))]
    got = near_dedup.block_links(sets, component, 0.8)
    assert close(got) == close(every) and len(got) < 40


def test_components(spark):
    rnd = random.Random(5)
    links = [(i, i + 1) for i in range(100, 200)] + [(0, i) for i in range(1, 60)] + [(3, 3)]
    links += [(rnd.randint(300, 400), rnd.randint(300, 400)) for _ in range(60)]
    parent = {x: x for p in links for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in
           components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
    odd = [(7, 7), (1, 2), (2, 1), (1, 2), (None, 1), (5, None)]
    assert {tuple(r) for r in components.components(spark.createDataFrame(odd, "a long, b long")).collect()} == {
        (7, 7), (1, 1), (2, 1)}


def near_copies(n, words, seed):
    rnd = random.Random(seed)
    base = [f"w{rnd.randint(0, 5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for i in rnd.sample(range(words), rnd.randint(1, 4)):
            copy[i] = f"x{rnd.randint(0, 10 ** 9)}"
        out.append(" ".join(copy))
    return out


def test_mixed_buckets_lose_no_link(docs_of, monkeypatch):
    """Copies around the threshold, where the least node of a bucket is not similar to all: many small blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK_MEMBERS", 7)
    rows = list(enumerate(near_copies(60, 120, 1) + near_copies(30, 60, 2)))
    got = {r.doc_id: r.class_id for r in near_dedup.near_classes(docs_of(rows)).collect()}
    want = brute_classes(rows)
    assert got == want and 1 < len(set(want.values())) < 90


def test_frame_edges(docs_of):
    long = " ".join(f"word{i}" for i in range(40_000))
    rows = [(1, None), (2, ""), (3, "!!"), (4, "!!"), (5, "one two"), (6, "One, two"), (7, "one two three"),
            (8, long), (9, long + " more"), (10, "a b c d e f"), (10, "a b c d e f"), (None, "a b c d e f"), (None, None)]
    got = near_dedup.near_classes(docs_of(rows)).collect()
    assert Counter((r.doc_id, r.class_id, r.kept) for r in got) == Counter(
        [(1, 1, True), (2, 1, False), (3, 3, True), (4, 3, False), (5, 5, True), (6, 5, False), (7, 7, True),
         (8, 8, True), (9, 8, False), (10, 10, True), (10, 10, True), (None, None, True), (None, None, True)])
    kept = near_dedup.one_of_each(docs_of(rows))
    assert kept.columns == ["doc_id", "text", "kept", "n_tokens"]
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 3, 5, 7, 8, 10, 10, None, None])
    assert near_dedup.near_classes(docs_of([])).count() == 0


def test_one_id_with_several_texts(docs_of):
    """Each text of an id has its own class; no text without a copy is lost."""
    a, b, c = "a b c d e f g", "q r s t u v w", "k l m n o p"
    rows = [(3, a), (5, a), (5, b), (5, b), (7, c), (7, None), (9, b), (None, a), (9, "z")]
    got = Counter((r.doc_id, r.class_id, r.kept) for r in near_dedup.near_classes(docs_of(rows)).collect())
    assert got == Counter([(3, 3, True), (5, 3, False), (5, 5, True), (5, 5, True), (7, 7, True), (7, 7, True), (9, 5, False),
                           (None, None, True), (9, 9, True)])
    kept = near_dedup.one_of_each(docs_of(rows))
    assert kept.columns == ["doc_id", "text", "kept", "n_tokens"]
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(
        [(3, a), (5, b), (5, b), (7, c), (7, None), (None, a), (9, "z")])


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()]
    got = {r.doc_id: r.class_id for r in op5_near_dedup(spark, SF_CHECK).collect()}
    assert got == brute_classes(rows)
