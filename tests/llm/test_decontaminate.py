import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stratum.llm import decontaminate as dc


@pytest.fixture(scope="module")
def items_of(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, "k") for i, t in rows], "item_id long, text string, key string")
    return make


def runs(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return [tuple(words[i:i + 5]) for i in range(len(words) - 4)]


def similarity(a, b):
    both = sum((Counter(a) & Counter(b)).values())
    return both / (len(a) + len(b) - both)


def brute(docs, items, threshold=0.8):
    """Every window of an item's size at every place."""
    out = {}
    for d, text in docs:
        doc = runs(text)
        for i, item in items:
            want = runs(item)
            sims = [similarity(doc[s:s + len(want)], want) for s in range(len(doc))] if want else []
            if sims and max(sims) >= threshold:
                out[(d, i)] = pytest.approx(max(sims))
    return out


def found(df):
    return {(r.doc_id, r.item_id): r.similarity for r in df.collect()}


def test_blocks_guarantee_the_radius(spark):
    rnd = random.Random(1)
    pairs = []
    for _ in range(500):
        a = rnd.getrandbits(64)
        b = a
        for bit in rnd.sample(range(64), dc.RADIUS):
            b ^= 1 << bit
        pairs.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    df = spark.createDataFrame(pairs, "a long, b long")
    shared = df.select(F.size(F.array_intersect(dc.blocks("a"), dc.blocks("b"))).alias("n"), dc.blocks("a").alias("x"))
    assert shared.where("n = 0").count() == 0
    r = df.select("a", dc.blocks("a").alias("x")).first()
    cuts = [64 * i // (dc.RADIUS + 1) for i in range(dc.RADIUS + 2)]
    assert sum(x.bits << cuts[x.block] for x in r.x) == r.a % (1 << 64)


def test_simhash_is_a_weighted_majority(spark):
    rnd = random.Random(2)
    hashes = [rnd.getrandbits(64) - (1 << 63) for _ in range(9)] + [5, 5, 5]
    got = spark.createDataFrame([(hashes,)], "h array<long>").select(dc.simhash("h").alias("s")).first().s
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert got % (1 << 64) == want


def test_edited_passages_equal_brute_force(docs_of, items_of):
    rnd = random.Random(3)

    def word():
        return rnd.choice("abcdefgh") + str(rnd.randint(0, 60))
    items = [(i, " ".join(word() for _ in range(rnd.randint(15, 60)))) for i in range(12)]
    docs = []
    for d in range(60):
        words = rnd.choice(items)[1].split()
        for _ in range(rnd.randint(0, 2)):
            at = rnd.randrange(len(words))
            words[at:at + rnd.randint(0, 1)] = [word()] * rnd.randint(0, 2)
        before, after = ([word() for _ in range(rnd.randint(0, 40))] for _ in range(2))
        docs.append((d, " ".join(before + words + after).upper() if d % 3 else ", ".join(before + words)))
    got = found(dc.contaminated(docs_of(docs), items_of(items)))
    want = brute(docs, items)
    assert set(got) == set(want) and len(want) > 20
    for k, v in want.items():
        assert got[k] == v


def test_unit_cells_share_what_the_weights_share(spark):
    rnd = random.Random(4)
    pairs = [tuple([rnd.randint(0, 6) for _ in range(rnd.randint(0, 30))] for _ in range(2)) for _ in range(200)]
    df = spark.createDataFrame(pairs, "a array<long>, b array<long>")
    for r in df.select("a", "b", dc.unit_cells("a").alias("x"), dc.unit_cells("b").alias("y")).collect():
        assert len(set(r.x)) == len(r.x) == len(r.a)
        assert len(set(r.x) & set(r.y)) == sum((Counter(r.a) & Counter(r.b)).values())


def test_runs_of_one_word_beside_a_passage(docs_of, items_of):
    """Item and document end in runs of different words; what they share is over the threshold."""
    rnd = random.Random(5)
    items, docs = [], []
    for i in range(30):
        n = rnd.choice((55, 120, 200))
        run = int(n * 0.11)
        words = [f"w{i}x{j}" for j in range(n + 4 - run)]
        items.append((i, " ".join(words + ["so"] * run)))
        docs.append((i, " ".join(["before"] * 9 + words + ["very"] * (run + 9))))
        docs.append((100 + i, " ".join(words + [f"v{j}" for j in range(run)])))
    got, want = found(dc.contaminated(docs_of(docs), items_of(items))), brute(docs, items)
    assert len(want) == 60 and set(got) == set(want)
    for k, v in want.items():
        assert got[k] == v


def test_frame_edges(docs_of, items_of):
    item = "one two three four five six seven eight nine ten"
    docs = [(1, None), (2, ""), (3, item), (3, item), (4, f"so {item}, yes"), (5, "x " * 50_000 + item), (6, "one two"),
            (None, item), (7, "a a a a a a a a a a")]
    items = [(0, item), (1, None), (2, ""), (3, "one two"), (4, "a a a a a a a a"), (None, item), (0, item)]
    got = Counter((r.doc_id, r.item_id) for r in dc.contaminated(docs_of(docs), items_of(items)).collect())
    assert got == Counter({(d, i): n for d, n in ((3, 2), (4, 1), (5, 1), (None, 1)) for i in (0, 3, None)} | {(7, 4): 1, (6, 3): 1})
    clean = dc.without_benchmark(docs_of(docs), items_of(items))
    assert clean.columns == ["doc_id", "text", "kept", "n_tokens"]
    assert sorted(r.doc_id for r in clean.collect()) == [1, 2]
    assert dc.contaminated(docs_of([]), items_of(items)).count() == 0
    assert dc.contaminated(docs_of(docs), items_of([])).count() == 0


def test_short_items_match_where_their_words_stand(docs_of, items_of):
    docs = [(1, "Big red; dog"), (2, "big dog red"), (3, "the big red dog big red dog"), (4, "red"), (5, "bigred dog"), (6, "x " * 30_000 + "RED")]
    items = [(1, "big red dog"), (2, "Red!"), (3, "dog big red dog"), (4, "..."), (5, "red dog big red dog")]
    rows = {(r.doc_id, r.item_id): (r.similarity, r.start_word, r.n_words)
            for r in dc.contaminated(docs_of(docs), items_of(items)).collect()}
    assert rows == {(1, 1): (1.0, 0, 3), (3, 1): (1.0, 1, 3), (1, 2): (1.0, 1, 1), (2, 2): (1.0, 2, 1), (3, 2): (1.0, 2, 1),
                    (4, 2): (1.0, 0, 1), (6, 2): (1.0, 30_000, 1), (3, 3): (1.0, 3, 4), (3, 5): (1.0, 2, 5)}


def test_a_window_is_compared_with_its_own_items_only(spark, docs_of, items_of):
    """Items of one length and no common shingle: a candidate row for each block of a window and its item at most."""
    rnd = random.Random(8)
    items = [(i, " ".join(f"w{i}x{rnd.randint(0, 9)}" for _ in range(20))) for i in range(30)]
    docs = [(i, t) for i, t in items]
    bench = dc.with_shingles(items_of(items).select("item_id", "text")).where("hashes is not null")
    windows = bench.select(F.monotonically_increasing_id().alias("key"), F.lit(0).alias("start"), "n_words",
                           F.array(F.struct("item_id")).alias("items"), dc.simhash(dc_cells()).alias("print"))
    assert dc.candidates(windows, bench).count() == 30 * (dc.RADIUS + 1)
    assert len(found(dc.contaminated(docs_of(docs), items_of(items)))) == 30


def dc_cells():
    return "transform(hashes, (h, i) -> if(array_position(hashes, h) = i + 1, h, xxhash64(h, size(filter(slice(hashes, 1, i), x -> x = h)))))"


def test_same_result_without_broadcast(docs_of, items_of, monkeypatch):
    item = "one two three four five six seven eight nine ten"
    monkeypatch.setattr(dc, "small_side", lambda df: df)
    assert found(dc.contaminated(docs_of([(1, item), (2, "no")]), items_of([(0, item)]))) == {(1, 0): 1.0}


def test_no_python_in_plan(docs_of, items_of):
    plan = dc.contaminated(docs_of([(1, "a")]), items_of([(1, "b")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
