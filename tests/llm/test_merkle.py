import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.llm import merkle

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_of(row):
    out = [row]
    while len(row) > 1:
        row = [sha(*row[i:i + 2]) for i in range(0, len(row), 2)]
        out.append(row)
    return out


def leaf_of(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tampered(row):
    i, s, lang, n, t = row
    if i is not None and n is not None and zlib.crc32(str(i).encode()) % 7 == 0:
        return (i, s, lang, n + 1, t)
    return row


def up(levels, at):
    steps = []
    for row in levels[:-1]:
        steps.append(("L" if at & 1 else "R") + row[at ^ 1] if at ^ 1 < len(row) else "-")
        at >>= 1
    return steps


def folded(leaf, steps):
    for s in steps:
        leaf = sha(s[1:], leaf) if s[0] == "L" else sha(leaf, s[1:])  # a lone node has nothing beside it
    return leaf


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    sorted_rows = {g: sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))) for g in order}
    trees = {g: levels_of([leaf_of(r) for r in sorted_rows[g]]) for g in order}
    top = levels_of([trees[g][-1][0] for g in order])
    root = top[-1][0]
    out = []
    for at, g in enumerate(order):
        for i, r in enumerate(sorted_rows[g]):
            steps = up(trees[g], i) + up(top, at)
            end = folded(leaf_of(tampered(r)), steps)
            out.append((r[0], leaf_of(r), trees[g][-1][0], root, sha(*[s[1:] for s in steps]), end, end == root, steps))
    return sorted(out, key=str)


def got(df, height):
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    made = merkle.manifest(merkle.leaves(df, FIELDS, changed={"n_chars": more},
                                         where=F.crc32(F.col("doc_id").cast("string")) % 7 == 0), height)
    rows = merkle.proofs(made).collect()
    return sorted([(r.id, r.leaf, r.subroot, made.root, r.proof_sha256, r.folded_root, r.folded_root == made.root,
                    list(r.steps)) for r in rows], key=str)


@pytest.fixture(scope="module")
def rows_of(spark):
    def make(rows):
        return spark.createDataFrame([(*r, "x", 5, "y") for r in rows], "doc_id long, source string, lang string, n_chars long, "
                                     "text string, tree string, pos int, leaf string")
    return make


def rows(n, langs, seed=1):
    r = random.Random(seed)
    out = [(i * 3 - 50, r.choice(["a", None, "çé", ""]), r.choice(langs), r.choice([None, 0, 5, 2**63 - 1, -1]),
            r.choice([None, "", "tëxt\n", "5:x", "x" * 70_000])) for i in range(n)]
    r.shuffle(out)
    return out


@pytest.mark.parametrize("n,langs,height", [
    (1, ["en"], 2), (2, ["en"], 2), (3, [None], 1), (5, ["en"], 1), (9, ["en", None, ""], 1), (33, ["en", "de", "é", "z"], 2),
    (70, ["en"] * 40 + ["b", "a", None], 2), (200, ["en", "de"], 3), (40, [f"l{i}" for i in range(40)], 2)])
def test_equals_brute_force(rows_of, n, langs, height):
    r = rows(n, langs)
    assert got(rows_of(r), height) == brute(r)


def test_null_and_repeated_ids_and_repeated_rows(rows_of):
    r = [(None, "a", "en", 1, "t"), (None, "a", "en", 1, "u"), (7, "a", "en", 1, "t"), (7, "a", "en", 1, "t"), (7, "b", "en", 1, "t"),
         (None, None, None, None, None)] + rows(12, ["en", None])
    assert got(rows_of(r), 2) == brute(r)
    assert got(rows_of(r), merkle.HEIGHT) == brute(r)


def test_empty_table(rows_of):
    assert got(rows_of([]), 2) == []


def test_places_are_a_permutation_and_subtrees_lie_together():
    for levels in range(1, 13):
        seen = np.concatenate([merkle.address(levels, d, np.arange(1 << d)) for d in range(levels)])
        assert sorted(seen.tolist()) == list(range((1 << levels) - 1))
    # half of the height goes first; a lower subtree is one run of places, laid out like any tree of its height
    for levels in (4, 7, 8, 11):
        top = levels // 2
        low = levels - top
        assert sorted(np.concatenate([merkle.address(levels, d, np.arange(1 << d)) for d in range(top)])) == list(range((1 << top) - 1))
        for tree in range(1 << top):
            first = (1 << top) - 1 + tree * ((1 << low) - 1)
            for d in range(low):
                inside = np.arange(1 << d)
                assert (merkle.address(levels, top + d, (tree << d) + inside) == first + merkle.address(low, d, inside)).all()


def test_layout_and_siblings_of_a_block():
    row = [sha(str(i)) for i in range(11)]
    nodes, root = merkle.lay_out(row, 4)
    by_level = levels_of(row)
    assert root == by_level[-1][0]
    for (i, steps), own in zip(merkle.siblings(nodes, 4, 11), row):
        assert steps == up(by_level, i) and merkle.fold(own, steps) == root
    # a block of a taller tree: its last node stays alone up to the block's root
    nodes, root = merkle.lay_out(row[:1], 3)
    assert root == sha(sha(sha(row[0]))) and list(merkle.siblings(nodes, 3, 1)) == [(0, ["-", "-", "-"])]


def test_numbered_rows_are_no_file_a_range(spark, tmp_path, monkeypatch):
    conf = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    monkeypatch.setattr("stratum.llm.common.scratch_path", lambda _, name: f"{tmp_path}/{name}")
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = spark.createDataFrame(rows(500, ["en"]), "doc_id long, source string, lang string, n_chars long, text string")
        merkle.manifest(merkle.leaves(df.coalesce(1), FIELDS), 10)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert 1 <= len(list(tmp_path.rglob("part-*.parquet"))) < 20
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept
