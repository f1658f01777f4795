import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from stratum.llm import exact_dedup

ROWS = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "b"), (5, "b"), (6, "x" * 200_000), (7, "x" * 200_000),
        (8, "x" * 199_999 + "y"), (None, "z"), (None, "z"), (9, "A"), (10, "a ")]


def brute(rows, pick=max):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = pick(ids) if ids else None
        out.append((i, keep, len(groups[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_groups(docs_of):
    assert got(exact_dedup.exact_groups(docs_of(ROWS))) == brute(ROWS)
    assert got(exact_dedup.exact_groups(docs_of(ROWS), keep="min")) == brute(ROWS, min)


def test_colliding_hashes_are_told_apart_by_bytes(docs_of):
    weak = exact_dedup.exact_groups(docs_of(ROWS), hash_of=lambda t: F.substring(F.md5(t), 1, 1))
    assert got(weak) == brute(ROWS)
    assert got(exact_dedup.exact_groups(docs_of(ROWS), hash_of=lambda t: F.lit(0))) == brute(ROWS)


def test_empty_table(docs_of):
    assert got(exact_dedup.exact_groups(docs_of([]))) == []
    assert exact_dedup.without_copies(docs_of([])).count() == 0


def test_rows_that_stay(docs_of):
    stay = exact_dedup.without_copies(docs_of(ROWS))
    assert stay.columns == ["doc_id", "text", "kept", "n_tokens"]
    ids = sorted((r.doc_id for r in stay.collect()), key=str)
    assert ids == sorted([2, 4, 5, 7, 8, None, 9, 10], key=str)


def test_no_python_in_plan(docs_of):
    plan = exact_dedup.exact_groups(docs_of(ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
