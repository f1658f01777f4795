import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stratum.llm import warc

SCHEMA = f"record_id long, type string, url string, date timestamp, status int, headers {warc.HEADERS}, payload string"


@pytest.fixture(scope="module")
def records_of(spark):
    def make(rows):
        return spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA + ", canonical string")
    return make


def at(hours):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours)


def brute(rows):
    full = [r for r in rows if r[1] == "response" and r[4] != 304 and r[2] and r[3] and r[0] is not None]
    out = []
    for i, kind, url, date, _, headers, _ in rows:
        if kind != "revisit":
            continue
        before = [r for r in full if url and date and r[2] == url and r[3] < date]
        if not before:
            out.append((i, None, "no-base", None))
            continue
        base = max(before, key=lambda r: (r[3], r[0]))
        mine, theirs = ({n.lower(): v for n, v in reversed(h or [])} for h in (headers, base[5]))
        strip = lambda v: v.removeprefix("W/") if v is not None else None
        good = True
        if "etag" in mine:
            good = strip(mine["etag"]) == strip(theirs.get("etag"))
        elif "last-modified" in mine:
            good = mine["last-modified"] == theirs.get("last-modified")
        out.append((i, base[0], "resolved" if good else "validator-mismatch", base[6] if good else None))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.record_id, r.base_id, r.outcome, r.payload) for r in df.collect()), key=str)


def test_as_of_join_equals_brute_force(records_of):
    rnd = random.Random(1)
    tags = ['"a"', 'W/"a"', '"b"', None]
    rows = []
    for i in range(600):
        kind = rnd.choice(["response", "revisit"])
        url = "hot.org/x" if rnd.random() < 0.4 else f"h{rnd.randint(0, 20)}.org/"
        url = url.rstrip("/") if rnd.random() < 0.95 else None
        headers = [("ETag", t) for t in [rnd.choice(tags)] if t] + [("Last-Modified", rnd.choice("xy"))] * rnd.randint(0, 1)
        date = at(rnd.randint(0, 400) / 8) if rnd.random() < 0.95 else None
        rows.append((i, kind, url, date, 304 if kind == "revisit" else rnd.choice([200, 200, 404, 304]),
                     headers or None, f"payload {i}" if kind == "response" else None))
    rows += [rows[k] for k in range(600) if rows[k][1] == "revisit"][:5]
    assert got(warc.resolve_revisits(records_of(rows))) == brute(rows)


def test_headers_are_merged(records_of):
    base = [("Content-Type", "text/html"), ("ETag", '"a"'), ("Date", "1"), ("Content-Length", "9"), ("X", "kept")]
    new = [("etag", 'W/"a"'), ("DATE", "2"), ("Content-Length", "0"), ("Expires", "later"), ("X", "dropped")]
    rows = [(1, "response", "a.org", at(0), 200, base, "p"), (2, "revisit", "http://www.A.org/#top", at(1), 304, new, None)]
    r, = warc.resolve_revisits(records_of(rows)).collect()
    assert (r.canonical, r.status, r.payload) == ("a.org", 200, "p")
    assert [tuple(h) for h in r.headers] == [("Content-Type", "text/html"), ("Content-Length", "9"), ("X", "kept"),
                                             ("etag", 'W/"a"'), ("DATE", "2"), ("Expires", "later")]


def test_empty_and_null(records_of):
    assert warc.resolve_revisits(records_of([])).count() == 0
    rows = [(None, "response", "a.org", at(0), 200, None, "p"), (1, "revisit", "a.org", at(1), None, None, None),
            (2, None, None, None, None, None, None), (None, "revisit", None, None, None, None, None)]
    assert got(warc.resolve_revisits(records_of(rows))) == brute(rows)


def test_canonical_urls(spark):
    same = ["http://Example.org/a/?b=2&a=1", "https://www.example.org:443/a?a=1&utm_source=x&b=2#f", "example.org/a?ref=1&b=2&a=1"]
    other = ["http://example.org/A?a=1&b=2", "http://example.org:8080/a?a=1&b=2", "http://m.example.org/a?a=1&b=2"]
    df = spark.createDataFrame([(u,) for u in [*same, *other, None, "", "?x=1", "http://e.org?referrer=1"]], "u string")
    out = [r[0] for r in df.select(warc.canonical_url(F.col("u"))).collect()]
    assert set(out[:3]) == {"example.org/a?a=1&b=2"} and len(set(out[3:6])) == 3 and out[0] not in out[3:6]
    assert out[6:] == [None, "", "?x=1", "e.org?referrer=1"]


def test_records_round_trip(records_of):
    rows = [(1, "response", "http://a.org/?x=1", at(0), 200, [("A", "1"), ("B", "x: y"), ("A", "2")], "body\r\n\r\nmore\r\n"),
            (2, "response", "http://a.org", at(5), 404, [], ""), (3, "revisit", "http://ü.org", at(7), 304, [("ETag", "q")], None),
            (4, "response", None, None, 200, [("Z", "")], "é" * 100_000)]
    back = warc.read_records(warc.write_records(records_of(rows))).collect()
    assert [(r.record_id, r.type, r.url, r.date, r.status, [tuple(h) for h in r.headers], r.payload)
            for r in sorted(back, key=lambda r: r.record_id)] == rows
    raw = warc.write_records(records_of(rows[:1])).first().record
    assert bytes(raw).startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and bytes(raw).endswith(b"more\r\n\r\n\r\n")


def test_broken_records_do_not_crash(spark):
    df = spark.createDataFrame([(1, b""), (2, None), (3, b"\xff\xfe\r\n\r\n\x80"), (4, b"WARC/1.1\r\nWARC-Date: no\r\n\r\nHTTP/1.1 x")],
                               "record_id long, record binary")
    assert [(r.type, r.url, r.date, r.status) for r in warc.read_records(df).collect()] == [(None,) * 4] * 4
