import re

import pytest
from pyspark.sql import functions as F

from stratum.llm import url_filter
from stratum.llm.queries import URL_RULES
from stratum.llm.url_filter import REJECT, VOCABULARY, Rule, Term

URLS = [
    None, "", "no scheme/adult", "http://", "http://?q=porn", "HTTPS://WWW.Casino.COM/Fr/x?y#z", "https://a.example.org/es/1",
    "https://example.org/es/", "https://example.org/es", "https://badexample.org/es/1", "http://example.org/en/12",
    "http://x.example.org/en/2", "http://org/x", "http://org", "http://org?x/", "http://a.com/de/1", "http://a.com/fr/casino",
    "http://a.net/free-free", "http://a.net/free-bets", "http://a.net/freebets", "http://a.net/alphabets/free",
    "http://a.net/adulthood", "http://a.net/éadultü", "http://porn.net://org/", "http://a.net/FREE_WIN", "İ://a.net/free/win",
    "http://a.net/x#free?win", "http://a.net/\nfree\nwin", "http://a.net/" + "x-" * 100_000 + "porn", "http://a.org:80/",
    "http://a.net/bets-poker", "http://a.net/free-bets", "://casino", "a://b://c/d"]


def brute(url):
    url = url or ""
    at = url.find("://")
    rest = url[at + 3:] if at >= 0 else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    low = url.translate({ord(a): a.lower() for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    host = host.translate({ord(a): a.lower() for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    fits = [r for r in URL_RULES if ("." + host).endswith("." + r.host) and path.startswith(r.path)]
    rule = max(fits, key=lambda r: len(r.host + r.path), default=None)
    hits = sorted((m.start(), m.end(), t.text, t.weight) for t in VOCABULARY
                  for m in re.finditer(rf"(?<![a-z0-9A-Z]){re.escape(t.text)}(?![a-z0-9A-Z])", low))
    weight = sum({t: w for *_, t, w in hits}.values())
    verdict = rule.verdict if rule else "block" if weight >= REJECT else "allow"
    return (host, path, rule and rule.host + rule.path, [(t, w, s, e) for s, e, t, w in hits],
            sum(w >= REJECT for *_, w in hits), len({t for *_, t, w in hits if w < REJECT}), weight, verdict)


@pytest.fixture(scope="module")
def pages_of(spark):
    def make(rows):
        return spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    return make


def test_equals_brute_force(pages_of):
    rows = [(i, u, "h", "v") for i, u in enumerate(URLS)]
    got = url_filter.judge(pages_of(rows), URL_RULES)
    assert got.columns == ["page_id", "url", "host", "verdict", "judged"]
    found = {r.page_id: r.judged for r in got.collect()}
    for i, u in enumerate(URLS):
        j = found[i]
        assert (j.host, j.path, j.rule, [tuple(h) for h in j.hits], j.n_strict, j.n_soft, j.weight, j.verdict) == brute(u), u


def test_cases_by_hand(pages_of):
    want = {"http://a.net/free-free": "allow", "http://a.net/free-bets": "block", "http://a.net/freebets": "allow",
            "http://a.net/casino": "block", "http://a.org/casino": "allow", "http://x.example.org/en/1": "block",
            "http://a.com/fr/porn": "allow", "http://a.com/de/": "block", None: "allow"}
    got = url_filter.judge(pages_of([(i, u, "", "") for i, u in enumerate(want)]), URL_RULES)
    assert [r.v for r in got.orderBy("page_id").select(F.col("judged.verdict").alias("v")).collect()] == list(want.values())


def test_repeated_rows_null_ids_and_empty_table(pages_of):
    rows = [(None, "http://a.net/porn", None, None)] * 2 + [(1, "http://a.net/", None, None)] * 3
    assert url_filter.judge(pages_of(rows), []).count() == 5
    kept = url_filter.allowed(pages_of(rows), [])
    assert kept.columns == ["page_id", "url", "host", "verdict"] and kept.count() == 3
    assert url_filter.judge(pages_of([]), URL_RULES).count() == 0


def test_one_soft_term_never_rejects_and_strict_ones_do():
    assert all(t.weight < REJECT or t.strict for t in VOCABULARY)
    soft = sorted(t.weight for t in VOCABULARY if not t.strict)
    assert soft[0] + soft[1] >= REJECT > soft[-1]


def test_bad_parameters(pages_of):
    for words in ([Term("A", 2)], [Term("a", 2), Term("a", 3)], [Term("", 1)], [Term("a", 0)]):
        with pytest.raises(ValueError):
            url_filter.judge(pages_of([]), [], words)
    with pytest.raises(ValueError):
        url_filter.judge(pages_of([]), [Rule("a", "/", "maybe")])
    with pytest.raises(ValueError):
        url_filter.judge(pages_of([]), [Rule(f"a{i}", "/", "allow") for i in range(url_filter.MOST_RULES + 1)])


def test_no_vocabulary(pages_of):
    got = url_filter.judge(pages_of([(1, "http://a.net/porn", "", "")]), [], []).first().judged
    assert got.verdict == "allow" and got.hits == []
