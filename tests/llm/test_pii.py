import hashlib
import random
import re

from stratum.llm import pii
from stratum.llm.queries import op10_pii
from conftest import SF_SMALL

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, s):
    digits = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        total = sum(int(c) if i % 2 == 0 else sum(map(int, str(int(c) * 2))) for i, c in enumerate(digits[::-1]))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    found = [(m.start(), k, kind, m.end()) for k, (kind, p) in enumerate(PATTERNS.items())
             for m in re.finditer(p, text) if holds(kind, m.group())]
    return [(kind, s, e) for s, _, kind, e in sorted(found)]


def base(text):
    return [x[:3] for x in pii.find_spans(text) if x[0] in pii.BASE_KINDS]


def test_random_texts_equal_plain_patterns():
    rnd = random.Random(3)
    pieces = ["a", "@", ".", "-", "1", "25", "255", "256", "+", " ", "(", "4111", "b.c", "0", "é", "%", "4111 1111 1111 1111"]
    for _ in range(20000):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 24)))
        assert base(text) == brute(text), text


def test_added_spans_and_scores():
    text = "My IBAN is GB82 WEST 1234 5698 7654 32, mail bob@x.org; ssn 123-45-6789."
    spans = pii.find_spans(text)
    assert [s[0] for s in spans if s[0] != "card"] == ["iban", "email", "ssn"]
    assert all(0 <= s[3] <= 1 for s in spans)
    assert not [s for s in pii.find_spans("part 123-45-6789 of GB82 WEST 1234 5698 7654 33") if s[0] in ("ssn", "iban")]


def ibans(text):
    return [text[s:e] for kind, s, e, _ in pii.find_spans(text) if kind == "iban"]


def test_iban_before_words_and_numbers():
    # examples of the registry, one or two per length
    for iban in ("NO9386011117947", "BE68539007547034", "NL91ABNA0417164300", "MK07250120000058984", "AT611904300234573201",
                 "CH9300762011623852957", "DE89370400440532013000", "GB82WEST12345698765432", "AE070331234567890123456",
                 "ES9121000418450200051332", "PT50000201231234567890154", "IS140159260076545510730339",
                 "FR1420041010050500013M02606", "PL61109010140000071219812874", "BR1800360305000010009795493C1",
                 "KW81CBKU0000000000001234560101", "MT84MALT011000012345MTLCAST001S", "LC55HEMM000100010012001200023015"):
        grouped = " ".join(iban[i:i + 4] for i in range(0, len(iban), 4))
        for written in (iban, grouped):
            for after in ("", " BIC COBADEFF", " EUR 100", " 100", " 2024 0001", " A", " IBAN BIC SWIFT", " and", ", so", " " + iban):
                for before in ("", "IBAN ", "REF 1 ", "DE12 CODE 12345678 "):
                    found = ibans(before + written + after)
                    assert found[0] == written and len(found) == 1 + (after == " " + iban), (before, written, after)
    assert ibans("DE89370400440532013001 BIC COBADEFF") == ibans("DE89370400440532013000EUR 100") == []
    assert ibans("GB82 WEST 1234 5698 7654 3 2") == ["GB82 WEST 1234 5698 7654 3 2"]


def test_iban_of_an_unlisted_country_is_the_longest_that_holds():
    rest = "1234567890123456"
    check = next(f"{n:02}" for n in range(2, 99) if pii.mod97(f"ZZ{n:02}{rest}"))
    assert ibans(f"bank ZZ{check} {rest} EUR") == [f"ZZ{check} {rest}"]


def test_linear_on_long_runs():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1 " * 100_000, "@" * 300_000, "a@b" * 100_000):
        pii.find_spans(text)


def test_address_parts_of_many_zeros():
    for text, end in (("1.2.3." + "0" * 5000, 5006), ("0" * 5000 + "255.2.3.4", 5009), ("1.2.3." + "0" * 5000 + "256", None)):
        assert [x[1:3] for x in pii.find_spans(text) if x[0] == "ip"] == ([(0, end)] if end else [])


def test_frame(docs_of):
    rows = [(1, None), (2, ""), (3, "call +1 (212) 555-0199 or bob@x.org"), (3, "call +1 (212) 555-0199 or bob@x.org"),
            (None, "10.0.0.1")]
    got = {r.doc_id: [s.kind for s in r.spans] for r in pii.detect(docs_of(rows)).collect()}
    assert got == {1: [], 2: [], 3: ["phone", "email"], None: ["ip"]}
    assert pii.detect(docs_of([])).count() == 0


def test_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    n = 0
    for r in op10_pii(spark, SF_SMALL).collect():
        want = brute(texts[r.doc_id])
        n += len(want)
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[0] == k for x in want) for k in pii.BASE_KINDS]
    assert n
