"""Personal data in texts: patterns propose spans, checksums confirm them, context words adjust the score.

Every whole text is read once, in Arrow batches; each pattern runs in time linear
in the text, also over very long runs of digits or letters.

Defined results: a NULL or empty text has no span; repeated rows give repeated
results; only the id and text columns are read, so other columns of any name
do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from stratum.llm.common import text_slices

# The base kinds in their listed order, and their patterns.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")
LOCAL_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
# How many characters an IBAN has in each country of the ISO 13616 registry.
IBAN_SIZES = {
    c: n for n, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for c in countries.split()}
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
# Words that raise a span's score, and the scores themselves.
CONTEXT = {
    "email": ("email", "e-mail", "mail", "contact"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "mastercard", "credit", "payment"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "bank", "account", "konto", "cuenta", "compte"),
    "ssn": ("ssn", "social", "security"),
}
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.3}
CONTEXT_BONUS = 0.3
CONTEXT_CHARS = 40
#: Spans of the added kinds count from this score on; base spans always do.
MIN_SCORE = 0.5

_WORD = re.compile(r"[A-Za-z][A-Za-z-]*")
_DIGIT = re.compile(r"[0-9]")

SPANS_SCHEMA = "spans array<struct<kind:string,start:int,end:int,score:double>>"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 13616: the number with its first four characters moved to the end leaves 1."""
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # anchored on each "@", so a long run of letters without one costs nothing
    done, at = 0, text.find("@")
    low = 0
    while at >= 0:
        low = max(low, done)
        head = text[low:at]
        local = len(head) - len(head.rstrip(LOCAL_CHARS))
        low = at + 1
        if local and (m := DOMAIN.match(text, at + 1)):
            yield at - local, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in DOTTED.finditer(text):
        run = m.group()
        if run.count(".") < 3:
            continue
        parts, at = run.split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in four)):
                yield at, end
            at = end + 1


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 9 <= sum(map(str.isdigit, m.group())) <= 15:
            yield m.span()


def _iban_size(run: str) -> int:
    """How much of a run of groups is an IBAN from its start on: as long as its country's are, else (a country that
    the registry lacks) the longest that the checksum confirms; 0 for none."""
    end, known = len(run), IBAN_SIZES.get(run[:2])
    while end > 0:
        number = run[:end].replace(" ", "")
        if (len(number) == known if known else len(number) >= 15) and mod97(number):
            return end
        end = run.rfind(" ", 0, end)
    return 0


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    # the pattern takes words after the number too, and may begin before it
    at = 0
    while m := IBAN.search(text, at):
        size = _iban_size(m.group())
        if size:
            yield m.start(), m.start() + size
        at = m.start() + (size or 1)


def find_spans(text: str) -> list[tuple[str, int, int, float]]:
    """All spans of a text as (kind, start, end, score), by start, then kind as listed."""
    found: list[tuple[int, int, int]] = []
    if "@" in text:
        found += [(s, 0, e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        found += [(s, 1, e) for s, e in _ips(text)]
        found += [(s, 2, e) for s, e in _cards(text)]
        if "+" in text:
            found += [(s, 3, e) for s, e in _phones(text)]
        found += [(s, 4, e) for s, e in _ibans(text)]
        found += [(m.start(), 5, m.end()) for m in SSN.finditer(text)]
    out = []
    for start, kind, end in sorted(found):
        name = KINDS[kind]
        near = text[max(0, start - CONTEXT_CHARS):start] + " " + text[end:end + CONTEXT_CHARS]
        words = {w.lower() for w in _WORD.findall(near)}
        score = min(1.0, SCORES[name] + CONTEXT_BONUS * any(w in words for w in CONTEXT[name]))
        if name in BASE_KINDS or score >= MIN_SCORE:
            out.append((name, start, end, round(score, 3)))
    return out


def detect(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): every span with its kind, code-point offsets (end exclusive) and score."""
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                   ("score", pa.float64())]))
        for part, texts in text_slices(batches):
            spans = [[{"kind": k, "start": s, "end": e, "score": p} for k, s, e, p in find_spans(t)] for t in texts]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, kind)], names=[id_col, "spans"])

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, {SPANS_SCHEMA}")


def digest(spans: Iterable[str]) -> str:
    return hashlib.sha256(",".join(spans).encode()).hexdigest()
