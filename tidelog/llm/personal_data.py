"""Personal data: patterns propose spans, checksums confirm them, context words move the score, and the score decides.

Base kinds are found leftmost and without overlap within a kind: email, ip, card (Luhn) and phone. The method adds IBANs
(mod-97 over the country's length) and social security numbers. Every span carries a score from 0 to 1: a start value for
its kind, raised by a confirmed checksum and by words of its kind within CONTEXT characters, lowered by words just before
it that say that it is something else, such as a version. Spans that the method adds need a score of LEAST, which a social
security number has only with a word of its kind nearby; base spans are reported whatever their score, but only those of
LEAST are redacted.

Null and empty texts have no spans. Rows are independent, so repeated rows give repeated results and an empty table an
empty one; other columns, whatever their names, are ignored by scan() and digests() and stay in redacted(). Spans of
different kinds may overlap: all are reported, and a stretch is redacted as the kind of its first span, of spans that
start together the longest, then in the order of KINDS. Matching is linear in the text, long runs included, and very long
texts are worked on whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from ._text import column_of, slices, texts

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
CONTEXT = 60
WORDS = {
    "email": ("mail", "email", "contact", "write to", "courriel", "correo", "kontakt"),
    "ip": ("ip", "address", "host", "server", "login", "adresse", "servidor"),
    "card": ("card", "visa", "mastercard", "credit", "carte", "karte", "tarjeta", "payment"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "telefon", "teléfono", "téléphone"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social security", "social-security"),
}
#: Words that say, just before a number, that it is something else, and how far before it they are looked for.
AGAINST = {
    "ip": ("version", "release", "firmware", "build", "section"),
    "card": ("tracking", "serial", "isbn"),
    "phone": ("isbn", "serial"),
}
BEFORE = 16
#: The score that a span of the method's own kinds needs, and any span that is redacted.
LEAST = 0.5
START = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.5, "iban": 0.9, "ssn": 0.3}
_FAR = {k: re.compile(r"\b(?:" + "|".join(v) + r")\b", re.I) for k, v in AGAINST.items()}
_NEAR = {k: re.compile(r"\b(?:" + "|".join(map(re.escape, v)) + r")\b", re.I) for k, v in WORDS.items()}

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can only start where a run of digits starts; saying so spares long runs a try at each digit
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
#: Characters of an IBAN, and the countries that have so many.
_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR",
    27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD", 28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
IBAN_LENGTH = {country: n for n, some in _LENGTHS.items() for country in some.split()}
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_ANY = re.compile(r"[0-9@]")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    s = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _emails(text: str) -> list[tuple[int, int]]:
    """As the pattern finds them, but from each @ outwards, so that long runs without @ cost nothing."""
    out, past, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > past and text[start - 1] in _LOCAL:
            start -= 1
        hit = _DOMAIN.match(text, at + 1) if start < at else None
        if hit:
            out.append((start, hit.end()))
        # what an @ has bounded needn't be walked again
        past = hit.end() if hit else at + 1
        at = text.find("@", past)
    return out


def _ips(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:3] or 0) <= 255 for p in m[0].split("."))]


def _ibans(text: str) -> list[tuple[int, int]]:
    """Spans with the right checksum: of the country's length where a word of the match ends there, else the whole match.

    What follows a span, or the first word of a match without one, may begin another.
    """
    out, m = [], _IBAN.search(text)
    while m:
        n, words, own = IBAN_LENGTH.get(m[0][:2]), m[0].split(" "), None
        for k in range(1, len(words) + 1):
            if len("".join(words[:k])) == n:
                own = m.start() + len(" ".join(words[:k]))
        end = next((e for e in (own, m.end()) if e and mod97(text[m.start() : e])), None)
        if end:
            out.append((m.start(), end))
        m = _IBAN.search(text, end or m.start() + 1)
    return out


def find(text: str) -> list[Span]:
    """All spans of a text, by kind as listed in KINDS, then by start."""
    if not _ANY.search(text):
        return []
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    found["email"] = _emails(text)
    found["ip"] = _ips(text)
    found["card"] = [m.span() for m in _CARD.finditer(text) if 16 <= len(d := digits_of(m[0])) <= 19 and luhn(d)]
    found["phone"] = [m.span() for m in _PHONE.finditer(text) if 8 <= len(digits_of(m[0])) <= 15]
    found["iban"] = _ibans(text)
    found["ssn"] = [m.span() for m in _SSN.finditer(text)]
    out = []
    for kind in KINDS:
        for a, b in found[kind]:
            near = bool(_NEAR[kind].search(text[max(0, a - CONTEXT) : a]) or _NEAR[kind].search(text[b : b + CONTEXT]))
            far = kind in _FAR and bool(_FAR[kind].search(text[max(0, a - BEFORE) : a]))
            score = round(min(1.0, max(0.0, START[kind] + 0.2 * (kind in ("card", "iban")) + 0.3 * near - 0.5 * far)), 3)
            if kind in BASE or score >= LEAST:
                out.append(Span(kind, a, b, score))
    return out


def redact(text: str, spans: list[Span]) -> str:
    """The text with each stretch of spans replaced by the kind of its first span, in angle brackets."""
    out, past = [], 0
    for s in sorted(spans, key=lambda s: (s.start, -s.end)):
        if s.start >= past:
            out += [text[past : s.start], f"<{s.kind.upper()}>"]
        past = max(past, s.end)
    return "".join([*out, text[past:]])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and spans array<struct<kind, start, end, score>> (code points, end exclusive) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        for b in slices(batches):
            spans = [[s._asdict() for s in find(t)] for t in texts(column_of(b, "text")).to_pylist()]
            yield pa.RecordBatch.from_arrays([column_of(b, "doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,score:double>>")


def digests(docs: DataFrame) -> DataFrame:
    """Counts and digests of scan(): base kinds alone, all spans as kind:start:end, and their scores in the same order."""
    from pyspark.sql import functions as F

    s = scan(docs)
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE))
    text = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    of = lambda kind: F.filter("spans", lambda x: x["kind"] == kind)
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE]
    return s.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"), F.array_join(F.transform("spans", lambda x: F.format_number(x["score"], 2)), ",").alias("scores"))


def redacted(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """docs with spans of at least that score redacted in text; n_chars, where present, follows. Other columns stay."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            old = column_of(b, "text").to_pylist()
            new = [t if not t or not (s := [x for x in find(t) if x.score >= least]) else redact(t, s) for t in old]
            columns = [pa.array(new, b.schema.field(n).type) if n == "text" else b.column(i) for i, n in enumerate(b.schema.names)]
            if "n_chars" in names:
                i, was = names.index("n_chars"), column_of(b, "n_chars").to_pylist()
                columns[i] = pa.array([w if x == y else len(y) for w, x, y in zip(was, old, new, strict=True)], b.schema.field(i).type)
            yield pa.RecordBatch.from_arrays(columns, schema=b.schema)

    return docs.mapInArrow(run, docs.schema)
