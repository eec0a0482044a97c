"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds the anchors: at-signs, digits, schemes
and identifier cues. From each anchor a small parser expands to both sides, as
far as the characters of its kind reach, and validates what it finds:

* ``email``, ``ip``, ``card``, ``phone``: the base kinds, each found leftmost and
  non-overlapping; a match that fails its check (octets, Luhn, digits) is dropped.
* ``address``: ``scheme://user@host`` and ``scheme://user:password@host``, the
  personal part of a URL's authority, up to the host's end.
* ``account``: an identifier behind a cue: an IBAN with valid check digits, or at
  least six letters and digits with four digits or more among them.
* ``secret``: a value assigned to a cue such as token, secret or api key: at least
  16 characters of a key, among them a digit, a letter and eight different ones.

Spans are code points, the end exclusive, ordered by start and then by kind as
listed. Null counts as empty and has no spans. Whole texts of any length are
read, in time that grows with their length: a run of digits is entered at its
start only, and blanks behind a cue are passed once. Repeated rows are judged one
by one, an id may be null, an empty table gives no rows, and columns other than
``doc_id`` and ``text`` are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from feedwright.llm.common import ASCII_LOWER, doc_columns, slices, texts

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "address", "account", "secret")

# The anchors by the parser that expands them.
ANCHORS = {
    "at": ("@",),
    "digit": tuple("0123456789"),
    "scheme": ("://",),
    "cue": ("iban", "account", "acct", "konto", "cuenta", "compte", "passport", "ssn", "user id", "userid"),
    "key": (
        "token", "secret", "password", "passwd", "api key", "api_key", "api-key", "apikey", "access key", "access_key",
        "accesskey", "private key", "private_key", "credential", "bearer",
    ),
}

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
NUMERIC = re.compile(r"[0-9+ ().-]+")
NUMERIC_CHARS = frozenset("0123456789+ ().-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match begins where a run of digits begins, so a run that fails is not tried again from its middle.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*\Z")
AUTHORITY = re.compile(r"[A-Za-z0-9._~%!$&'()*+,;=-]+(?::[^\s/@?#]*)?@[A-Za-z0-9.-]+")
IDENTIFIER = re.compile(
    r"[ \t]*+(?:(?:number|no\.?|nr\.?|id|name)[ \t]*+)?[:=#]?[ \t]*+([A-Za-z0-9][A-Za-z0-9 -]{4,40}[A-Za-z0-9])"
)
#: What stands between a cue and its value: the rest of a name, a quote, a sign of assignment, a quote again.
SECRET = re.compile(r"s?(?:[_-][A-Za-z_-]{1,20})?[\"'`]?[ \t]*+(?::=|=>|[:=]|(?<=[Bb]earer )|(?<=BEARER ))[ \t]*+[\"'`]?([A-Za-z0-9_+/=.~-]{16,})")

_MACHINE: list = []


def machine() -> ahocorasick.Automaton:
    """The automaton over all anchors; made once per process."""
    if not _MACHINE:
        found = ahocorasick.Automaton()
        for parser, words in ANCHORS.items():
            for word in words:
                found.add_word(word, (parser, len(word)))
        found.make_automaton()
        _MACHINE.append(found)
    return _MACHINE[0]


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def small_octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def iban(code: str) -> bool:
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", code):
        return False
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def email_at(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The email around the at-sign, its local part not before ``floor``."""
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    domain = DOMAIN.match(text, at + 1) if start < at else None
    return (start, domain.end()) if domain else None


def numbers(text: str, start: int, end: int) -> Iterator[tuple[int, int, str]]:
    """IPs, cards and phones inside one run of numeric characters."""
    for m in IP.finditer(text, start, end):
        if all(small_octet(p) for p in m[0].split(".")):
            yield m.start(), m.end(), "ip"
    for m in CARD.finditer(text, start, end):
        number = digits(m[0])
        if 12 <= len(number) <= 19 and luhn(number):
            yield m.start(), m.end(), "card"
    if "+" in text[start:end]:
        for m in PHONE.finditer(text, start, end):
            if 9 <= len(digits(m[0])) <= 15:
                yield m.start(), m.end(), "phone"


def address_at(text: str, colon: int) -> tuple[int, int] | None:
    before = SCHEME.search(text, max(0, colon - 20), colon)
    own = AUTHORITY.match(text, colon + 3) if before else None
    return (before.start(), own.end()) if own else None


def account_after(text: str, cue_start: int, cue_end: int) -> tuple[int, int] | None:
    if cue_start and text[cue_start - 1].isalnum():
        return None
    m = IDENTIFIER.match(text, cue_end)
    if not m:
        return None
    code = m[1].upper()
    head = "".join(c for c in code if c.isalnum())[:4]
    for n in range(len(code), 14, -1) if re.match("[A-Z]{2}[0-9]{2}", head) else ():
        if code[n - 1].isalnum() and iban("".join(c for c in code[:n] if c.isalnum())):
            return m.start(1), m.start(1) + n
    first = re.match(r"[A-Za-z0-9-]+", m[1])[0].rstrip("-")
    if len(first.replace("-", "")) >= 6 and len(digits(first)) >= 4:
        return m.start(1), m.start(1) + len(first)
    return None


def secret_after(text: str, cue_start: int, cue_end: int) -> tuple[int, int] | None:
    if cue_start and text[cue_start - 1].isalnum():
        return None
    m = SECRET.match(text, cue_end)
    if not m:
        return None
    value = m[1].rstrip(".")
    mixed = any("0" <= c <= "9" for c in value) and any(c.isalpha() for c in value)
    return (m.start(1), m.start(1) + len(value)) if mixed and len(value) >= 16 and len(set(value)) >= 8 else None


def find_spans(text: str) -> list[tuple[int, int, str]]:
    """All spans of a text as (start, end, kind)."""
    low = text.lower() if text.isascii() else text.encode().translate(ASCII_LOWER).decode()
    spans: set[tuple[int, int, str]] = set()
    numeric_end = email_end = 0
    for last, (parser, length) in machine().iter(low):
        if parser == "digit":
            if last < numeric_end:
                continue
            start = last
            while start > numeric_end and text[start - 1] in NUMERIC_CHARS:
                start -= 1
            run = NUMERIC.match(text, start)
            numeric_end = run.end()
            spans.update(numbers(text, start, numeric_end))
        elif parser == "at":
            found = email_at(text, last, email_end)
            if found:
                email_end = found[1]
                spans.add((*found, "email"))
        elif parser == "scheme":
            found = address_at(text, last - 2)
            if found:
                spans.add((*found, "address"))
        else:
            expand, kind = (account_after, "account") if parser == "cue" else (secret_after, "secret")
            found = expand(text, last + 1 - length, last + 1)
            if found:
                spans.add((*found, kind))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def as_text(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


SPANS = T.ArrayType(
    T.StructType(
        [T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("kind", T.StringType())]
    )
)


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, the spans (start, end, kind) and the masked text of each row.

    A masked span reads ``[KIND]``; where spans overlap, the union is masked
    under the first one's kind.
    """
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("spans", SPANS), T.StructField("masked", T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
        for whole in batches:
            for b in slices(whole):
                own = texts(b)
                found = [find_spans(t) for t in own]
                rows = [[{"start": s, "end": e, "kind": k} for s, e, k in f] for f in found]
                hidden = [mask(t, f) for t, f in zip(own, found)]
                columns = [b.column("doc_id"), pa.array(rows, kind), pa.array(hidden, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "spans", "masked"])

    return doc_columns(docs).mapInArrow(run, schema)


def mask(text: str, spans: list[tuple[int, int, str]]) -> str:
    out, done = [], 0
    for start, end, kind in spans:
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join(out) + text[done:] if out else text


def report(docs: DataFrame) -> DataFrame:
    """Counts by kind, a digest of the base kinds' spans, and all spans as text."""
    counts = ", ".join(f"n_{kind} bigint" for kind in KINDS)
    schema = f"doc_id bigint, {counts}, base_sha256 string, spans string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole):
                found = [find_spans(t) for t in texts(b)]
                base = [[s for s in f if s[2] in BASE_KINDS] for f in found]
                columns: dict[str, object] = {"doc_id": b.column("doc_id")}
                for kind in KINDS:
                    columns[f"n_{kind}"] = pa.array([sum(s[2] == kind for s in f) for f in found], pa.int64())
                shas = [hashlib.sha256(as_text(f).encode()).hexdigest() for f in base]
                columns |= {"base_sha256": pa.array(shas, pa.string())}
                columns |= {"spans": pa.array([as_text(f) for f in found], pa.string())}
                yield pa.RecordBatch.from_pydict(columns)

    return doc_columns(docs).mapInArrow(run, schema)
