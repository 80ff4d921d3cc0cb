"""PII: format-preserving Feistel pseudonyms.

Each value found is checked (Luhn, ISO 7064, octets, calendar) and permuted by
a keyed Feistel network over the values of its own format: the digits of a
card but its check digit, which is set anew; the days of a century for a date;
the free digits of a telephone number; the letters and digits of a mail's local
part. A permutation keeps equal values equal, and different ones different,
across all documents, so links survive while the values do not. Numbers that
fail their check are left alone.

A value has one pseudonym however it is written: a date in any order of its
fields, padded or not; a telephone number with or without its country's code.
So that widths and the reading of a date stay, dates are permuted among those
whose month and day have as many digits and whose day is 12 or less, or more.

The key is a secret of whoever runs this: session_key() reads it from the
session's settings. Without one there a random key is made that lasts as long
as the session, so pseudonyms of different sessions don't link, and nobody can
invert them.

Edge cases: null texts stay null; an empty text stays empty; a value that
touches letters or further digits is none; of a run of digit groups the longest
readings that pass as cards count, and of an IBAN's groups the most that pass;
overlapping candidates are taken leftmost, then by the order of KINDS; equal rows are replaced alike; texts of
any length are searched whole; an empty table gives an empty table.
"""

from __future__ import annotations

import datetime
import hmac
import math
import re
import secrets
from collections.abc import Callable
from functools import cache, lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StructField, StructType

from .common import map_rows, text_of

#: The session's setting that holds the key.
SETTING = "spark.tempoloom.pseudonymKey"
ROUNDS = 8
_RANDOM: dict[str, bytes] = {}


def session_key(spark: SparkSession) -> bytes:
    """The key in SETTING, or else a random one, the same throughout the application."""
    given = spark.conf.get(SETTING, None)
    return given.encode() if given else _RANDOM.setdefault(spark.sparkContext.applicationId, secrets.token_bytes(32))


def permute(value: int, size: int, key: bytes, tweak: bytes) -> int:
    """A keyed permutation of 0..size-1: an unbalanced Feistel network on two digits of radix about sqrt(size), with cycle walking."""
    if size < 2:
        return 0
    a = max(2, math.isqrt(size - 1) + 1)
    while True:
        left, right = divmod(value, a)
        for i in range(ROUNDS):
            digest = hmac.digest(key, b"%b|%d|%d|%d" % (tweak, size, i, right), "sha256")
            left, right = right, (left + int.from_bytes(digest, "big")) % a
        value = left * a + right
        if value < size:
            return value


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _refill(pattern: str, digits: str) -> str:
    """pattern with its digits replaced, in order."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in pattern)


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _card(text: str, key: bytes) -> str | None:
    d = _digits(text)
    if not 13 <= len(d) <= 19 or not luhn(d) or len(set(d)) == 1:
        return None
    body = f"{permute(int(d[:-1]), 10 ** (len(d) - 1), key, b'card'):0{len(d) - 1}d}"
    return _refill(text, body + next(c for c in "0123456789" if luhn(body + c)))


def _iban(text: str, key: bytes) -> str | None:
    s = text.replace(" ", "").upper()
    value = lambda x: int("".join(str(int(c, 36)) for c in x))
    if value(s[4:] + s[:4]) % 97 != 1:
        return None
    new = _places(s[4:], key, b"iban" + s[:2].encode())
    whole = s[:2] + f"{98 - value(new + s[:2] + '00') % 97:02d}" + new
    it = iter(whole)
    return "".join(c if c == " " else next(it) for c in text)


def _ssn(text: str, key: bytes) -> str | None:
    area, group, serial = (int(x) for x in re.split("[- ]", text))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    areas = [a for a in range(1, 900) if a != 666]
    n = permute((areas.index(area) * 99 + group - 1) * 9999 + serial - 1, len(areas) * 99 * 9999, key, b"ssn")
    n, serial = divmod(n, 9999)
    area, group = divmod(n, 99)
    return f"{areas[area]:03d}{text[3]}{group + 1:02d}{text[6]}{serial + 1:04d}"


_CODE = re.compile(r"\+(\d{1,3})[ .(-]")


def _phone(text: str, key: bytes) -> str | None:
    d = _digits(text)
    if not 9 <= len(d) <= 15 or len(set(d)) == 1:
        return None
    # the country's code stays, and so does the zero before a national number, so that both ways to write it have one pseudonym
    code = _CODE.match(text)
    keep = len(code[1]) if code else len(d) - 10 if text[0] == "+" and len(d) > 10 else 1 if d[0] == "0" else 0
    body = d[keep:]
    return _refill(text, d[:keep] + f"{permute(int(body), 10 ** len(body), key, b'phone'):0{len(body)}d}")


def _ip(text: str, key: bytes) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    n = permute(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, key, b"ip")
    return ".".join(map(str, n.to_bytes(4, "big")))


_EPOCH = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2100, 1, 1).toordinal() - _EPOCH


def _date_class(d: datetime.date) -> tuple[bool, int]:
    """Dates of one class have fields of equal widths, and are read alike where a day of more than 12 tells days from months."""
    return d.month > 9, 0 if d.day < 10 else 1 if d.day < 13 else 2


@cache
def _dates() -> tuple[dict[tuple[bool, int], list[int]], list[int]]:
    """The days of each class in order, and the number of each day within its class."""
    classes: dict[tuple[bool, int], list[int]] = {}
    numbers = []
    for n in range(_DAYS):
        own = classes.setdefault(_date_class(datetime.date.fromordinal(_EPOCH + n)), [])
        numbers.append(len(own))
        own.append(n)
    return classes, numbers


def _date(text: str, key: bytes) -> str | None:
    parts = re.split(r"[-/.]", text)
    year_first = len(parts[0]) == 4
    year, a, b = (int(x) for x in (parts if year_first else (parts[2], parts[0], parts[1])))
    # year-month-day; else day first where dots or a first part over 12 say so, month first otherwise
    day_first = not year_first and ("." in text or a > 12)
    month, day = (b, a) if day_first else (a, b)
    try:
        own = datetime.date(year, month, day)
    except ValueError:
        return None
    if not 0 <= (n := own.toordinal() - _EPOCH) < _DAYS:
        return None
    classes, numbers = _dates()
    kind = _date_class(own)
    d = datetime.date.fromordinal(_EPOCH + classes[kind][permute(numbers[n], len(classes[kind]), key, b"date%d%d" % kind)])
    fields = (d.year, d.month, d.day) if year_first else (d.day, d.month, d.year) if day_first else (d.month, d.day, d.year)
    return _refill_date(text, tuple(f"{v:0{len(p)}d}" for v, p in zip(fields, parts, strict=True)))


def _refill_date(text: str, parts: tuple[str, ...]) -> str:
    it = iter(parts)
    return re.sub(r"\d+", lambda _: next(it), text)


#: Characters that the local part of a mail address may have.
LOCAL = 64


def _mail(text: str, key: bytes) -> str | None:
    local, _, domain = text.rpartition("@")
    if len(local) > LOCAL:
        return None
    return _places(local, key, b"mail" + domain.lower().encode()) + "@" + domain


def _places(text: str, key: bytes, tweak: bytes) -> str:
    """text with its ASCII letters and digits permuted as one number, each place in the radix of its class; other characters stay."""
    places = [(26, ord("a")) if "a" <= c <= "z" else (26, ord("A")) if "A" <= c <= "Z" else (10, ord("0")) if "0" <= c <= "9" else None for c in text]
    value, size = 0, 1
    for c, p in zip(text, places, strict=True):
        if p:
            value, size = value * p[0] + ord(c) - p[1], size * p[0]
    value = permute(value, size, key, tweak + b"|" + "".join("-" if not p else chr(p[1]) for p in places).encode())
    out = []
    for c, p in zip(reversed(text), reversed(places), strict=True):
        if p:
            value, r = divmod(value, p[0])
            c = chr(p[1] + r)
        out.append(c)
    return "".join(reversed(out))


#: Kind, what a candidate looks like, and how it is checked and replaced; of candidates at one place the first kind counts.
KINDS: tuple[tuple[str, str, Callable[[str, bytes], str | None]], ...] = (
    ("mail", r"[A-Za-z0-9._%+-]*[A-Za-z0-9]@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}", _mail),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", _iban),
    ("date", r"(?<![\d./-])(?:\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}-\d{1,2}-\d{4})(?![\d/-]|\.\d)", _date),
    ("ip", r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)", _ip),
    ("ssn", r"(?<![\d-])\d{3}([- ])\d{2}\1\d{4}(?![\d-])", _ssn),
    ("card", r"(?<![\w.])\d(?:[ -]?\d){12,}(?!\w|[.-]?\d)", _card),
    ("phone", r"(?<![\w+])(?<!\d[ .-])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{2,4})[ .-]\d{3,4}[ .-]\d{4}(?![\d-])(?![ .]\d)|(?<![\w+])\+\d{9,15}(?!\d)", _phone),
)
_PATTERNS = tuple((name, re.compile(p), fn) for name, p, fn in KINDS)
_GROUP = re.compile(r"\d+")
_ANY_DIGIT = re.compile(r"\d")


def _cards(text: str, pattern: re.Pattern, of: Callable[[str], str | None]):
    """(start, end, pseudonym) of the cards in runs of digit groups: the longest readings of whole groups that pass, then the leftmost."""
    for m in pattern.finditer(text):
        groups = [(g.start(), g.end()) for g in _GROUP.finditer(text, m.start(), m.end())]
        readings = []
        for i, (start, _) in enumerate(groups):
            digits = 0
            for a, b in groups[i:]:
                digits += b - a
                if digits > 19:
                    break
                if digits >= 13:
                    readings.append((-digits, start, b))
        taken: list[tuple[int, int]] = []
        for _, start, end in sorted(readings):
            if all(end <= a or b <= start for a, b in taken) and (new := of(text[start:end])) is not None:
                taken.append((start, end))
                yield start, end, new


def _ibans(text: str, pattern: re.Pattern, of: Callable[[str], str | None]):
    """(start, end, pseudonym) of the IBANs: at each candidate the most groups that pass; if none do, the next candidate may begin within."""
    at = 0
    while m := pattern.search(text, at):
        end = m.end()
        while end > m.start() and (not pattern.fullmatch(text, m.start(), end) or (new := of(text[m.start() : end])) is None):
            end = text.rfind(" ", m.start(), end)
        if end > m.start():
            yield m.start(), end, new
            at = end
        else:
            at = m.start() + 1


#: Kinds whose candidates have several readings.
_READ = {"card": _cards, "iban": _ibans}


class Pseudonyms:
    """Replaces the values of a text by pseudonyms under one key; the latest are kept at hand."""

    def __init__(self, key: bytes):
        self.of = lru_cache(1 << 16)(lambda n, value: _PATTERNS[n][2](value, key))

    def spans(self, text: str) -> list[tuple[int, int, str, str]]:
        """(start, end, kind, pseudonym) of the values in text, in order and without overlap."""
        digits, at = _ANY_DIGIT.search(text) is not None, "@" in text
        if not digits and not at:
            return []
        found = []
        for n, (name, pattern, _) in enumerate(_PATTERNS):
            if not (at if name == "mail" else digits):
                continue
            if name in _READ:
                found += [(start, n, end, new) for start, end, new in _READ[name](text, pattern, lambda value, n=n: self.of(n, value))]
                continue
            for m in pattern.finditer(text) if name != "mail" else _mails(text, pattern):
                if (new := self.of(n, m[0])) is not None:
                    found.append((m.start(), n, m.end(), new))
        out, seen = [], 0
        for start, n, end, new in sorted(found):
            if start >= seen:
                out.append((start, end, KINDS[n][0], new))
                seen = end
        return out

    def replaced(self, text: str) -> tuple[str, int]:
        """text with its values replaced, and how many they were."""
        out, seen = [], 0
        for start, end, _, new in self.spans(text):
            out += (text[seen:start], new)
            seen = end
        return ("".join(out) + text[seen:], len(out) // 2) if out else (text, 0)

    def __call__(self, text: str) -> str:
        return self.replaced(text)[0]


_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")


def _mails(text: str, pattern: re.Pattern):
    """Matches of the mail pattern, begun from each @ so that long texts cost no more than their length."""
    at, seen = text.find("@"), 0
    while at >= 0:
        start = at
        while start > seen and text[start - 1] in _LOCAL:
            start -= 1
        if m := pattern.match(text, start):
            yield m
            seen = m.end()
        else:
            seen = at + 1
        at = text.find("@", max(seen, at + 1))


def pii_spans(docs: DataFrame, secret: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, kind, start, end, value, pseudonym) of each value, in code points."""
    rows = text_of(docs, key, text=text)

    def each(rows_):
        own = Pseudonyms(secret)
        for k, t in rows_:
            for start, end, kind, new in own.spans(t):
                yield k, kind, start, end, t[start:end], new

    return map_rows(rows, each, f"{key} {rows.schema[key].dataType.simpleString()}, kind string, start long, end long, value string, pseudonym string")


def pseudonymised(docs: DataFrame, secret: bytes, text: str = "text", length: str = "n_chars", count: str | None = None) -> DataFrame:
    """docs with the values in their texts replaced, and length set anew where a text's length changed; count: a further column for the number of values replaced."""
    names, at = docs.columns, docs.columns.index(text)
    n_at = names.index(length) if length in names else None

    def apply(batches):
        own = Pseudonyms(secret)
        for whole in batches:
            for begin in range(0, whole.num_rows, 1000):
                b = whole.slice(begin, 1000)
                columns = list(b.columns)
                old = columns[at].to_pylist()
                done = [(None, 0) if t is None else own.replaced(t) for t in old]
                new = [t for t, _ in done]
                columns[at] = pa.array(new, type=pa.string())
                if n_at is not None:
                    n = columns[n_at].to_pylist()
                    columns[n_at] = pa.array([c if x is None or len(x) == len(y) else len(y) for c, x, y in zip(n, old, new, strict=True)], type=columns[n_at].type)
                if count:
                    columns.append(pa.array([n for _, n in done], type=pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, names=names + ([count] if count else []))

    return docs.mapInArrow(apply, StructType(docs.schema.fields + ([StructField(count, LongType())] if count else [])))
