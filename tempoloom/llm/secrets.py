"""Secret scans with multipart credential linking.

Base matches are reported wherever they stand. Weak candidates - strings that
are too common to report alone - are reported only when a complementary part
stands in the same scope: an interval join pairs the interval of each weak
candidate, widened by ``scope`` code points, with the intervals of access
identifiers, secrets and endpoints of the same document.

Edge cases: a null text is empty and has no spans; ties in start are ordered by
kind as listed in KINDS; every row of a repeated document is scanned; other
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame

from .common import map_rows, text_of

#: Kinds in the order of ties. The first three are base kinds, the others come from linking.
KINDS = ("assign", "access", "hex", "secret", "short", "endpoint")
#: Code points to either side in which a complementary part makes a weak candidate reportable.
SCOPE = 200

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
#: Weak candidates: a bare 40-character base64 word, a short assigned value, a host or URL.
SECRET = re.compile(r"(?<![A-Za-z0-9+/=])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])")
ENDPOINT = re.compile(r"(?:https?|s3|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s\"'<>]+|\b(?:host|endpoint|region|bucket)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9.:-]{3,}", re.ASCII)
_ENDPOINT_MARKS = ("://", "host", "endpoint", "region", "bucket")
#: What completes what: a weak kind and the kinds of which one has to stand near it.
COMPLEMENTS = {"secret": ("access", "endpoint"), "short": ("access", "endpoint"), "endpoint": ("access", "assign", "secret")}


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(start, kind, end) of the base matches, and of the assignments whose value is short.

    HEX and ACCESS take whole runs, so a bound inside the pattern equals
    dropping short matches afterwards; an assignment with a short value is
    consumed and dropped.
    """
    found, short = [], []
    for m in ASSIGN.finditer(text):
        (found if m.end(2) - m.start(2) >= 8 else short).append((m.start(), 0, m.end()))
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found, short


def _near(weak: np.ndarray, parts: np.ndarray, scope: int) -> np.ndarray:
    """For each interval of weak, whether one of parts overlaps it when widened by scope (an interval semi-join by two sorted sides)."""
    if not len(weak) or not len(parts):
        return np.zeros(len(weak), dtype=bool)
    starts, ends = np.sort(parts[:, 0]), np.sort(parts[:, 1])
    begun = np.searchsorted(starts, weak[:, 1] + scope, side="right")
    over = np.searchsorted(ends, weak[:, 0] - scope, side="left")
    return begun > over


def scan(text: str, scope: int = SCOPE) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The base spans and the linked spans of a text, each (start, kind, end) and sorted."""
    found, short = base_spans(text)
    weak = {"short": [(s, e) for s, _, e in short]}
    covered = sorted((s, e) for s, _, e in found)
    at = [s for s, _ in covered]
    reach = np.maximum.accumulate([e for _, e in covered]) if covered else np.empty(0)

    def free(s: int, e: int) -> bool:
        i = np.searchsorted(at, e, side="left")
        return not i or reach[i - 1] <= s

    weak["endpoint"] = [m.span() for m in ENDPOINT.finditer(text) if free(*m.span())] if any(x in text for x in _ENDPOINT_MARKS) else []
    weak["secret"] = [m.span() for m in SECRET.finditer(text) if free(*m.span()) and not m[0].isalpha()] if weak["endpoint"] or any(k == 1 for _, k, _ in found) else []  # else nothing could complete it
    parts = {"assign": [(s, e) for s, k, e in found if k == 0], "access": [(s, e) for s, k, e in found if k == 1], **weak}
    linked = []
    for kind, others in COMPLEMENTS.items():
        own = np.array(weak[kind], dtype=np.int64).reshape(-1, 2)
        if len(own):
            other = np.array([x for o in others for x in parts[o]], dtype=np.int64).reshape(-1, 2)
            linked += [(int(s), KINDS.index(kind), int(e)) for s, e in own[_near(own, other, scope)]]
    return sorted(found), sorted(linked)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def secret_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """(key, base, spans) per document: the base spans and all spans as arrays of (kind, start, end), by start, then kind."""
    rows = text_of(docs, key, text=text)
    kind = rows.schema[key].dataType.simpleString()

    def each(rows):
        for k, t in rows:
            base, linked = scan(t, scope)
            yield k, [{"kind": KINDS[x], "start": s, "end": e} for s, x, e in base], [{"kind": KINDS[x], "start": s, "end": e} for s, x, e in sorted(base + linked)]

    span = "array<struct<kind: string, start: long, end: long>>"
    return map_rows(rows, each, f"{key} {kind}, base {span}, spans {span}")


def base_digest(base: str) -> str:
    return hashlib.sha256(base.encode()).hexdigest()
