"""Document fingerprints: Order MinHash, sensitive to edit distance.

The k-mers of a text (runs of ``k`` code points) are numbered by occurrence, so
that repeats count. For each of ``m`` orderings the ``l`` least numbered k-mers
are taken, put back into text order, and hashed as a tuple. Two texts agree in
an entry when they share the least k-mers and their order, so moving or
repeating passages lowers the likeness, which a set of k-mers would not show.

For each text's successor, rows are dealt out by ranges of (key, hash of the
text) of about equal bytes, whose bounds are rows; so the rows of one key may
lie in several ranges. Each range also gets the first row after it.

Edge cases: a null text is empty; a text of any length is fingerprinted whole; a text shorter than k is one k-mer, an empty
one has the fingerprint of no k-mer; with fewer than l k-mers all are taken;
ties between hash values go to the earlier k-mer; repeated rows have equal
fingerprints; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, code_points, map_rows, mix64, seeds, text_of

K, L, M = 6, 2, 64
_PRIME, _STEP = U64(0x100000001B3), U64(0x9E3779B97F4A7C15)
_FULL = np.uint32(0xFFFFFFFF)


def order_minhash(points: np.ndarray, k: int = K, l: int = L, m: int = M) -> np.ndarray:  # noqa: E741
    """m entries of 16 bits for the text with these code points."""
    n = len(points)
    if not n:
        return np.zeros(m, dtype="<u2")
    k = min(k, n)
    n = n - k + 1
    own = points.astype(U64)
    with np.errstate(over="ignore"):
        h = own[:n].copy()
        for i in range(1, k):
            h *= _PRIME
            h += own[i : i + n]
        h = mix64(h)
        # equal k-mers stand together and in text order once their positions are the low bits
        low = U64((1 << n.bit_length()) - 1)
        keyed = np.sort((h & ~low) | np.arange(n, dtype=U64))
        kmer, place = keyed & ~low, (keyed & low).astype(np.int64)
        first = np.empty(n, dtype=bool)
        first[0] = True
        np.not_equal(kmer[1:], kmer[:-1], out=first[1:])
        index = np.arange(n)
        number = np.empty(n, dtype=U64)
        number[place] = index - np.maximum.accumulate(np.where(first, index, 0))
        numbered = (mix64(h + (number + U64(1)) * _STEP) >> U64(32)).astype(np.uint32)
        salts = seeds(2 * m, 1)
        add, times = (salts[:m] >> U64(32)).astype(np.uint32), (salts[m:] >> U64(32)).astype(np.uint32) | np.uint32(1)
        l = min(l, n)  # noqa: E741
        least = np.empty((m, l), dtype=np.int64)
        step = max(1, (1 << 16) // n)
        for at in range(0, m, step):
            v = (numbered[None, :] ^ add[at : at + step, None]) * times[at : at + step, None]
            rows = np.arange(len(v))
            for j in range(l):
                least[at : at + step, j] = best = v.argmin(axis=1)
                if j + 1 < l:
                    v[rows, best] = _FULL
        least.sort(axis=1)
        out = np.full(m, l, dtype=U64)
        for j in range(l):
            out = mix64(out * _STEP + h[least[:, j]])
    return (out >> U64(48)).astype("<u2")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal entries."""
    return float(np.mean(a == b))


def text_of_fingerprint(f: np.ndarray) -> str:
    return f.astype(">u2").tobytes().hex()


#: Ranges that are weighed for each one that is made.
FINE = 16


def range_bounds(rows: DataFrame, ranges: int) -> tuple[tuple[int, int] | None, list[tuple[int, int]]]:
    """The least (at, h) of rows (at, h, body), and of each further one of about so many ranges of equal bytes.

    Approximate quantiles (doubles, which a key beyond 2**53 may miss) part the
    rows into fine ranges, whose least rows and bytes are exact. A key that
    alone is more than a range is split by hash.
    """
    near = np.array(sorted({max(-(2**63), min(int(x), 2**63 - 1)) for x in rows.select("at").approxQuantile("at", [i / (FINE * ranges) for i in range(1, FINE * ranges)], 0.1 / (FINE * ranges))}), dtype=np.int64) if ranges > 1 else np.empty(0, dtype=np.int64)

    @F.pandas_udf("long")
    def fine(at: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(near, at.to_numpy(), side="right"))

    found = sorted((tuple(r["least"]), r["bytes"]) for r in rows.groupBy(fine("at").alias("fine")).agg(F.min(F.struct("at", "h")).alias("least"), F.sum(F.octet_length("body") + 64).alias("bytes")).collect())
    if not found:
        return None, []
    most = sum(b for _, b in found) / ranges
    bounds, hot, held = set(), {}, 0
    for least, size in found:
        if held and held + size > most:
            bounds.add(least)
            held = 0
        held += size
        if size > 2 * most:
            hot[least[0]] = int(size / most)
    if hot:
        parts = F.coalesce(*(F.when(F.col("at") == k, F.lit(n)) for k, n in hot.items()))
        part = F.floor((F.shiftright("h", 32) + (1 << 31)) * parts / (1 << 32))
        bounds |= {tuple(r["least"]) for r in rows.where(F.col("at").isin(list(hot))).groupBy("at", part.alias("part")).agg(F.min(F.struct("at", "h")).alias("least")).collect()}
    return found[0][0], sorted(bounds - {found[0][0]})


def with_followers(docs: DataFrame, key: str, text: str, ranges: int) -> DataFrame:
    """Rows (bucket, late, key, text): each bucket has a range of rows in order of their keys and, late, the first row after it; after the last range comes the first row of all. Null keys come first."""
    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("body"))
    rows = rows.select("k", "body", F.coalesce(F.col("k").cast("long"), F.lit(-(2**63))).alias("at"), F.xxhash64("body").alias("h"))
    least, bounds = range_bounds(rows, ranges)
    ats, hs = (np.array([b[i] for b in bounds], dtype=np.int64) for i in (0, 1))
    several = {k for k, n in zip(*np.unique(ats, return_counts=True), strict=True)}

    @F.pandas_udf("long")
    def place(at: pd.Series, h: pd.Series) -> pd.Series:
        """Twice the number of the row's range, and one more if its bound is such a row."""
        a, b = at.to_numpy(), h.to_numpy()
        out = np.searchsorted(ats, a, side="left")
        for k in several & set(np.unique(a).tolist()):
            own = a == k
            out[own] += np.searchsorted(hs[ats == k], b[own], side="right")
        first = np.zeros(len(a), dtype=bool)
        if len(ats):
            before = np.maximum(out - 1, 0)
            first = (out > 0) & (ats[before] == a) & (hs[before] == b)
        return pd.Series(2 * out + first)

    row = lambda b, late: F.struct(b.cast("int").alias("bucket"), F.lit(late).alias("late"))
    bucket = F.floor(F.col("place") / 2)
    is_least = (F.col("at") == F.lit(least[0])) & (F.col("h") == F.lit(least[1])) if least else F.lit(False)
    to = F.array_compact(F.array(row(bucket, 0), F.when(F.col("place") % 2 == 1, row(bucket - 1, 1)), F.when(is_least, row(F.lit(len(bounds)), 1))))
    spread = rows.withColumn("place", place("at", "h")).select(F.explode(to).alias("to"), "at", "h", "k", "body").select("to.bucket", "to.late", "at", "h", "k", "body")
    return spread.repartitionById(len(bounds) + 1, "bucket").sortWithinPartitions("late", "at", "h", "body").select("bucket", "late", F.col("k").alias(key), F.col("body").alias(text))


def edited_pairs(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(key, text, edited text, next text) from the sorted rows of with_followers()."""
    held = None
    for bucket, late, key, text in rows:
        if held and held[0] == bucket:
            own = held[2]
            half = len(own) // 2
            yield held[1], own, own[: len(own) - half] + text[:half], text
        held = None if late else (bucket, key, text)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, l: int = L, m: int = M) -> DataFrame:  # noqa: E741
    """(key, fingerprint) for each row of docs."""
    rows = text_of(docs, key, text=text)

    def each(rows):
        for i, t in rows:
            yield i, text_of_fingerprint(order_minhash(code_points(t), k, l, m))

    return map_rows(rows, each, f"{key} {rows.schema[key].dataType.simpleString()}, fingerprint string")


def edit_sensitivity(docs: DataFrame, key: str = "doc_id", text: str = "text", buckets: int | None = None) -> DataFrame:
    """Each text's fingerprint beside those of its edited text and of the next text, and how alike they are.

    The edited text has its last half replaced by as many first code points of
    the next text in ascending order of the key (after the last the first).
    """
    buckets = buckets or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema[key].dataType.simpleString()

    def each(rows):
        last = (None, None)
        for i, own, edited, after in edited_pairs(rows):
            f = last[1] if last[0] == own else order_minhash(code_points(own))
            g = order_minhash(code_points(edited))
            last = after, order_minhash(code_points(after))
            yield i, len(own), hashlib.sha256(edited.encode()).hexdigest(), text_of_fingerprint(f), text_of_fingerprint(g), likeness(f, g), likeness(f, last[1])

    return map_rows(with_followers(docs, key, text, buckets), each, f"{key} {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double", 500)
