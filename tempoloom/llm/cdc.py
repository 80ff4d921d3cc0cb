"""Substring dedup by content-defined chunking with a gear rolling hash.

A boundary stands after each code point whose gear hash, of the last 16 code
points, is the greatest within ``RADIUS`` code points to either side. Chunks are
about 2 * RADIUS code points long, rarely very short or long, follow the content
and come back into step after an insertion: a shared passage has equal
boundaries from 16 + RADIUS code points after its begin to RADIUS before its end. A chunk whose
digest occurs earlier - in a document with a smaller key, or before in the same
one - is a repeat of its first occurrence.

1. Chunks are deduplicated by digest: the chunks of all documents are grouped
   by it with partial aggregation and joined back with the first place of each,
   which adaptive execution can split when a digest is very common.
2. Repeated chunks that touch and come from one place, in order, form a stretch
   of that source. Where the source changes, the longer run may still stand as
   a whole in a later document: all runs of several chunks across the change,
   until they have ``words`` words, are deduplicated in the same way by a digest
   of their digests; beyond EACH chunks, where words are very long, their lengths
   grow by a quarter. So a passage whose chunks occur first in several documents
   leads to the first document that holds the run.
3. Of the stretches and repeated runs of a document those within others go, and
   those go that can't be part of a long passage: beyond its chunks a passage
   covers no whole further chunk but those too near its ends to be in step.
4. The document and each source left are laid over each other there, and the
   equal text around is taken as far as it goes. Passages of at least ``words``
   words are repeats: the first occurrence stays, the others go. Short lines from
   several places that happen to touch are none.

A word begins at a character that isn't white space after one that is, and at
each character of a script that is written without spaces.

Edge cases: a null text is empty and has no chunks; rows with a null key are
not compared and stay as they are; rows that share a key and text count once,
rows that share a key only are documents of their own; a text that repeats a
few code points is cut at ties, one without any is cut every 1024 code points;
texts are compared whole, one pair at a time, however long they are; extra
columns are ignored or kept, whatever their names; an empty table gives an
empty table. A passage of fewer than about 150 code points, which is one of very
short words, may hold no whole chunk in step, and isn't found then. A passage that begins or ends in
a text that repeats itself without end may lose a part there, as chunks of such
a text are in step only from its begin; beside the ends of a passage, text of
less than a chunk may stay that only a later source shares.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANK, U64, code_points, map_rows, mix64, seeds, written

RADIUS, LONGEST = 16, 1024
#: Words from which a repeated passage counts.
WORDS = 50
#: Chunks up to which runs of every length are tried; beyond, lengths grow by a quarter.
EACH = 24
#: Greatest count of words that a chunk's row holds; that of chunks beyond it only matters as being that great.
_COUNT = 127
_GEAR = (seeds(256, 3) >> np.uint64(48)).astype(np.uint16)
_HIGH = np.uint32(0x9E3779B1)
_STEP = U64(0x9E3779B97F4A7C15)
#: Ranges of code points of scripts written without spaces: Thai and Lao, Burmese, Khmer, kana and Han.
_UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))


def word_begins(points: np.ndarray) -> np.ndarray:
    """How many words begin before each place of a text, and before its end."""
    blank = BLANK[np.minimum(points, 0x3001)]
    begins = np.ones(len(points), dtype=bool)
    begins[1:] = blank[:-1]
    if len(points) and int(points.max()) >= _UNSPACED[0][0]:
        own = np.zeros(len(points), dtype=bool)
        for low, high in _UNSPACED:
            own |= (points >= low) & (points <= high)
        begins |= own
        begins[1:] |= own[:-1]
    return np.concatenate(([0], np.cumsum(begins & ~blank)))


def gear_hashes(points: np.ndarray) -> np.ndarray:
    """The gear hash up to each code point, in 16 bits, so that it holds the last 16: h = 2 * h before + gear."""
    h = _GEAR[points & np.uint32(255)] + ((points >> np.uint32(8)) * _HIGH >> np.uint32(16)).astype(np.uint16)
    for i in range(4):  # after i steps h covers 2**i code points
        w = 1 << i
        if len(h) > w:
            more = h.copy()
            more[w:] += h[:-w] << np.uint16(w)
            h = more
    return h


def cut_points(points: np.ndarray, radius: int = RADIUS, longest: int = LONGEST) -> list[int]:
    """The ends of the chunks of a text with these code points."""
    n = len(points)
    if not n:
        return []
    h = gear_hashes(points)
    padded = np.zeros(n + 2 * radius, dtype=h.dtype)
    padded[radius : radius + n] = h
    top, w = padded, 1  # top[i]: the greatest of padded[i : i + w]
    while w < radius:
        step = min(w, radius - w)
        top = np.maximum(top[: len(top) - step], top[step:])
        w += step
    left, right = top[:n], top[radius + 1 : radius + 1 + n]
    # of equal hashes the first counts, so that a text that repeats itself has no boundaries here
    ends = np.flatnonzero((h > left) & (h >= right)) + 1
    if not len(ends) or ends[-1] != n:
        ends = np.append(ends, n)
    starts = np.concatenate(([0], ends[:-1]))
    wide = np.flatnonzero(ends - starts > 8 * radius)
    if not len(wide):
        return ends.tolist()
    # in such a stretch, ties stand one period apart: cuts at the first tie after each 2 * radius give equal chunks
    ties = np.flatnonzero((h >= left) & (h >= right)) + 1
    out = set(ends.tolist())
    for start, end in zip(starts[wide].tolist(), ends[wide].tolist(), strict=True):
        own = ties[np.searchsorted(ties, start, side="right") : np.searchsorted(ties, end)].tolist()
        at = start
        for t in own:
            if t - at >= 2 * radius:
                out.add(t)
                at = t
    cuts, at = [], 0
    for e in sorted(out):
        cuts += range(at + longest, e, longest)
        cuts.append(e)
        at = e
    return cuts


def identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(u, body): the documents with a key; u is the key or, where rows share a key but not the text, the key with a hash of the text."""
    rows = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("body"))
    h = F.xxhash64("body")
    several = rows.groupBy("id").agg(F.min(h).alias("a"), F.max(h).alias("b")).where("a <> b")
    return rows.select(F.col("id").alias("u") if several.isEmpty() else F.struct("id", h.alias("h")).alias("u"), "body")


def _type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def chunks(texts: DataFrame) -> DataFrame:
    """(u, start, shape, digest) of every chunk of the texts (u, body), in code points; shape: its size, the words that begin in it, and those that a passage may have before and after it without holding the next chunk in step."""

    def cut(batches):
        for whole in batches:
            for begin in range(0, whole.num_rows, 200):
                b = whole.slice(begin, 200)
                ids, starts, shapes, digests = [], [], [], []
                for number, t in enumerate(b.column(1).to_pylist()):
                    points = code_points(t)
                    ends = np.array(cut_points(points), dtype=np.int64)
                    if not len(ends):
                        continue
                    at = np.concatenate(([0], ends))
                    words = word_begins(points)
                    own = words[at]
                    before, after = np.zeros(len(ends), dtype=np.int64), np.zeros(len(ends), dtype=np.int64)
                    before[1:] = own[1:-1] - words[np.maximum(at[:-2] - 16 - RADIUS, 0)]
                    after[:-1] = words[np.minimum(at[2:] + RADIUS, len(points))] - own[1:-1]
                    shape = np.diff(at)
                    for place, n in ((11, np.diff(own)), (18, before), (25, after)):
                        shape |= np.minimum(n, _COUNT) << place
                    raw = memoryview(points).cast("B")
                    ids.append(np.full(len(ends), number, dtype=np.int32))
                    starts.append(at[:-1])
                    shapes.append(shape)
                    bounds = (4 * at).tolist()
                    digests += [xxhash.xxh3_64_intdigest(raw[x:y]) for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
                if ids:
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(np.concatenate(ids))), pa.array(np.concatenate(starts).astype(np.int32)), pa.array(np.concatenate(shapes).astype(np.uint32).view(np.int32)), pa.array(np.array(digests, dtype=np.uint64).view(np.int64))], names=["u", "start", "shape", "digest"])

    return texts.mapInArrow(cut, f"u {_type(texts, 'u')}, start int, shape int, digest long")


def first_places(rows: DataFrame, digest: str, name: str) -> DataFrame:
    """(digest, first) of the digests that several rows (u, start, digest) have: the first place."""
    # written, so that the join with it is of two plain shuffles, whose large partitions can be split
    return written(rows.groupBy(digest).agg(F.min(F.struct("u", "start")).alias("first"), F.count("*").alias("n")).where("n > 1").select(digest, "first"), name)


def runs_of(starts: np.ndarray, shapes: np.ndarray, digests: np.ndarray, sources: list[tuple], own, words: int):
    """What a document's chunks that several places have lead to: rows (start, end, run, source).

    Stretches of one source other than the document's own place have the
    source and no run; runs across changes of source have the run's digest and
    no source. Those are left out around which a passage can't have enough
    words; one that holds another has as many words around it at least, so
    nothing is lost when the longest are looked for among the others.
    """
    shape = shapes.view(np.uint32).astype(np.int64)
    size, n, before, after = shape & 2047, shape >> 11 & 127, shape >> 18 & 127, shape >> 25 & 127
    ends = starts + size
    begun = np.concatenate(([0], np.cumsum(n)))
    touch = np.zeros(len(starts), dtype=bool)
    touch[1:] = starts[1:] == ends[:-1]
    change = np.array([False, *(a != b for a, b in zip(sources[1:], sources[:-1], strict=True))])
    heads = np.flatnonzero(~touch | change)
    lasts = np.append(heads[1:], len(starts)) - 1
    bounds = before[heads] + begun[lasts + 1] - begun[heads] + after[lasts]
    for i, j, bound in zip(heads.tolist(), lasts.tolist(), bounds.tolist(), strict=True):
        if sources[i] != own and bound >= words:
            yield int(starts[i]), int(ends[j]), None, sources[i]
    if not (touch & change).any():
        return
    changes, gaps = np.cumsum(change), np.cumsum(~touch)
    with np.errstate(over="ignore"):
        # sums over the digests before each place, each times a power: differences tell runs apart wherever they stand
        power = np.cumprod(np.concatenate(([U64(1)], np.full(len(starts), _STEP))))
        back = np.cumprod(np.concatenate(([U64(1)], np.full(len(starts), U64(pow(int(_STEP), -1, 2**64))))))
        sums = np.concatenate(([U64(0)], np.cumsum(digests.view(U64) * power[:-1])))
    at, length = np.arange(len(starts)), 1
    while True:
        # longer runs of those that have too few words yet, within chunks that touch; chunks of long words by larger steps
        at = at[begun[at + length] - begun[at] < words]
        length = length + 1 if length < EACH else length * 5 // 4
        at = at[at + length <= len(starts)]
        at = at[gaps[at + length - 1] == gaps[at]]
        if not len(at):
            return
        last = at + length - 1
        bounds = before[at] + begun[last + 1] - begun[at] + after[last]
        mixed = (changes[last] > changes[at]) & (bounds >= words)
        from_, to = at[mixed], last[mixed]
        with np.errstate(over="ignore"):
            h = mix64((sums[to + 1] - sums[from_]) * back[from_] + U64(length)).view(np.int64)
        for row in zip(starts[from_].tolist(), ends[to].tolist(), h.tolist(), strict=True):
            yield *row, None


def stretches(parts: DataFrame, words: int) -> DataFrame:
    """(u, start, end, run, of, shift): the rows of runs_of() for all documents with the chunks parts."""
    first = first_places(parts, "digest", "first")
    places = parts.hint("merge").join(first, "digest").select("u", F.struct("start", "shape", "digest", F.col("first.u").alias("of"), (F.col("start") - F.col("first.start")).alias("shift")).alias("x"))
    rows = places.groupBy("u").agg(F.sort_array(F.collect_list("x")).alias("x")).select("u", "x.start", "x.shape", "x.digest", "x.of", "x.shift")
    kind = _type(parts, "u")

    def each(batches):
        for whole in batches:
            for begin in range(0, whole.num_rows, 500):
                b = whole.slice(begin, 500)
                us, out = b.column(0).to_pylist(), []
                for number, u in enumerate(us):
                    starts, shapes, digests = (b.column(c)[number].values.to_numpy() for c in (1, 2, 3))
                    of, shift = b.column(4)[number].values.to_pylist(), b.column(5)[number].values.to_pylist()
                    if len(starts) > 1 and (again := np.flatnonzero(np.diff(starts) == 0)).size:  # rows that are the same
                        one = np.delete(np.arange(len(starts)), again + 1)
                        starts, shapes, digests, of, shift = starts[one], shapes[one], digests[one], [of[i] for i in one], [shift[i] for i in one]
                    for start, end, run, source in runs_of(starts.astype(np.int64), shapes, digests, list(zip(of, shift, strict=True)), (u, 0), words):
                        out.append((number, start, end, run, *(source or (None, None))))
                if out:
                    number, start, end, run, of, shift = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(number, pa.int32())), *(pa.array(x, pa.int32()) for x in (start, end)), pa.array(run, pa.int64()), pa.array(of, b.column(0).type), pa.array(shift, pa.int32())], names=["u", "start", "end", "run", "of", "shift"])

    return rows.mapInArrow(each, f"u {kind}, start int, end int, run long, of {kind}, shift int")


def sources(parts: DataFrame, words: int = WORDS) -> DataFrame:
    """(u, of, places): where the text of u may stand in an earlier place of `of`: (start, end, shift), of code points."""
    rows = written(stretches(parts, words), "stretches")
    runs = rows.where("run IS NOT NULL").drop("of", "shift")
    found = runs.hint("merge").join(first_places(runs, "run", "runs"), "run").where(F.struct("u", "start") != F.col("first"))
    found = found.select("u", "start", "end", F.col("first.u").alias("of"), (F.col("start") - F.col("first.start")).alias("shift"))
    both = rows.where("run IS NULL").drop("run").unionByName(found)
    # those within others go; of equal ones the first source stays
    reach = F.max("end").over(Window.partitionBy("u").orderBy("start", F.desc("end"), "of", "shift").rowsBetween(Window.unboundedPreceding, -1))
    outer = both.withColumn("reach", reach).where(F.col("reach").isNull() | (F.col("end") > F.col("reach")))
    return outer.groupBy("u", "of").agg(F.sort_array(F.collect_list(F.struct("start", "end", "shift"))).alias("places"))


def _equal(a: np.ndarray, b: np.ndarray) -> int:
    """How many code points a and b have in common at their begin."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        other = np.flatnonzero(a[at : min(n, at + step)] != b[at : min(n, at + step)])
        if len(other):
            return at + int(other[0])
        at, step = at + step, step * 4
    return n


def passages(own: np.ndarray, its: np.ndarray, places: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The stretches of own around the places (start, end, shift) that are equal to its text, shift code points before, as far as they go. A place that lies in a stretch found before is skipped."""
    out: list[tuple[int, int]] = []
    for start, end, shift in places:
        if out and end <= out[-1][1]:
            continue
        if start < shift or not np.array_equal(own[start:end], its[start - shift : end - shift]):
            continue
        left = _equal(own[:start][::-1], its[: start - shift][::-1])
        out.append((start - left, end + _equal(own[end:], its[end - shift :])))
    return out


def laid_over(pairs: DataFrame, texts: DataFrame, words: int = WORDS) -> DataFrame:
    """(u, start, end, words, of): the passages of enough words that u shares with `of` around the places of pairs."""
    pairs = written(pairs, "pairs")
    # all texts go through one join with what is asked of them, and only those asked for go on to their pairs
    asked = pairs.select("u", "of", F.explode(F.array(F.struct(F.col("u").alias("id"), F.lit(0).alias("role")), F.struct(F.col("of").alias("id"), F.lit(1).alias("role")))).alias("x")).select("u", "of", "x.id", "x.role")
    found = asked.hint("merge").join(texts.withColumnRenamed("u", "id").hint("merge"), "id")
    side = lambda role, name: F.max(F.when(F.col("role") == role, F.col("body"))).alias(name)
    both = found.groupBy("u", "of").agg(side(0, "own"), side(1, "its"))
    rows = both.hint("merge").join(pairs.hint("merge"), ["u", "of"]).select("u", "of", "places", "own", "its")

    def each(rows_):
        for u, of, places, own, its in rows_:
            a = code_points(own)
            count = None
            for start, end in passages(a, a if u == of else code_points(its), [(p["start"], p["end"], p["shift"]) for p in places]):
                count = word_begins(a) if count is None else count
                if (n := int(count[end] - count[start])) >= words:
                    yield u, start, end, n, of

    kind = _type(pairs, "u")
    return map_rows(rows, each, f"u {kind}, start int, end int, words long, of {kind}", 500)


def longest(found: DataFrame) -> DataFrame:
    """The passages (u, start, end, words, of) that are not within others."""
    one = found.groupBy("u", "start", "end").agg(F.max("words").alias("words"), F.min("of").alias("of"))
    reach = F.max("end").over(Window.partitionBy("u").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1))
    return one.withColumn("reach", reach).where(F.col("reach").isNull() | (F.col("end") > F.col("reach"))).drop("reach")


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(id, start, end, words, first_id, text_hash): passages of at least ``words`` words, 127 at most, that occur before, in code points of id's text; text_hash tells which text of id it is where there are several, and is null otherwise."""
    if not 1 <= words <= _COUNT:
        raise ValueError(f"words has to be between 1 and {_COUNT}")
    texts = identified(docs, key, text)
    found = longest(laid_over(sources(chunks(texts), words), texts, words))
    several = not isinstance(docs.schema[key].dataType, type(found.schema["u"].dataType))
    own, of, h = ("u.id", "of.id", F.col("u.h")) if several else ("u", "of", F.lit(None).cast("long"))
    return found.select(F.col(own).alias("id"), "start", "end", "words", F.col(of).alias("first_id"), h.alias("text_hash"))


def without_spans(docs: DataFrame, spans: DataFrame, key: str = "doc_id", text: str = "text", length: str = "n_chars") -> DataFrame:
    """docs with the spans cut out of their texts and length set anew where something was cut."""
    names, schema = docs.columns, docs.schema
    at = names.index(text)
    n_at = names.index(length) if length in names else None
    per = spans.groupBy("id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cut"))
    own = docs.toDF(*(f"c{i}" for i in range(len(names))))  # the columns of docs may have any name
    same = (F.col(f"c{names.index(key)}") == F.col("id")) & (F.col("text_hash").isNull() | (F.col("text_hash") == F.xxhash64(F.coalesce(F.col(f"c{at}").cast("string"), F.lit("")))))
    rows = own.join(per, same, "left").select(*own.columns, "cut")

    def apply(batches):
        for whole in batches:
            for begin in range(0, whole.num_rows, 500):
                b = whole.slice(begin, 500)
                texts, counts = [], []
                old = b.column(n_at).to_pylist() if n_at is not None else [None] * b.num_rows
                for t, spans_, n in zip(b.column(at).to_pylist(), b.column(len(names)).to_pylist(), old, strict=True):
                    if t is not None and spans_:
                        kept, seen = [], 0
                        for s in spans_:
                            kept.append(t[seen : max(seen, s["start"])])
                            seen = max(seen, s["end"])
                        t = "".join(kept) + t[seen:]
                        n = len(t)
                    texts.append(t)
                    counts.append(n)
                columns = list(b.columns[: len(names)])
                columns[at] = pa.array(texts, type=pa.string())
                if n_at is not None:
                    columns[n_at] = pa.array(counts, type=columns[n_at].type)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(apply, schema)
