"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one: a minimal perfect hash over the whole vocabulary resolves pre-tokens
that are tokens themselves, whole batches of them in vectorised steps. The keys
are the first 16 bytes in two words with the length, and for a longer one a
hash of all bytes; they are compared after the lookup, so no pre-token is taken
for another. Tier two: other pre-tokens are merged on a linked list of byte
ranges with a heap of pairs ordered by (rank, position); results of short ones
are kept in a bounded table of the worker.

Edge cases: a null text is empty and has no ids; lone surrogates cannot occur
in Spark strings; a text of one very long pre-token takes O(n log n); repeated
rows give repeated results; other columns are ignored; an empty table gives an
empty table; a null id list decodes to null.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from .common import U64, code_points, mix64, seeds, text_of

_MASKS = np.array([(1 << (8 * i)) - 1 for i in range(9)], dtype=U64)
#: Entries of the table of merged pre-tokens, and the bytes of the longest pre-token kept in it.
KEPT, KEPT_BYTES = 400_000, 40


class PerfectHash:
    """A minimal perfect hash: n distinct 64-bit keys onto 0..n-1, by levels of collision-free slots.

    Each level hashes the keys left over into twice as many slots; keys alone
    in their slot stay there, the others go on. Ranks over the used slots of
    all levels are the result.
    """

    def __init__(self, keys: np.ndarray):
        self.levels: list[np.ndarray] = []
        self.seeds = seeds(64, 4)
        left, base = keys, 0
        while len(left):
            size = 2 * len(left)
            at = self._slot(left, len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            ranks = np.where(alone, np.cumsum(alone) - 1 + base, -1).astype(np.int32)
            self.levels.append(ranks)
            base += int(alone.sum())
            left = left[~alone[at]]
        self.size = base

    def _slot(self, keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix64(keys ^ self.seeds[level]) % U64(size)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; some number or -1 for a key that is not among those hashed."""
        out = np.full(len(keys), -1, dtype=np.int32)
        open_ = np.arange(len(keys))
        for level, ranks in enumerate(self.levels):
            if not len(open_):
                break
            got = ranks[self._slot(keys[open_], level, len(ranks))]
            out[open_] = got
            open_ = open_[got < 0]
        return out


def _words(data: bytes, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and second 8 bytes from each start, zero from its length on."""
    padded = data + bytes(16)
    view = np.ndarray(shape=(len(data) + 9,), dtype="<u8", buffer=padded, strides=(1,))
    first = view[starts] & _MASKS[np.minimum(lengths, 8)]
    second = view[np.minimum(starts + 8, len(data))] & _MASKS[np.clip(lengths - 8, 0, 8)]
    return first, second


def _key(first: np.ndarray, second: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(first ^ mix64(second + lengths.astype(U64) * U64(0x9E3779B97F4A7C15)))


def _keys(data: bytes, starts: np.ndarray, first: np.ndarray, second: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The keys of stretches of data: of their two words, and of all bytes of those longer than these."""
    out = _key(first, second, lengths)
    for i in np.flatnonzero(lengths > 16).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : starts[i] + lengths[i]])
    return out


def merge(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """The ids of a pre-token that is no token itself: of the adjacent pairs, that of the lowest rank is merged first, the leftmost of equal ones."""
    n, get = len(piece), ranks.get
    after, before = list(range(1, n + 1)), list(range(-1, n))  # after[i] is 0 once the range at i is merged into another
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    push, pop = heapq.heappush, heapq.heappop
    while heap:
        _, i, end = pop(heap)
        j = after[i]
        if not j or j >= n or after[j] != end:
            continue
        after[j], after[i], before[end] = 0, end, i
        if end < n and (r := get(piece[i : (stop := after[end])])) is not None:
            push(heap, (r, i, stop))
        if (h := before[i]) >= 0 and (r := get(piece[h:end])) is not None:
            push(heap, (r, h, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return tuple(out)


#: The pattern of contractions, words, numbers, other signs and white space that byte-level vocabularies use; it is cut without the regular expression.
COMMON_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)


@cache
def _classes() -> np.ndarray:
    """Of each code point: white space, letter, number or other."""
    out = np.full(0x110000, _OTHER, dtype=np.uint8)
    usable = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
        for m in regex.finditer(pattern, usable):
            out[code_points(m[0])] = kind
    return out


def common_starts(points: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where the matches of COMMON_PATTERN begin in texts put one after the other; texts: where each non-empty one begins.

    A run of one class is a match, with a blank before it if there is one. Of
    white space before other signs the last one stands apart, as it is that
    blank or a match of its own. An apostrophe that begins a match takes the
    letters of a contraction from the word after it.
    """
    n = len(points)
    kind = _classes()[points]
    first = np.zeros(n + 1, dtype=bool)
    first[texts] = first[n] = True
    new = first[:n].copy()
    new[1:] |= kind[1:] != kind[:-1]
    space, blank = kind == _SPACE, points == 32
    after_blank = np.zeros(n, dtype=bool)
    after_blank[1:] = blank[:-1] & ~first[1:n]
    before_other = np.zeros(n, dtype=bool)
    before_other[:-1] = ~space[1:] & ~first[1:n]
    start = np.where(space, new | before_other, new & ~after_blank)
    at = np.flatnonzero((points == 39) & start)
    at = at[~first[at + 1]] if len(at) else at
    if len(at):
        one = points[at + 1]
        inside = ~first[at + 2]  # first[n] is true, and at + 1 < n here
        two = np.where(inside, points[np.minimum(at + 2, n - 1)], 0)
        letters = lambda c: sum((one == ord(x) for x in c), np.zeros(len(at), dtype=bool))
        short = letters("stmd")
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        start[at[short | long] + 1] = False
        begin = np.append(start, True)
        begin[at[short] + 2] = begin[at[long] + 3] = True
        start = begin[:n]
    return np.flatnonzero(start)


class _Merged(dict):
    """Ids of pre-tokens: those met lately, and behind them a generation of those met before."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks, self.older = ranks, {}

    def __missing__(self, token: bytes) -> tuple[int, ...]:
        ids = self.older.get(token)
        if ids is None:
            ids = merge(token, self.ranks)
        if len(token) <= KEPT_BYTES:
            if len(self) >= KEPT // 2:
                self.older = dict(self)
                self.clear()
            self[token] = ids
        return ids


class Codec:
    """Encodes and decodes by the ranks in a file of base64 tokens and ranks; pattern cuts the pre-tokens."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
        self.pattern, self.common = regex.compile(pattern), pattern == COMMON_PATTERN
        self.merged = _Merged(self.ranks)
        self.token = {i: t for t, i in self.ranks.items()}
        tokens = list(self.ranks)
        lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        data, starts = b"".join(tokens), np.cumsum(lengths) - lengths
        first, second = _words(data, starts, lengths)
        keys = _keys(data, starts, first, second, lengths)
        self.hash = PerfectHash(keys)
        at = self.hash(keys)
        self.first, self.second, self.length, self.id = (np.empty(len(tokens), dtype=d) for d in (U64, U64, np.int64, np.int32))
        self.first[at], self.second[at], self.length[at], self.id[at] = first, second, lengths, list(self.ranks.values())

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and where those of each text begin (with the end at last)."""
        joined = "".join(texts)
        if not joined:
            return np.empty(0, dtype=np.int32), np.zeros(len(texts) + 1, dtype=np.int64)
        begin = np.cumsum([0, *map(len, texts)])  # of each text, in code points
        points = code_points(joined)
        if self.common:
            starts = common_starts(points, begin[:-1][begin[:-1] < begin[1:]])
        else:
            sizes = [len(x) for t in texts for x in self.pattern.findall(t)]
            starts = np.cumsum([0, *sizes[:-1]])
        of_text = np.searchsorted(starts, begin)
        data = joined.encode()
        if len(data) > len(points):
            size = np.cumsum(1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF))
            starts = np.where(starts > 0, size[starts - 1], 0)
        lengths = np.diff(starts, append=len(data))
        first, second = _words(data, starts, lengths)
        key = _keys(data, starts, first, second, lengths)
        at = self.hash(key)
        hit = (at >= 0) & (self.first[at] == first) & (self.second[at] == second) & (self.length[at] == lengths)
        for i in np.flatnonzero(hit & (lengths > 16)).tolist():
            hit[i] = self.token[int(self.id[at[i]])] == data[starts[i] : starts[i] + lengths[i]]
        missed = np.flatnonzero(~hit)
        # a pre-token is looked up once in a batch; of 16 bytes or less by its words, else by its key, too
        _, one, order = np.unique(key[missed], return_index=True, return_inverse=True)
        looked = missed[one]
        same = (first[missed] == first[looked[order]]) & (second[missed] == second[looked[order]]) & (lengths[missed] == lengths[looked[order]])
        long = np.flatnonzero(same & (lengths[missed] > 16))
        for i in long.tolist():
            m, o, n = missed[i], looked[order[i]], lengths[missed[i]]
            same[i] = m == o or data[starts[m] : starts[m] + n] == data[starts[o] : starts[o] + n]
        apart = np.flatnonzero(~same)  # as good as never: equal keys of different bytes
        order[apart] = len(looked) + np.arange(len(apart))
        looked = np.concatenate((looked, missed[apart]))
        other = [self.merged[data[s : s + n]] for s, n in zip(starts[looked].tolist(), lengths[looked].tolist(), strict=True)]
        each = np.fromiter(map(len, other), dtype=np.int64, count=len(other))
        counts = np.ones(len(starts), dtype=np.int64)
        counts[missed] = each[order]
        to = np.concatenate(([0], np.cumsum(counts)))
        ids = np.empty(to[-1], dtype=np.int32)
        whole = np.flatnonzero(hit)
        ids[to[whole]] = self.id[at[whole]]
        if other:
            flat = np.fromiter(chain.from_iterable(other), dtype=np.int32)
            n = counts[missed]
            within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            ids[np.repeat(to[missed], n) + within] = flat[np.repeat((np.cumsum(each) - each)[order], n) + within]
        return ids, to[of_text]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


@cache
def codec(path: str, pattern: str) -> Codec:
    """One for each worker process."""
    return Codec(path, pattern)


def _groups(texts: list[str], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` characters together."""
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def bpe_encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids) for each row of docs: the ids of its text, each match of pattern encoded separately."""
    rows = text_of(docs, key, text=text)

    def encode(batches):
        own = codec(path, pattern)
        for b in batches:
            texts = b.column(1).to_pylist()
            for begin, end in _groups(texts):
                ids, at = own.encode(texts[begin:end])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(begin, end - begin), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))], names=[key, "ids"])

    return rows.mapInArrow(encode, f"{key} {rows.schema[key].dataType.simpleString()}, ids array<int>")


def bpe_decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """encoded with one more column: the bytes that the ids stand for."""
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in encoded.schema)}, `{decoded}` binary"
    at = encoded.columns.index(ids)

    def decode(batches):
        own = codec(path, pattern)
        for whole in batches:
            for begin in range(0, whole.num_rows, 500):
                b = whole.slice(begin, 500)
                out = [None if x is None else own.decode(x) for x in (v.values.to_numpy(zero_copy_only=False).tolist() if v.is_valid else None for v in b.column(at))]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, type=pa.binary())], names=[*b.schema.names, decoded])

    return encoded.mapInArrow(decode, schema)
