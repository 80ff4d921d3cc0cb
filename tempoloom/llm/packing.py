"""Packing: harmonic packing into reciprocal-capacity classes, independently in each worker.

A length of more than capacity / (k + 1) and at most capacity / k tokens is of
class k; a bin of class k takes exactly k documents, whole. A longer document
gives full sequences first, and its rest, which is a length like the others.
What room a closed bin has left is filled with the rests of long documents,
cut as needed; a short document is cut only while the room that waits is more
than ``PATIENCE`` sequences. So most documents stay in one piece and bins end up
full. Workers fill bins alone, in one pass, holding one open bin for each class
and the bins that wait for a filling. What a worker has left at its end is
strung together and cut at the capacity, and the last stretch is cut into powers
of two, each a sequence of its own, as a sequence whose fill is a power of two
needs no padding.

Ids are those of the vocabulary's library. Where its file describes plain
byte-level merges, texts are encoded by a faster engine with the same
vocabulary, in parts cut at safe boundaries; a part that has no boundary for
long, such as a run of white space, goes to the library itself.

Edge cases: a null text is empty and has only the closing id; a text longer
than the capacity spans several sequences; a text of any length is encoded
whole, its parts one at a time; lengths of equal class go into bins in the order
of the rows, so ties need no rule; equal rows are packed once each; a
document's pieces cover its ids once, in order; other columns are ignored; an
empty table gives an empty table.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .bpe import COMMON_PATTERN
from .common import text_of
from .tokencounts import LONG_CHARS, safe_parts, splits_safely

CAPACITY = 1024
#: Lengths below capacity / CLASSES are all of the last class, whose bins take that many, too.
CLASSES = 64
#: Sequences' worth of room that may wait for rests of long documents before short ones are cut.
PATIENCE = 4
#: Sequence ids are the number of the worker's partition, then that of the sequence within it.
SEQUENCE_BITS = 40


class Harmonic:
    """The bins of one worker. A document is a tag and its length; pieces are (tag, start, length, sequence, offset)."""

    def __init__(self, first: int, capacity: int = CAPACITY):
        self.next, self.capacity = first, capacity
        self.open: dict[int, list[tuple]] = {}
        #: (-room, number, pieces) of the closed bins that wait for a filling, the most room first, and their room together.
        self.waiting: list[tuple[int, int, list[tuple]]] = []
        self.room = self.closed = 0

    def _close(self, pieces: list[tuple]) -> Iterator[tuple]:
        at = 0
        for tag, start, length in pieces:
            yield tag, start, length, self.next, at
            at += length
        self.next += 1

    def _wait(self, pieces: list[tuple]) -> Iterator[tuple]:
        """Closes a bin that is full, or as good as full; others wait."""
        fill = sum(p[2] for p in pieces)
        if fill == self.capacity or fill & (fill - 1) == 0:
            yield from self._close(pieces)
        else:
            self.closed += 1
            heappush(self.waiting, (fill - self.capacity, self.closed, pieces))
            self.room += self.capacity - fill

    def whole(self, n: int) -> int:
        """Of the n tokens of a document, those for full sequences; a long one keeps back what the room that waits can take."""
        rest = n % self.capacity
        if n > self.capacity and self.room >= rest + self.capacity:
            rest += min(n - rest, self.room - rest) // self.capacity * self.capacity
        return n - rest

    def full(self, tag, n: int) -> Iterator[tuple]:
        """The full sequences of the first n tokens of a document."""
        for start in range(0, n, self.capacity):
            yield from self._close([(tag, start, self.capacity)])

    def add(self, tag, n: int, rest: bool = False) -> Iterator[tuple]:
        """The pieces whose sequence is complete now that n tokens have come: a short document, or the rest of a long one."""
        if self.room >= n + (0 if rest else PATIENCE * self.capacity):
            start = 0
            while start < n:
                room, _, pieces = heappop(self.waiting)
                self.room += room
                take = min(n - start, -room)
                yield from self._wait([*pieces, (tag, start, take)])
                start += take
            return
        k = min(self.capacity // n, CLASSES)
        pieces = self.open.setdefault(k, [])
        pieces.append((tag, 0, n))
        if len(pieces) == k:
            yield from self._wait(self.open.pop(k))

    def rest(self) -> Iterator[tuple]:
        """The pieces of what is still open or waits, cut so that no sequence needs padding."""
        left = [p for _, _, pieces in sorted(self.waiting, key=lambda w: w[:2]) for p in pieces] + [p for k in sorted(self.open) for p in self.open[k]]
        self.open, self.waiting, self.room = {}, [], 0
        total = sum(p[2] for p in left)
        room = 0
        pieces: list[tuple] = []
        for tag, start, length in left:
            while length:
                if not room:
                    room = min(self.capacity, 1 << (total.bit_length() - 1))
                    total -= room
                take = min(length, room)
                pieces.append((tag, start, take))
                start, length, room = start + take, length - take, room - take
                if not room:
                    yield from self._close(pieces)
                    pieces = []


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: visible ones for themselves, the others by those from 256 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


def plain_ranks(path: str) -> tuple[dict[bytes, int], dict[str, int]] | None:
    """The bytes of each token with its id, and the added strings with theirs, if the file describes byte-level merges whose order is that of the ids; None otherwise."""
    if not splits_safely(path):
        return None
    with open(path, encoding="utf-8") as f:
        whole = json.load(f)
    model, byte = whole["model"], byte_alphabet()
    if model.get("type") != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback")):
        return None
    added = {t["content"]: t["id"] for t in whole.get("added_tokens") or []}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    vocab = model["vocab"]
    made = [vocab.get(a + b) for a, b in merges]
    # ids of single bytes come first, in any order, then one id for each merge, in order
    if made != list(range(256, 256 + len(made))) or len(vocab.keys() - added.keys()) != 256 + len(made):
        return None
    return {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in added}, added


@cache
def _encoder(path: str):
    """The function that gives the ids of a text; one for each worker process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    slow = lambda text: np.array(library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
    if (found := plain_ranks(path)) is None:
        return slow
    import tiktoken

    ranks, added = found
    own = tiktoken.Encoding("packing", pat_str=COMMON_PATTERN, mergeable_ranks=ranks, special_tokens=added)
    fast = lambda text: own.encode_to_numpy(text, allowed_special="all", disallowed_special=())

    def encode(text: str) -> np.ndarray:
        if len(text) <= LONG_CHARS:
            return fast(text)
        return np.concatenate([fast(p) if len(p) <= 2 * LONG_CHARS else slow(p) for p in safe_parts(text)])

    return encode


def pack(docs: DataFrame, path: str, end_id: int = 0, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each piece: where it begins in its document, where it lies in which sequence, and the crc32 of its ids.

    path: the vocabulary's file, as its library reads it; end_id closes each document.
    """
    rows = text_of(docs, key, text=text)
    kind = rows.schema[key].dataType.simpleString()
    names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def table(held: list[tuple], type_: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*held, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(columns[0], type=type_), *(pa.array(c, type=pa.int64()) for c in columns[1:])], names=names)

    def worker(batches):
        encode = _encoder(path)
        bins = Harmonic((TaskContext.get().partitionId() if TaskContext.get() else 0) << SEQUENCE_BITS, capacity)
        held: list[tuple] = []
        type_ = None

        def put(found):
            for (doc, n, begin, ids), start, length, sequence, offset in found:
                held.append((doc, begin + start, length, zlib.crc32(ids[start : start + length].tobytes()), n, sequence, offset))

        for b in batches:
            type_ = b.column(0).type
            for doc, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = np.append(encode(t), np.uint32(end_id)).astype("<u4")
                n = len(ids)
                whole = bins.whole(n)
                put(bins.full((doc, n, 0, ids), whole))
                if n > whole:  # only the rest is held while its bin is open
                    put(bins.add((doc, n, whole, ids[whole:].copy()), n - whole, n > capacity))
                if len(held) >= 20_000:
                    yield table(held, type_)
                    held = []
        put(bins.rest())
        if held:
            yield table(held, type_)

    return rows.mapInArrow(worker, f"{key} {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")

