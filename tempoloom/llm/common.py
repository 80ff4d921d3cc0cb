"""What several text operators share: shared-folder tables, hashing, words, Arrow helpers."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
_GOLDEN = 0x9E3779B97F4A7C15
#: Rows from which a table of a few numbers is worth a file of its own.
ROWS_A_FILE = 50_000
#: The paths of the tables made within the innermost temporary(), if there is one.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)
_M1, _M2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only where that is unset (tests, local mode)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):  # local-cluster is a cluster, too
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="tempoloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def in_few(df: DataFrame, rows: int) -> DataFrame:
    """df, where its last exchange brings about so many rows of a few numbers, in no more partitions than these fill or cores can work on.

    Where Hadoop has no native code, each file that is written starts two
    processes in the executor, which share all of its memory as they start.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_A_FILE)))


def written(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """df as a Parquet table in the shared folder: later jobs read it, lost executors take nothing along. rows: as for in_few(), if known."""
    spark = df.sparkSession
    if rows is not None:
        df = in_few(df, rows)
    path = f"{shared_folder(spark)}/tempoloom/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    if (made := _MADE.get()) is not None:
        made.append(path)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._written_to = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def discard(*tables: DataFrame) -> None:
    """Deletes tables of written() of which nothing lazy reads any more."""
    for df in tables:
        _delete(df.sparkSession, df._written_to)


@contextmanager
def temporary(spark: SparkSession):
    """What written() makes within the block by this thread is deleted at its end; results have to be stored before."""
    made: list[str] = []
    outer = _MADE.set(made)
    try:
        yield
    finally:
        _MADE.reset(outer)
        for path in made:
            _delete(spark, path)


@contextmanager
def kept():
    """What written() makes within the block outlasts a temporary() around it."""
    outer = _MADE.set(None)
    try:
        yield
    finally:
        _MADE.reset(outer)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * _M1
        x = (x ^ (x >> U64(27))) * _M2
    return x ^ (x >> U64(31))


def seeds(n: int, salt: int) -> np.ndarray:
    """n fixed 64-bit words; the same n and salt give the same words everywhere."""
    start = (salt * _GOLDEN) & (2**64 - 1)
    with np.errstate(over="ignore"):
        return mix64(U64(start) + np.arange(1, n + 1, dtype=U64) * U64(_GOLDEN))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


#: Whether a code point is white space, to that of the ideographic space; no greater one is.
BLANK = np.array([chr(c).isspace() for c in range(0x3002)])
_BASE = U64(0xD6E8FEB86659FD93)


@cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The first 2**bits powers of an odd number, and of its inverse, modulo 2**64."""
    with np.errstate(over="ignore"):
        return tuple(np.cumprod(np.concatenate(([U64(1)], np.full((1 << bits) - 1, x)))) for x in (_BASE, U64(pow(int(_BASE), -1, 2**64))))


@cache
def _mixed() -> np.ndarray:
    """mix64() of the code points of the basic plane, each one more."""
    return mix64(np.arange(1, 0x10001, dtype=U64))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words of text.split(), in order: sums over a word's code points, each times a power, so that no word is looked at alone."""
    points = code_points(text)
    n = len(points)
    blank = np.ones(n + 2, dtype=bool)
    blank[1:-1] = BLANK[np.minimum(points, 0x3001)]
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    times, back = _powers(max(12, n.bit_length()))
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, dtype=U64)
        mixed = _mixed()[points] if n and int(points.max()) < 0x10000 else mix64(points.astype(U64) + U64(1))
        np.cumsum(mixed * times[:n], out=sums[1:])
        return mix64((sums[ends] - sums[starts]) * back[starts])


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; a shorter text is one shingle, an empty one has none."""
    n = len(words)
    if not n:
        return np.empty(0, dtype=U64)
    size, start = min(size, n), U64(size)
    with np.errstate(over="ignore"):
        out = np.full(n - size + 1, start * U64(_GOLDEN), dtype=U64)
        for i in range(size):
            out = mix64(out * U64(0xD6E8FEB86659FD93) + words[i : n - size + 1 + i])
    return out


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The rows of an Arrow batch as tuples of Python values."""
    return zip(*(c.to_pylist() for c in batch.columns), strict=True)


def map_rows(df: DataFrame, fn: Callable[[Iterator[tuple]], Iterator[dict]], schema: str, rows_a_batch: int = 2000) -> DataFrame:
    """df with fn applied to the rows of each partition; Arrow batches of bounded size in both directions."""
    from pyspark.sql.types import StructType

    names = [f.name for f in StructType.fromDDL(schema)]

    def arrow(batches):
        def incoming():
            for b in batches:
                for at in range(0, b.num_rows, rows_a_batch):
                    yield from rows_of(b.slice(at, rows_a_batch))

        held: list[tuple] = []
        size = 0
        for r in fn(incoming()):
            held.append(r)
            size += sum(len(v) for v in r if isinstance(v, (str, bytes, list)))
            if len(held) >= rows_a_batch or size > 1 << 23:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)

    from pyspark.sql.pandas.types import to_arrow_schema

    types = list(to_arrow_schema(StructType.fromDDL(schema)).types)
    return df.mapInArrow(arrow, schema)


def text_of(df: DataFrame, *keys: str, text: str = "text") -> DataFrame:
    """The key columns and the text, null texts as empty ones."""
    return df.select(*keys, F.coalesce(F.col(text).cast("string"), F.lit("")).alias(text))
