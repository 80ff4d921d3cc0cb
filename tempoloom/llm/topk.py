"""Exact top-k search by inner product with multi-resolution segment statistics.

A vector is cut into 1, 4 and 16 segments of about equal length; a segment of
length L has a mean and a deviation. For any two vectors the squared distance
is at least the sum of L * ((difference of means)^2 + (difference of
deviations)^2), so the inner product is at most the inner product of their
statistics (each scaled by sqrt(L)), and finer segments give tighter bounds.
Bounds go from coarse to fine; pairs that can't reach a query's k-th best exact
score so far are dropped, and the survivors get exact scores.

Vectors are packed into blocks of bounded size that carry their statistics. A
few blocks of candidates, their number fixed, give each query a first k-th best
score. Then groups of query blocks and groups of candidate blocks meet in cells,
as many as keep all cores busy: a cell holds its queries, takes one block of
candidates after the other, raises the queries' k-th best scores as it goes, and
passes on k rows for each query. So memory doesn't depend on the size of either
table, and candidates are sent once for each group of queries.

Edge cases: vectors that are null or hold null or non-finite components take no
part; vectors of different lengths are not compared; a query's own rows are
those with its id; of queries that share an id the one with the least vector
counts, candidates that share an id count one by one; ties go to the smaller id;
fewer than k candidates give fewer rows; other columns are ignored; an empty
table gives an empty table. Scores must fit 64 bits; those beyond 2**53 are
computed with Python's integers.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SEGMENTS = (1, 4, 16)
#: Vectors and numbers of a block at most.
BLOCK, BLOCK_NUMBERS = 2048, 1 << 18
#: Blocks of candidates that give the first thresholds, and blocks of queries that a cell holds at most.
SAMPLE, HELD = 4, 64
#: Queries that are compared at once.
AT_ONCE = 512
#: Share of pairs beyond which exact scores are computed for whole columns.
DENSE = 0.05
_BLOCK = "dim int, number int, kind string, ids binary, data binary, stats binary"


def valid(vector) -> F.Column:
    """Whether a vector takes part."""
    x = F.col(vector).cast("array<double>")
    return x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))


def blocks(df: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """df's vectors as rows of several vectors: each component floor(scale * x), in the smallest kind of number that holds all of a block."""

    def pack(batches):
        open_: dict[int, list] = {}
        number = TaskContext.get().partitionId() if TaskContext.get() else 0

        def row(dim: int):
            nonlocal number
            ids, data = zip(*open_.pop(dim), strict=True)
            x = np.array(data)
            most = float(np.abs(x).max())
            kind = "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<f8"
            stats = np.hstack([statistics(x, s) for s in SEGMENTS]).astype("<f4")
            number += 1
            return pa.RecordBatch.from_pydict({"dim": pa.array([dim], pa.int32()), "number": pa.array([number], pa.int32()), "kind": pa.array([kind]), "ids": pa.array([np.array(ids, dtype="<i8").tobytes()], pa.binary()), "data": pa.array([x.astype(kind).tobytes()], pa.binary()), "stats": pa.array([stats.tobytes()], pa.binary())})

        for b in batches:
            for i, v in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                x = np.floor(scale * v.values.to_numpy())
                if not np.isfinite(x).all():
                    continue
                open_.setdefault(len(x), []).append((i, x))
                if len(open_[len(x)]) >= min(BLOCK, max(1, BLOCK_NUMBERS // len(x))):
                    yield row(len(x))
        for dim in list(open_):
            yield row(dim)

    rows = df.where(valid(vector) & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    return rows.mapInArrow(pack, _BLOCK)


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """sqrt(L) * mean and sqrt(L) * deviation of each segment, side by side."""
    cuts = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int)
    parts = [x[:, a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return np.hstack([np.column_stack([math.sqrt(p.shape[1]) * p.mean(axis=1), math.sqrt(p.shape[1]) * p.std(axis=1)]) for p in parts])


@dataclass
class Block:
    """Vectors with their ids, statistics by resolution, and lengths."""

    ids: np.ndarray
    data: np.ndarray
    stats: list[np.ndarray]
    norms: np.ndarray

    @staticmethod
    def read(dim: int, kind: str, ids: bytes, data: bytes, stats: bytes) -> Block:
        x = np.frombuffer(data, dtype=kind).reshape(-1, dim).astype(np.float64)
        widths = [2 * min(s, dim) for s in SEGMENTS]
        whole = np.frombuffer(stats, dtype="<f4").reshape(-1, sum(widths)).astype(np.float64)
        return Block(np.frombuffer(ids, dtype="<i8"), x, np.split(whole, np.cumsum(widths)[:-1], axis=1), np.linalg.norm(x, axis=1))

    def of(self, at) -> Block:
        return Block(self.ids[at], self.data[at], [s[at] for s in self.stats], self.norms[at])

    @staticmethod
    def joined(parts: list[Block]) -> Block:
        return Block(np.concatenate([p.ids for p in parts]), np.vstack([p.data for p in parts]), [np.vstack(s) for s in zip(*(p.stats for p in parts), strict=True)], np.concatenate([p.norms for p in parts]))


def _survivors(q: np.ndarray, x: np.ndarray, alive: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of q, row of x, exact score) of the pairs that are alive and whose score is no less than the query's least."""
    if float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1] >= 2**53:
        qi, xi = np.nonzero(alive)
        scores = np.array([sum(int(a) * int(b) for a, b in zip(q[i], x[j], strict=True)) for i, j in zip(qi, xi, strict=True)], dtype=np.int64)
    elif alive.mean() > DENSE:  # a product of whole numbers below 2**53 is exact
        whole = q @ x.T
        qi, xi = np.nonzero(alive & (whole >= least[:, None]))
        return qi, xi, whole[qi, xi].astype(np.int64)
    else:
        qi, xi = np.nonzero(alive)
        scores = np.empty(len(qi), dtype=np.int64)
        for at in range(0, len(qi), 1 << 16):
            s = slice(at, at + (1 << 16))
            scores[s] = np.einsum("ij,ij->i", q[qi[s]], x[xi[s]])
    keep = scores >= least[qi]
    return qi[keep], xi[keep], scores[keep]


class Best:
    """The k best candidates so far of each of some queries, and the score below which none can be among them."""

    def __init__(self, queries: Block, k: int, least: np.ndarray | None = None):
        self.q, self.k = queries, k
        n = len(queries.ids)
        self.least = np.full(n, -np.inf) if least is None else least
        self.at, self.ids, self.scores = (np.empty(0, dtype=np.int64) for _ in range(3))
        self.pairs = self.exact = 0

    def meet(self, x: Block) -> None:
        """Takes in a block of candidates."""
        q = self.q
        alive = q.ids[:, None] != x.ids[None, :]
        columns = np.arange(len(x.ids))
        self.pairs += alive.size
        for own, its in zip(q.stats, x.stats, strict=True):
            # statistics are rounded to 24 bits
            reach = self.least[:, None] - 1e-5 * (q.norms[:, None] * x.norms[columns][None, :]) - 1e-3
            alive &= own @ its[columns].T >= reach
            some = alive.any(axis=0)
            alive, columns = alive[:, some], columns[some]
            if not len(columns):
                return
        self.exact += int(alive.sum())
        qi, xi, scores = _survivors(q.data, x.data[columns], alive, self.least)
        at = np.concatenate((self.at, qi))
        ids, scores = np.concatenate((self.ids, x.ids[columns[xi]])), np.concatenate((self.scores, scores))
        order = np.lexsort((ids, -scores, at))
        at, ids, scores = at[order], ids[order], scores[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        top = rank < self.k
        self.at, self.ids, self.scores = at[top], ids[top], scores[top]
        last = rank == self.k - 1
        self.least[at[last]] = np.maximum(self.least[at[last]], scores[last])


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: float = 256.0) -> DataFrame:
    """(query_id, rank, key, score): the k rows of candidates with the highest inner products for each query."""
    spark = queries.sparkSession
    one = queries.where(valid(vector) & F.col(key).isNotNull()).groupBy(key).agg(F.min(F.col(vector).cast("array<double>")).alias(vector))
    q = written(blocks(one, key, vector, scale), "queries")
    x = written(blocks(candidates, key, vector, scale), "candidates")
    # SAMPLE blocks of bounded size
    sample = [Block.read(r["dim"], r["kind"], r["ids"], r["data"], r["stats"]) for r in x.orderBy(F.xxhash64("ids"), "ids").limit(SAMPLE).collect()]
    n_q, n_x = q.count(), x.count()
    rows = max(1, math.ceil(n_q / HELD))
    slots = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    columns = max(1, min(n_x, math.ceil(4 * slots / rows)))
    spread = lambda df, own, n, other, m, role: df.select("*", F.pmod(F.xxhash64("number", "ids") if n > 4 * slots else F.col("number"), F.lit(n)).cast("int").alias(own), F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other), F.lit(role).alias("role"))
    both = spread(q, "r", rows, "c", columns, 0).unionByName(spread(x, "c", columns, "r", rows, 1))
    both = both.select((F.col("r") * columns + F.col("c")).alias("cell"), "role", *(c.split()[0] for c in _BLOCK.split(", ")))
    placed = both.repartitionById(rows * columns, "cell").sortWithinPartitions("cell", "dim", "role", "number")

    def compare(batches):
        cell, held, best = None, [], []

        def found():
            for b in best:
                yield pa.RecordBatch.from_arrays([pa.array(b.q.ids[b.at]), pa.array(b.ids), pa.array(b.scores)], names=["query_id", key, "score"])

        for batch in batches:
            for at, role, dim, _, kind, *raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if cell != (at, dim):
                    yield from found()
                    cell, held, best = (at, dim), [], []
                block = Block.read(dim, kind, *raw)
                if role == 0:
                    held.append(block)
                    continue
                if held:
                    whole, held = Block.joined(held), []
                    for begin in range(0, len(whole.ids), AT_ONCE):
                        part = whole.of(slice(begin, begin + AT_ONCE))
                        first = Best(part, k)
                        for s in sample:
                            if s.data.shape[1] == dim:
                                first.meet(s)
                        best.append(Best(part, k, first.least))
                for b in best:
                    b.meet(block)
        yield from found()

    scores = placed.mapInArrow(compare, f"query_id long, {key} long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), key)
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", key, "score")
