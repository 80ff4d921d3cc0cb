"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, component) for every end of the edges (a, b): the component is its least node. rows: about how many edges there are, if known.

    Each round links nodes to the least of their neighbours, by aggregates that
    combine before the shuffle and joins that adaptive execution can split, so
    a hub's edges need not meet in one task. Rounds are written to the shared
    folder, those before deleted, and end when the edges no longer change; all edges then lead to the
    least node of their component.
    """
    now = written(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges", rows)
    before, state = None, _state(now)
    while state != before and state[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least", 2 * state[0])  # written, so that a hub's partition of the join can be split
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where(F.col("a") != F.col("b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        last, now = now, written(small.where(F.col("a") != F.col("b")).distinct(), "edges", 2 * state[0])
        before, state = state, _state(now)
        discard(last, least)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
